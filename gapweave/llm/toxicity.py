"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed character n-grams (A-Z lower-cased, a space
around the text).  Each n-gram counts with the log ratio of its smoothed share
among toxic and among other training texts; a logistic regression on these
scaled features gives the score.  N-grams of fewer than ``min_texts`` training
texts, or without a clear bond to the label (chi-squared below ``least_chi``, or
below ``least_phi`` of the texts), carry nothing: in them the ratio is noise.
Of training texts of one label that copy each other one counts.

Fitting takes the labelled rows with the smallest key hashes, ``FIT_ROWS`` at
most (a documented bound: the model is a fixed-size table of 2**20 weights);
scoring streams every whole text.  Null and empty texts score like a text
without any known n-gram.  Rows with a null label, and labels that contradict
each other for one key, are each used as they are.  Without a toxic or without
a clean training text the score is the smoothed share of toxic texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from gapweave.llm.shared import byte_words, fresh, reachable, slices, widened

ORDERS = (4, 6, 8)
HASH_BITS = 20
FIT_ROWS = 6000
THRESHOLD = 0.7
_PRIME, _MIX = np.uint64(1099511628211), np.uint64(0x9E3779B97F4A7C15)
_STEP = 1 << 20  # characters hashed at a time


def features(text: str | None, useful: np.ndarray | None = None) -> np.ndarray:
    """Sorted distinct feature numbers of a text; with ``useful`` (flag by feature) only those."""
    padded = f" {text or ''} ".encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(padded, np.uint32).astype(np.uint64)
    codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint64(32), codes)
    codes = np.where((codes >= 9) & (codes <= 13), np.uint64(32), codes)
    found = []
    longest = max(ORDERS)
    for at in range(0, len(codes), _STEP):  # runs overlap, so no n-gram is cut
        run = codes[at : at + _STEP + longest - 1]
        value = np.full(len(run), 14695981039346656037, np.uint64)
        for n in range(1, longest + 1):
            if n > len(run):
                break
            value = value[: len(run) - n + 1] * _PRIME ^ run[n - 1 :]
            if n in ORDERS:
                index = ((value * _MIX) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
                found.append(np.unique(index if useful is None else index[useful[index]]))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Model:
    """Bias, and for each feature in use its classifier weight times its log-count ratio."""

    bias: float
    index: np.ndarray
    weights: np.ndarray

    def table(self) -> np.ndarray:
        out = np.zeros(1 << HASH_BITS)
        out[self.index] = self.weights
        return out

    def score(self, text: str | None, table: np.ndarray | None = None, useful: np.ndarray | None = None) -> float:
        table = self.table() if table is None else table
        useful = table != 0 if useful is None else useful
        z = self.bias + float(table[features(text, useful)].sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs that begin at ``starts``; empty runs sum to zero."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def _chi_squared(with_feature: np.ndarray, toxic_with: np.ndarray, toxic: float, texts: float) -> np.ndarray:
    """How far presence of each feature and the label are from independence."""
    a, b = toxic_with, with_feature - toxic_with
    c, d = toxic - a, texts - toxic - b
    below = (a + b) * (c + d) * (a + c) * (b + d)
    return np.where(below > 0, texts * (a * d - b * c) ** 2 / np.maximum(below, 1), 0.0)


def _without_copies(texts: list[str | None], labels: list[int], slots: int = 8, shared: int = 6) -> list[int]:
    """Places of the texts that copy no text before of their label: fewer than ``shared`` min-hashes of word triples agree with any one.

    Copies of one text would make its own n-grams look like signs of its label.
    """
    rng = np.random.default_rng(7)
    factors = rng.integers(1, 1 << 31, slots, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    kept = {label: np.zeros((len(texts), slots), np.uint32) for label in set(labels)}
    held = dict.fromkeys(kept, 0)
    out = []
    for at, (text, label) in enumerate(zip(texts, labels)):
        found = byte_words(text)
        triples = [zlib.crc32(b" ".join(x)) for x in zip(found, found[1:], found[2:])] or [zlib.crc32(b" ".join(found))]
        values = np.array(triples, np.uint64)
        marks = np.array([((values * f) & np.uint64(0xFFFFFFFF)).min() for f in factors], np.uint32)
        if not ((kept[label][: held[label]] == marks).sum(axis=1) >= shared).any():
            out.append(at)
            kept[label][held[label]] = marks
            held[label] += 1
    return out


def fit(texts: list[str | None], labels: list[int], min_texts: int = 3, least_phi: float = 0.006, least_chi: float = 36.0, smoothing: float = 1.0,
        penalty: float = 1e-4, lift: float = 0.75, rounds: int = 300) -> Model:
    """The classifier for texts with labels 0 and 1; the same rows give the same model."""
    size = 1 << HASH_BITS
    single = _without_copies(texts, labels)
    sets = [features(texts[k]).astype(np.int32) for k in single]
    y = np.array([labels[k] for k in single], np.float64)
    positives = float(y.sum())
    prior = (positives + 1.0) / (len(y) + 2.0)
    plain = Model(float(np.log(prior / (1 - prior))), np.zeros(0, np.int64), np.zeros(0))
    if positives in (0.0, float(len(y))):
        return plain
    texts_with, toxic_with = np.zeros(size), np.zeros(size)
    for found, label in zip(sets, y):
        texts_with[found] += 1
        toxic_with[found] += label
    bond = _chi_squared(texts_with, toxic_with, positives, len(y))
    useful = (texts_with >= min_texts) & (bond >= max(least_chi, least_phi * len(y)))
    index = np.flatnonzero(useful)
    if not len(index):
        return plain
    p, q = toxic_with + smoothing, texts_with - toxic_with + smoothing
    ratio = np.log((p / p.sum()) / (q / q.sum()))[index]
    sets = [np.searchsorted(index, s[useful[s]]) for s in sets]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    column, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), np.diff(starts))
    value = ratio[column]
    # between one weight per text and one weight per kind
    share = (len(y) - positives) / positives
    weight = np.where(y == 1, share**lift, 1.0) / len(y)
    n = len(index)
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)  # the last is the bias
    for k in range(1, rounds + 1):  # Adam on the whole training set
        z = w[n] + _sums(w[column] * value, starts)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        g = np.append(np.bincount(column, weights=error[row] * value, minlength=n) + penalty * w[:n], error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return Model(float(w[n]), index, w[:n] * ratio)


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                  fold: int | None = 1, folds: int = 3, rows: int = FIT_ROWS) -> tuple[list[str | None], list[int]]:
    """Labelled texts outside ``fold`` (crc32 of the key as text, modulo ``folds``), smallest key hashes first."""
    marked = labels.select(F.col(key).alias("k"), F.col(label).alias("y")).filter("y IS NOT NULL AND k IS NOT NULL")
    if fold is not None:
        marked = marked.filter(F.crc32(F.col("k").cast("string")) % folds != fold)
    order = [F.xxhash64("k"), F.col("k"), F.col("y")]
    chosen = marked.join(docs.select(F.col(key).alias("k")).distinct(), "k", "left_semi").orderBy(*order).limit(rows)
    # the chosen keys are bounded by ``rows``, so they may be broadcast
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(chosen), "k")
    found = texts.orderBy(*order, F.xxhash64("t")).limit(rows).select("t", "y").collect()
    return [r["t"] for r in found], [int(r["y"]) for r in found]


def _scorer(model: Model, text: str, emit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.table()
        useful = weights != 0
        for batch in batches:
            for part in slices(batch, text):
                yield emit(part, np.array([model.score(t.as_py(), weights, useful) for t in part.column(text)], np.float64))

    return run


def score_texts(df: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """The rows with ``into``, 0 (clean) to 1 (toxic)."""

    def emit(part: pa.RecordBatch, scores: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], [*part.schema.names, into])

    return reachable(df).mapInArrow(_scorer(model, text, emit), widened(df, into, DoubleType()))


def toxicity_table(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """``key``, ``held_out``, ``score``, ``predicted`` of every row."""
    model = fit(*training_rows(docs, labels, key, text))
    scored = score_texts(docs.select(F.col(key), F.col(text).alias("t")), model, "t")
    return scored.select(
        key,
        (F.coalesce(F.crc32(F.col(key).cast("string")), F.lit(0)) % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below ``threshold``, with the columns of the input."""
    into = fresh("score", docs)
    model = fit(*training_rows(docs, labels, key, text))
    return score_texts(docs, model, text, into).filter(F.col(into) < threshold).drop(into)
