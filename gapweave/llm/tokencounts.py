"""Token counts of fields and sections, from one encoding of the whole document.

A document is rendered once: its fields in order, each followed by ``GLUE``.
The text field is divided into sections (lines, each with its line feed).  The
rendered document is encoded whole; the character span of each token meets the
sorted section spans in an interval join (binary search), and a token that
crosses a boundary goes where ``rule`` says: ``first`` (section of its first
character), ``last``, or ``most`` (most of its characters, the earlier on a
tie).  So the counts of a document add up to its tokens.  Glue belongs to the
field before it.

Null fields count as empty; an empty text is one empty section.  A token that
holds part of a character spans that character.  Rows that repeat are counted
each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.bpe import BytePairs
from gapweave.llm.shared import reachable, slices

GLUE = "\n"
RULES = ("first", "last", "most")


def spans(rendered: bytes, ids: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First character and end (exclusive) of every token, and how many characters begin up to each byte."""
    octets = np.frombuffer(rendered, np.uint8)
    begun = np.cumsum((octets & 0xC0) != 0x80)
    stops = np.cumsum(lengths[np.frombuffer(ids, "<u4")])
    if not len(stops):
        return stops, stops, begun
    starts = np.concatenate([[0], stops[:-1]])
    return begun[starts] - 1, begun[stops - 1], begun


def attribute(starts: np.ndarray, stops: np.ndarray, ends: np.ndarray, rule: str = "first") -> np.ndarray:
    """Tokens of each section; ``ends`` are the sections' sorted exclusive ends, the last one that of the document."""
    first = np.searchsorted(ends, starts, "right")
    last = np.searchsorted(ends, stops - 1, "right")
    chosen = last if rule == "last" else first
    if rule == "most":
        chosen = first.copy()
        for k in np.flatnonzero(first != last):  # only tokens across a boundary
            span = range(int(first[k]), int(last[k]) + 1)
            shares = [min(stops[k], ends[s]) - max(starts[k], ends[s - 1] if s else 0) for s in span]
            chosen[k] = span[int(np.argmax(shares))]
    return np.bincount(chosen, minlength=len(ends))


def count_document(fields: list[str | None], pairs: BytePairs, rule: str = "first") -> np.ndarray:
    """Rows of (field, section, start, end, tokens) for every section; the last field is divided into lines."""
    parts = [(value or "") + (GLUE if k < len(fields) - 1 else "") for k, value in enumerate(fields)]
    text = "".join(parts)
    rendered = text.encode("utf-8", "surrogatepass")
    starts, stops, begun = spans(rendered, pairs.encode(text), pairs.lengths)
    before = np.cumsum([len(p) for p in parts[:-1]], dtype=np.int64)
    head = int(before[-1]) if len(before) else 0
    # ends of lines, each with its line feed; an empty text is one empty line
    lines = begun[np.frombuffer(rendered, np.uint8) == 10]
    lines = lines[lines > head]
    if not len(lines) or lines[-1] < len(text):
        lines = np.append(lines, len(text))
    ends = np.concatenate([before, lines])
    rows = np.empty((len(ends), 5), np.int64)
    rows[:, 0] = np.minimum(np.arange(len(ends)), len(before))
    rows[:, 1] = np.maximum(np.arange(len(ends)) - len(before), 0)
    rows[:, 2] = np.concatenate([[0], ends[:-1]])
    rows[:, 3] = ends
    rows[:, 4] = attribute(starts, stops, ends, rule)
    return rows


def token_counts(df: DataFrame, path: str, pattern: str, key: str = "doc_id", fields: tuple[str, ...] = ("source", "lang"),
                 text: str = "text", rule: str = "first") -> DataFrame:
    """``key, field, section, start, stop, n_tokens`` for every field and every line of ``text``."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    taken = (*fields, text)
    slim = df.select(F.col(key).alias("key"), *[F.col(c).cast("string").alias(f"f{k}") for k, c in enumerate(taken)])
    kind = slim.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs.shared(path, pattern)
        for batch in batches:
            for part in slices(batch, f"f{len(taken) - 1}", 4 << 20):
                found = [count_document(list(v), pairs, rule) for v in zip(*[c.to_pylist() for c in part.columns[1:]])]
                keys = part.column("key").take(pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found])))
                rows = np.concatenate(found)
                names = pa.DictionaryArray.from_arrays(pa.array(rows[:, 0], pa.int32()), pa.array(taken)).cast(pa.string())
                numbers = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(1, 5)]
                yield pa.RecordBatch.from_arrays([keys, names, *numbers], ["key", "field", "section", "start", "stop", "n_tokens"])

    return reachable(slim).mapInArrow(run, f"key {kind}, field string, section long, start long, stop long, n_tokens long").withColumnRenamed("key", key)
