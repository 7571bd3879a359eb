"""Benchmark decontamination: one Aho-Corasick automaton of normalised items, run once over every text.

Words are runs of digits, letters and everything beyond ASCII, A-Z in lower
case.  An item's windows are all runs of ``length`` words; a shorter item is
one window.  The automaton's letters are the items' words, so it knows no
spaces and punctuation, a word that no item has ends every match, and what it
finds are word positions, which lead back to the characters of the text.

The automaton is broadcast in blocks of at most ``BLOCK_WORDS`` words of
windows (a word takes up to 100 bytes of a worker).  Up to that bound one pass
over the texts does it.  More windows than that make more blocks: the texts
are written once with a number for each row, every block is run over them, and
what the blocks find is joined by that number, so no item is left out.

Null texts have no words, null items no windows.  Items without an id mark
words, but are not counted or named.  Items that repeat an id are one item.
Documents that repeat are scanned each.  Other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import cut, reachable, slices
from gapweave.llm.spelling import LOWER, UPPER

WINDOW = 10
BLOCK_WORDS = 2_000_000
#: Everything in ASCII that is no digit and no letter.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

SCHEMA = "n_words long, spans array<struct<start:long,end:long,words:long>>, items array<string>"


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def windows(items: DataFrame, key: str = "item_id", text: str = "text", length: int = WINDOW) -> DataFrame:
    """Distinct ``item``, ``window`` (words with a space between them)."""
    worded = items.select(F.col(key).cast("string").alias("item"), normal_words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - length + 1, F.lit(1)))
    cuts = F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.lit(length)), " "))
    return worded.select("item", F.explode(cuts).alias("window")).distinct()


class Matcher:
    """The automaton of some windows; pickled as the windows, built once in each worker."""

    _built: dict[str, Matcher] = {}

    def __init__(self, found: dict[str, list[str]]):
        import ahocorasick

        self.numbers: dict[bytes, int] = {}
        self.items: list[list[str]] = []
        self.lengths: list[int] = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for window, items in found.items():
            letters = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in window.encode().split(b" "))
            self.automaton.add_word(letters, len(self.items))
            self.items.append(items)
            self.lengths.append(len(letters))
        if self.items:
            self.automaton.make_automaton()

    @classmethod
    def shared(cls, name: str, found: dict[str, list[str]]) -> Matcher:
        """The worker's automaton of this name; another one makes room."""
        if name not in cls._built:
            cls._built = {name: cls(found)}
        return cls._built[name]

    def scan(self, text: str | None) -> tuple[int, list[dict], list[str]]:
        """Number of words, spans of hit words (character offsets), sorted items with occurring windows."""
        if not text:
            return 0, [], []
        raw = text.encode("utf-8", "surrogatepass").translate(_TABLE)
        found = raw.split()
        if not self.items:
            return len(found), [], []
        number = self.numbers.get
        ends = list(self.automaton.iter(tuple([number(w, 0) for w in found])))
        if not ends:
            return len(found), [], []
        items: set[str] = set()
        for k in {k for _, k in ends}:
            items.update(self.items[k])
        runs: list[list[int]] = []  # first and last word; ends come in order, so only the last run can grow
        for end, k in ends:
            start = end - self.lengths[k] + 1
            while runs and runs[-1][1] >= start:
                start = min(start, runs.pop()[0])
            runs.append([start, end])
        return len(found), self._spans(raw, runs), sorted(items)

    @staticmethod
    def _spans(raw: bytes, runs: list[list[int]]) -> list[dict]:
        """Word runs as character offsets of the text."""
        data = np.frombuffer(raw, np.uint8)
        inside = np.concatenate([[False], data != 0x20, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return [{"start": int(characters[edges[2 * a]]), "end": int(characters[edges[2 * b + 1]]), "words": b - a + 1} for a, b in runs]


def _scanned(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """The rows' columns but ``t``, and what the windows ``window``, ``items`` hit in ``t``."""
    taken = rows.sparkSession.sparkContext.broadcast({r["window"]: r["items"] for r in found.toLocalIterator()})
    others = [f for f in rows.schema.fields if f.name != "t"]
    kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64())])), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher.shared(name, taken.value)
        for batch in batches:
            for part in slices(batch, "t"):
                scans = list(zip(*(matcher.scan(t) for t in part.column("t").to_pylist())))
                kept = [part.column(f.name) for f in others]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *(pa.array(list(c), k) for c, k in zip(scans, kinds))], [*(f.name for f in others), "n_words", "spans", "items"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), SCHEMA])
    return reachable(rows).mapInArrow(run, schema)


def _joined(spans: Column) -> Column:
    """Spans of several blocks: those that share words become one, so every word counts once."""
    pieces = F.array_sort(spans)
    first = F.array().cast("array<struct<start:long,end:long,words:long>>")

    def put(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"), F.lit(0).cast("long").alias("words"))
        fresh = F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(0).cast("long").alias("words"))
        return F.when(F.size(done) == 0, F.array(fresh)).when(
            x["start"] < last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(fresh)))

    return F.aggregate(pieces, first, put)


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
               item_text: str = "text", length: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``key``, ``n_words``, ``spans`` (start, end and words of every hit run) and ``items`` of each document."""
    pairs = cut(windows(items, item, item_text, length))
    n_words = pairs.agg(F.sum(F.size(F.split("window", " ")))).first()[0] or 0
    blocks = max(1, math.ceil(n_words / block_words))
    slim = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    name = uuid.uuid4().hex  # workers keep the automaton of this call

    def block(b: int) -> DataFrame:
        mine = pairs if blocks == 1 else pairs.filter(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == b)
        # collect_list leaves out null items
        return mine.groupBy("window").agg(F.collect_list("item").alias("items"))

    if blocks == 1:
        return _scanned(slim, block(0), name).withColumnRenamed("k", key)
    rows = cut(slim.withColumn("row", F.monotonically_increasing_id()))
    parts = [cut(_scanned(rows.select("row", "t"), block(b), f"{name}-{b}")) for b in range(blocks)]
    hits = parts[0].filter(F.size("spans") > 0)
    for part in parts[1:]:
        hits = hits.unionByName(part.filter(F.size("spans") > 0))
    found = hits.groupBy("row").agg(
        _joined(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    inside = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.size(normal_words(F.substr("t", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))).cast("long").alias("words")))
    counted = rows.join(found, "row", "left").join(parts[0].select("row", "n_words"), "row")
    none = {"spans": F.array().cast("array<struct<start:long,end:long,words:long>>"), "items": F.array().cast("array<string>")}
    return counted.select(F.col("k").alias(key), "n_words", F.coalesce(inside, none["spans"]).alias("spans"),
                          F.coalesce("items", none["items"]).alias("items"))
