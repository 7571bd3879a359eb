"""SimHash near-duplicates with pigeonring filtering.

Texts become 64-bit fingerprints; equal ones collapse before any comparison.
The 64 bits form a ring of segments.  If two fingerprints differ in at most
``tau`` bits, some start on the ring exists from which every chain of ``l``
segments differs in at most ``l * tau / segments`` bits (the strong form of
the pigeonring principle).  So the first segments of a chain are equal: they
are the join key.  The budgets of the longer chains then prune candidates
before the full Hamming check.

A bucket with more than ``most`` fingerprints is not joined with itself.  Its
members are linked through the bit strings one flip away: two fingerprints
differ in two bits or fewer exactly when such a ball of one holds both, so
joining every member of a ball to the smallest links the same components with
rows that grow with the bucket, not with its square.

Null and empty texts have the fingerprint zero.  Rows with a null id are
fingerprinted and linked like others, but never name a component while it has
another id.  Rows that repeat are one fingerprint.  Only the id and the text
are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gapweave.llm.components import components
from gapweave.llm.shared import byte_words, cut, fresh, reachable, slices, widened

BITS = 64
SEED = 42
#: Fingerprints of a bucket that are compared pair by pair; larger buckets are linked through balls.
PAIRED = 64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """A bit is one if more than half of the shingle hashes have it."""
    found = byte_words(text)
    if not found:
        return 0
    rows = [b" ".join(x) for x in zip(*(found[k:] for k in range(shingle)))] if len(found) >= shingle else [b" ".join(found)]
    digest = xxhash.xxh64_intdigest
    totals = np.zeros(BITS, np.int64)
    step = 1 << 16  # bits of so many hashes are unpacked at a time
    for at in range(0, len(rows), step):
        hashes = np.fromiter((digest(x, SEED) for x in rows[at : at + step]), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += bits.sum(axis=0, dtype=np.int64)
    ones = 2 * totals > len(rows)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, text: str = "text", into: str = "fp", shingle: int = 3) -> DataFrame:
    """The rows with a signed 64-bit fingerprint of their whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                prints = np.array([fingerprint(t.as_py(), shingle) for t in part.column(text)], np.uint64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(prints.view(np.int64))], [*part.schema.names, into])

    return reachable(df).mapInArrow(run, widened(df, into, LongType()))


def ring(segments: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each segment; widths differ by one at most."""
    edges = [round(k * BITS / segments) for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _mask(parts: list[tuple[int, int]]) -> int:
    mask = sum(((1 << w) - 1) << a for a, w in parts)
    return mask - (1 << 64) if mask >> 63 else mask


def chain_masks(segments: int, start: int) -> list[int]:
    """Bit masks of the chains of 1, 2, ... segments from ``start`` around the ring."""
    parts = ring(segments)
    return [_mask([parts[(start + k) % segments] for k in range(n)]) for n in range(1, segments + 1)]


def budgets(segments: int, tau: int) -> list[int]:
    """Most differing bits of a chain of 1, 2, ... segments."""
    return [n * tau // segments for n in range(1, segments + 1)]


def within_budgets(difference: Column, segments: int, start: int, tau: int) -> Column:
    """Every chain from ``start`` keeps its budget; chains with budget zero are the join key already."""
    out = F.lit(True)
    for mask, most in zip(chain_masks(segments, start), budgets(segments, tau)):
        if most:
            out = out & (F.bit_count(difference.bitwiseAND(F.lit(mask))) <= most)
    return out


def _balls(members: DataFrame) -> DataFrame:
    """Each fingerprint beside itself and its 64 neighbours one flip away."""
    flips = [0, *(1 << k for k in range(63)), -(1 << 63)]
    balls = F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips]))
    return members.select("fp", balls.alias("ball"))


def links(prints: DataFrame, tau: int = 2, segments: int = 7, most: int = PAIRED) -> DataFrame:
    """Edges ``a``, ``b`` that connect all fingerprints within ``tau`` bits of each other.

    ``prints`` holds distinct fingerprints ``fp``.  ``most`` needs ``tau`` of
    two; for other distances every bucket is joined.
    """
    starts = range(segments)
    zero = sum(b == 0 for b in budgets(segments, tau))
    keys = F.array(
        *[
            F.struct(F.lit(s).alias("start"), F.col("fp").bitwiseAND(F.lit(chain_masks(segments, s)[zero - 1])).alias("key"))
            for s in starts
        ]
    )
    rows = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.start", "k.key")
    sizes = rows.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("least")).filter("n > 1")
    sizes = cut(sizes)
    if tau == 2:
        small, large = sizes.filter(F.col("n") <= most), sizes.filter(F.col("n") > most)
    else:
        small, large = sizes, None
    near = rows.join(small.select("start", "key"), ["start", "key"], "left_semi")
    a, b = near.select("start", "key", F.col("fp").alias("a")), near.select("start", "key", F.col("fp").alias("b"))
    difference = F.col("a").bitwiseXOR(F.col("b"))
    chained = F.lit(False)
    for s in starts:
        chained = chained | ((F.col("start") == s) & within_budgets(difference, segments, s, tau))
    pairs = a.join(b, ["start", "key"]).filter((F.col("a") < F.col("b")) & chained & (F.bit_count(difference) <= tau))
    edges = pairs.select("a", "b")
    if large is not None:
        crowded = rows.join(large.select("start", "key"), ["start", "key"], "left_semi").select("fp").distinct()
        balls = _balls(crowded)
        least = balls.groupBy("ball").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        stars = balls.join(least.select("ball", "a"), "ball").filter(F.col("fp") != F.col("a"))
        edges = edges.unionAll(stars.select("a", F.col("fp").alias("b")))
    return edges.distinct()


def fingerprint_components(prints: DataFrame, tau: int = 2, segments: int = 7, most: int = PAIRED) -> DataFrame:
    """``fp``, ``root`` of every distinct fingerprint; equal roots are connected."""
    distinct = cut(prints.select("fp").distinct())
    joined = components(links(distinct, tau, segments, most))
    return distinct.join(joined.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", tau: int = 2, segments: int = 7,
                    shingle: int = 3, most: int = PAIRED) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (smallest id reachable by links) of every row."""
    slim = with_fingerprints(df.select(F.col(key), F.col(text).alias("t")), "t", "fp", shingle)
    prints = cut(slim.select(key, "fp"))
    roots = fingerprint_components(prints, tau, segments, most)
    smallest = prints.groupBy("fp").agg(F.min(key).alias("least")).join(roots, "fp")
    names = smallest.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = smallest.select("fp", "root").join(names, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(key, "fp", "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", tau: int = 2, segments: int = 7,
             shingle: int = 3, most: int = PAIRED) -> DataFrame:
    """One row of each component, with the columns of the input: the smallest id; of equal rows any one."""
    fp, win = fresh("fp", df), fresh("winner", df)
    slim = with_fingerprints(df.select(F.col(key).alias("id"), F.col(text).alias("t")), "t", "fp", shingle)
    prints = cut(slim.select("id", "fp"))
    roots = fingerprint_components(prints, tau, segments, most)
    least = prints.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("w"))
    winners = cut(least.join(roots, "fp").groupBy("root").agg(F.min("w").alias("w")).select("w.id", "w.fp"))
    # whole rows move by their id, so copies of one text do not meet; only named rows are fingerprinted again
    named = winners.select(F.col("id").alias(win)).distinct()
    some = df.join(named, F.col(key).eqNullSafe(F.col(win)), "left_semi")
    rows = with_fingerprints(some, text, fp, shingle)
    chosen = winners.select(F.col("id").alias(win), F.col("fp").alias(fp))
    kept = rows.join(chosen, [fp]).filter(F.col(key).eqNullSafe(F.col(win))).drop(win)
    return kept.dropDuplicates([fp]).select(*[F.col(f"`{c}`") for c in df.columns])
