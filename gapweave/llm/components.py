"""Connected components of an edge table by alternating large-star and small-star steps.

Edges stay on executors.  Each round is written to the shared checkpoint
folder, so lost executors cost one round and the plan does not grow.  A node
with very many neighbours is not gathered: its smallest neighbour is a
map-side minimum, joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step.  Large: neighbours above a node go to the least of it and its neighbours; small: those below."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a")
    if large:
        out = moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b"))
        )
    return out.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _sum(edges: DataFrame) -> tuple[int, int]:
    """Count and checksum of the edges."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1] or 0


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest connected node) for every node of ``edges(a, b)``; self-loops are ignored."""
    edges = cut(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    seen = _sum(edges)
    while seen[0]:
        edges = cut(_star(_star(edges, True), False))
        now = _sum(edges)
        if now == seen:
            break
        seen = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
