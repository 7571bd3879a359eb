"""Exact ranks and quantiles of groups of any size.

``percentile`` and ``cume_dist`` keep a whole group in one task.  They are used
while the largest group, which is measured first, fits one.  Beyond that equal
values are merged, approximate quantiles cut each group's values into blocks of
similar size, blocks are counted, and a value's rank is the count of the blocks
below it plus its rank within its block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapweave.operators.attach import attach, counted, largest_group
from gapweave.operators.combine import join_groups

#: Largest group, in rows, that one task is asked to sort.
GROUP_ROWS = 2_000_000


def _elements_below(sorted_array: Column, value: Column, longest: int) -> Column:
    """How many elements of a sorted array are below ``value``, by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(longest.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda seen, step: F.when(
        F.get(sorted_array, seen + step - 1) < value, seen + step).otherwise(seen))


def _holds_wanted(before: Column, size: Column, total: Column, wanted: Sequence[float]) -> Column:
    """Does a block of ranks ``before`` .. ``before + size - 1`` hold an end of a wanted quantile?"""
    def inside(place: Column) -> Column:
        return (place >= before) & (place < before + size)

    out = F.lit(False)
    for p in wanted:
        low = F.floor(F.lit(float(p)) * (total - 1))
        out = out | inside(low) | inside(low + 1)
    return out


def _ranks_in_one_task(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``value_ranks`` of groups that fit a task each: equal values are merged, then one window."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*keys)
    upto = F.sum("n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return (counts.withColumns({"upto": upto, "total": F.sum("n").over(group)})
            .select(*keys, value, "n", (F.col("upto") - F.col("n")).alias("below"), "upto", "total"))


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, blocks: int | None = None,
                bound: int | None = None, wanted: Sequence[float] | None = None,
                largest: int | None = None) -> DataFrame:
    """Distinct values per group: ``n`` copies, ``below`` / ``upto`` ranks, ``total`` size.

    With ``wanted`` probabilities only the blocks that hold one of their order
    statistics are ranked; the rows of the others drop out before any sort.
    ``bound`` is a proven limit of the number of groups.  Without ``blocks`` the
    largest group (``largest`` rows, where the caller has counted it) decides how
    many value blocks there are; a group that fits a task is not cut.
    """
    if blocks is None:
        largest = largest_group(df, keys) if largest is None else largest
        if largest <= GROUP_ROWS and wanted is None:
            return _ranks_in_one_task(df, keys, value)
        blocks = 2 + 2 * largest // max(1, GROUP_ROWS)
    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count(F.lit(1)).alias("n")))
    inner = [i / blocks for i in range(1, blocks)]
    cuts = counts.groupBy(*keys).agg(
        F.array_distinct(F.percentile_approx(value, F.array(*[F.lit(p) for p in inner]), F.lit(max(1_000, 10 * blocks)))).alias("__cuts"),
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("__weight"))
    if bound is None:
        cuts, bound, _ = counted(cuts)
    else:
        cuts = cuts.persist()  # used twice below
    placed = attach(counts, cuts, keys, bound=bound, weight="__weight", row_bytes=8 * blocks)
    placed = placed.withColumn("__block", _elements_below(F.col("__cuts"), F.col(value), blocks)).drop("__cuts")

    in_order = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*keys, "__block").agg(
        F.sum("n").alias("__in"), F.count(F.lit(1)).alias("__weight"), F.max("total").alias("__total"))
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__in").over(in_order), F.lit(0)))
    if wanted is not None:
        sizes = sizes.where(_holds_wanted(F.col("__before"), F.col("__in"), F.col("__total"), wanted))
    sizes = sizes.drop("__in", "__total")
    placed = attach(placed, sizes, [*keys, "__block"], bound=bound * blocks, weight="__weight",
                    how="left" if wanted is None else "inner")
    inside = Window.partitionBy(*keys, "__block").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("__before") + F.sum("n").over(inside)
    return (placed.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("n"))
            .select(*keys, value, "n", "below", "upto", "total"))


def cumulative_share(df: DataFrame, keys: Sequence[str], value: str, into: str = "tau",
                     bound: int | None = None) -> DataFrame:
    """Share of the group's values that are not above the row's value; NULL for a missing value."""
    if largest_group(df, keys) <= GROUP_ROWS:
        held = F.col(value).isNotNull()
        group = Window.partitionBy(*keys, held).orderBy(value)
        return df.withColumn(into, F.when(held, F.cume_dist().over(group)))
    ranks = value_ranks(df, keys, value, bound=bound)
    ranks = ranks.select(*keys, value, (F.col("upto") / F.col("total")).alias(into), F.col("n").alias("__weight"))
    return attach(df, ranks, [*keys, value], weight="__weight")


def _position(p: Column) -> Column:
    return p * (F.col("total") - 1)


def quantiles(df: DataFrame, keys: Sequence[str], values: Mapping[str, str], probabilities: Sequence[float],
              bound: int | None = None) -> DataFrame:
    """Arrays of exact quantiles per group, linear between order statistics: ``{name: value}``."""
    if largest_group(df, keys) <= GROUP_ROWS:
        nodes = F.array(*[F.lit(float(p)) for p in probabilities])
        return df.groupBy(*keys).agg(*[F.percentile(v, nodes).alias(name) for name, v in values.items()])
    return reduce(lambda a, b: join_groups(a, b, keys),
                  [_quantiles_by_rank(df, keys, v, probabilities, name, bound) for name, v in values.items()],
                  df.select(*keys).distinct())


def _quantiles_by_rank(df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], into: str,
                       bound: int | None) -> DataFrame:
    ranks = value_ranks(df, keys, value, bound=bound, wanted=probabilities)
    nodes = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)])

    def holds(position: Column) -> Column:
        return (position >= F.col("below")) & (position < F.col("upto"))

    def touched(node: Column) -> Column:
        lower = F.floor(_position(node["p"]))
        return holds(lower) | holds(lower + 1)

    hits = ranks.select(*keys, F.col(value).alias("__v"), "below", "upto", "total",
                        F.explode(F.filter(nodes, touched)).alias("__node"))
    at = _position(F.col("__node.p"))
    lower = F.floor(at)
    ends = hits.groupBy(*keys, F.col("__node.i").alias("__i")).agg(
        F.max(F.when(holds(lower), F.col("__v"))).alias("__lo"),
        F.max(F.when(holds(lower + 1), F.col("__v"))).alias("__hi"),
        F.max(at - lower).alias("__w"))
    q = F.when(F.col("__w") == 0, F.col("__lo")).otherwise(
        F.col("__lo") + (F.coalesce("__hi", "__lo") - F.col("__lo")) * F.col("__w"))
    # as many rows per group as there are probabilities
    return (ends.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct(F.col("__i").alias("i"), q.alias("q")))).alias("__q"))
            .select(*keys, F.transform("__q", lambda s: s["q"]).alias(into)))


def five_numbers(df: DataFrame, keys: Sequence[str], value: str, bound: int | None = None) -> DataFrame:
    """Min, quartiles, max, mean and missing count per group."""
    q = quantiles(df, keys, {"__q": value}, (0.0, 0.25, 0.5, 0.75, 1.0), bound)
    names = ("q_min", "q1", "q_median", "q3", "q_max")
    rest = df.groupBy(*keys).agg(F.avg(value).alias("q_mean"), F.count_if(F.col(value).isNull()).alias("n_null"))
    out = join_groups(rest, q, keys)
    return out.select(*keys, *[F.col("__q")[i].alias(n) for i, n in enumerate(names)], "q_mean", "n_null")
