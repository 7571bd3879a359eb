"""Bring group-level results back to rows without a hot partition.

``attach`` is the one join every "statistic per group, back on each row"
operator uses.  A group may hold a third of all rows, so hashing rows by group
is not an option.  Two exact ways:

* the table of groups is small (proven by the caller, or counted here): it is
  broadcast and the rows never move;
* it is not: rows of the few heaviest groups still meet a broadcast table, only
  the others are shuffled to meet the rest of the groups.  No task receives a
  heavy group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest table of groups that is ever broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: A group above this share of all rows is served by broadcast, so at most
#: ``1 / HEAVY_SHARE`` groups are.
HEAVY_SHARE = 1e-5


def _same(left: DataFrame, right: DataFrame, on: Sequence[str], marks: dict[str, str]) -> Column:
    test = F.lit(True)
    for key in on:
        test = test & left[key].eqNullSafe(right[marks[key]])
    return test


def _marked(groups: DataFrame, on: Sequence[str], tag: str) -> tuple[DataFrame, dict[str, str]]:
    marks = {key: f"__{tag}_{key}" for key in on}
    return groups.withColumnsRenamed(marks), marks


def fits(n_groups: int, row_bytes: int) -> bool:
    return n_groups <= BROADCAST_ROWS and n_groups * row_bytes <= BROADCAST_BYTES


def counted(groups: DataFrame, weight: str | None = None) -> tuple[DataFrame, int, int]:
    """Compute a table of groups once, keep it, and count it (and the rows behind it).

    The table stays kept for the query that is built on it; a long-lived session
    frees such tables with ``spark.catalog.clearCache()`` between jobs.
    """
    groups = groups.persist()
    total = F.sum(weight) if weight else F.lit(0).cast("bigint")
    n_groups, n_rows = groups.agg(F.count(F.lit(1)), total).first()
    return groups, n_groups, n_rows or 0


def largest_group(df: DataFrame, by: Sequence[str]) -> int:
    """Rows of the largest group: counts are combined map side, one number comes back."""
    return df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def attach(rows: DataFrame, groups: DataFrame, on: Sequence[str], *, how: str = "left",
           bound: int | None = None, weight: str | None = None, row_bytes: int = 100) -> DataFrame:
    """Join ``groups`` (unique on ``on``; NULL keys match NULL) to ``rows``.

    ``bound``: proven upper limit of the number of groups, e.g. months x hours.
    ``weight``: column of ``groups`` with its number of rows; it is dropped.
    ``row_bytes``: about how wide a group is.
    Without a sufficient bound the groups are computed once, kept, and counted.
    """
    slim = groups.drop(weight) if weight else groups
    if bound is not None and fits(bound, row_bytes):
        return _attach_small(rows, slim, on, how)
    groups, n_groups, n_rows = counted(groups, weight)
    if fits(n_groups, row_bytes):
        return _attach_small(rows, groups.drop(weight) if weight else groups, on, how)
    if weight is None:  # count the rows behind each group
        return look_up(rows, groups, on, how=how, row_bytes=row_bytes)
    share = max(HEAVY_SHARE, row_bytes / BROADCAST_BYTES)
    return attach_split(rows, groups, on, weight, heavy_rows=max(1, int(n_rows * share)), how=how)


def _attach_small(rows: DataFrame, groups: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    groups, marks = _marked(groups, on, "g")
    joined = rows.join(F.broadcast(groups), _same(rows, groups, on, marks), how)
    return joined.drop(*marks.values())


def attach_split(rows: DataFrame, groups: DataFrame, on: Sequence[str], weight: str, *,
                 heavy_rows: int, how: str = "left") -> DataFrame:
    """Rows of heavy groups meet a broadcast and stay where they are; the others a shuffle join.

    ``rows`` is read once for each of the two parts, so keep it if it is costly.
    """
    is_heavy = F.col(weight) > heavy_rows
    heavy = groups.where(is_heavy).drop(weight).withColumn("__heavy", F.lit(True))
    light = groups.where(~is_heavy).drop(weight)
    marked = _attach_small(rows, heavy, on, "left")
    done = marked.where(F.col("__heavy")).drop("__heavy")
    rest = marked.where(F.col("__heavy").isNull()).select(*rows.columns)
    light, marks = _marked(light, on, "l")
    rest = rest.join(light, _same(rest, light, on, marks), how).drop(*marks.values())
    return done.unionByName(rest)


def look_up(rows: DataFrame, entries: DataFrame, on: Sequence[str], *, how: str = "left",
            row_bytes: int = 100) -> DataFrame:
    """Join ``entries`` (unique on ``on``; NULL keys match NULL) that do not stem from ``rows``.

    Small enough: broadcast.  Else the rows per key are counted, so that keys
    with very many rows can be served apart.
    """
    entries, n_entries, _ = counted(entries)
    if fits(n_entries, row_bytes):
        return _attach_small(rows, entries, on, how)
    counts, marks = _marked(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__weight")), on, "c")
    weighed = entries.join(counts, _same(entries, counts, on, marks), "inner").drop(*marks.values())
    return attach(rows, weighed, on, how=how, weight="__weight", row_bytes=row_bytes)


def on_each_row(df: DataFrame, by: Sequence[str], aggregates: Mapping[str, Column], *,
                short_groups: bool = False, bound: int | None = None) -> DataFrame:
    """Aggregates of the row's group, next to the row.

    ``short_groups``: the caller knows that a group cannot grow with the data,
    as with one row per site and hour grouped by site, month and hour (31 rows a
    year).  Then one window does it in a single pass.  Otherwise groups may be
    huge: they are aggregated (map side first) and attached.
    """
    if short_groups:
        group = Window.partitionBy(*by)
        return df.withColumns({name: c.over(group) for name, c in aggregates.items()})
    groups = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggregates.items()], F.count(F.lit(1)).alias("__weight"))
    return attach(df, groups, by, bound=bound, weight="__weight")

