"""Joins, unions and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions.naming import suffix_clashes
from gapweave.operators.attach import look_up


def _null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    if how not in ("inner", "left"):
        raise ValueError(f"{how} join: only inner and left joins keep the key of the left side")
    marks = {c: f"__r_{c}" for c in on}
    right = right.withColumnsRenamed(marks)
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[marks[c]]) for c in on])
    out = left.join(right, same, how).drop(*marks.values())
    return out.select(*on, *[c for c in out.columns if c not in on])


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a NULL key meets a NULL key; size and skew of the sides are left to adaptive execution.

    ``how`` is inner or left.
    """
    return _null_safe(left, right, list(on), how)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column name both sides share."""
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("no common column to join on")
    return _null_safe(left, right, common, how)


def suffix_join(left: DataFrame, right: DataFrame, on: Sequence[str], marks: tuple[str, str]) -> DataFrame:
    left, right = suffix_clashes(left, right, on, marks)
    return _null_safe(left, right, list(on), "inner")


def join_groups(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on ``on``; NULL keys match."""
    return _null_safe(left, right, on, "left")


def daily_onto_hourly(hourly: DataFrame, daily: DataFrame, on: Sequence[str]) -> DataFrame:
    """Repeat each day's values on its hours; days without an entry drop out, NULL keys match."""
    return _null_safe(hourly, daily, list(on), "inner")


def rows_not_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that have no equal row in ``right`` (NULL equals NULL, duplicates stay)."""
    return keep_members(left, right, left.columns, inside=False)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` absent from ``right`` (NULL equals NULL).

    Copies are merged on both sides first, so a row with very many copies never
    travels as such.
    """
    return left.distinct().subtract(right.select(*left.columns).distinct())


def stack_rows(frames: Sequence[DataFrame], fill_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def _with_hit(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    entries = members.select(*on).distinct().withColumn("__hit", F.lit(True))
    return look_up(df, entries, on)


def keep_members(df: DataFrame, members: DataFrame, on: Sequence[str], *, inside: bool = True) -> DataFrame:
    """Rows whose key is (not) in ``members``; NULL equals NULL."""
    hit = F.col("__hit").isNotNull()
    return _with_hit(df, members, on).where(hit if inside else ~hit).drop("__hit")


def member_flag(df: DataFrame, members: DataFrame, on: Sequence[str], into: str = "in_train",
                also: str | None = None) -> DataFrame:
    """Is the row's key in ``members``?  False where ``also`` is missing."""
    flag = F.col("__hit").isNotNull()
    if also is not None:
        flag = flag & F.col(also).isNotNull()
    return _with_hit(df, members, on).withColumn(into, flag).drop("__hit")


def key_coverage(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """How many distinct keys of ``left`` occur in ``right``."""
    a = left.select(*on).distinct()
    b = right.select(*on).distinct().withColumn("__hit", F.lit(True))
    hit = F.col("__hit").isNotNull()
    return _null_safe(a, b, on, "left").groupBy(hit.alias("found")).agg(F.count(F.lit(1)).alias("n"))
