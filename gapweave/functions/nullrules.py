"""The three missing-value rules of met records, spelled out once.

lenient  nulls are skipped (``avg``); a sum of nothing is 0
strict   one null makes the whole result null
guarded  a moving frame counts only when it is full and has no null
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN sorts above every number in Spark, so it must go on ingest."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floating})


def lenient_sum(x: Column) -> Column:
    return F.coalesce(F.sum(x), F.lit(0.0))


def strict_sum(x: Column) -> Column:
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))


def strict_mean(x: Column) -> Column:
    return F.when(F.count(x) == F.count(F.lit(1)), F.avg(x))


def present(x: Column) -> Column:
    """Number of values that are there."""
    return F.count(x)


def guarded(aggregate: Column, x: Column, window, n: int) -> Column:
    """``aggregate`` over ``window`` where it holds ``n`` values, else NULL."""
    return F.when(F.count(x).over(window) == n, aggregate.over(window))


def choose(condition: Column, yes: Column, no: Column) -> Column:
    """Two-way choice in which an unknown condition gives an unknown result."""
    return F.when(condition, yes).when(~condition, no)


def numeric_columns(df: DataFrame, skip: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]
