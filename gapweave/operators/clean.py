"""Outlier flags and period masks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.operators.attach import on_each_row

# A reading is bad this many standard deviations below / above its group mean.
LOWER_SD, UPPER_SD = 3.5, 3.0
# Months in which the 28 m humidity sensor is known to be wrong (year, first, last month).
BAD_HUMIDITY_PERIODS = ((2011, 4, 6), (2012, 6, 6), (2017, 3, 12))
#: 12 months and a missing one, 24 hours and a missing one.
MONTH_HOUR_GROUPS = 13 * 25


def with_group_stats(df: DataFrame, by: Sequence[str], value: str, *, short_groups: bool = False,
                     bound: int | None = None) -> DataFrame:
    """Mean and standard deviation of the row's group, next to the row."""
    stats = {f"u_{value}": F.avg(value), f"sigma_{value}": F.stddev_samp(value)}
    return on_each_row(df, by, stats, short_groups=short_groups, bound=bound)


def outlier_test(value: str, lower: float = LOWER_SD, upper: float = UPPER_SD) -> Column:
    x, mean, sd = F.col(value), F.col(f"u_{value}"), F.col(f"sigma_{value}")
    return (x < mean - lower * sd) | (x > mean + upper * sd)


def flag_outliers(df: DataFrame, by: Sequence[str], value: str, into: str = "bad", *,
                  short_groups: bool = False, bound: int | None = None) -> DataFrame:
    """``bad`` / ``good`` against the group climatology; a missing reading is good."""
    flag = F.when(outlier_test(value), "bad").otherwise("good")
    return with_group_stats(df, by, value, short_groups=short_groups, bound=bound).withColumn(into, flag)


def drop_flagged(value: str, flag: str = "bad") -> Column:
    return F.when(F.col(flag) != "bad", F.col(value))


def in_periods(year: Column, month: Column, periods: Iterable[tuple[int, int, int]]) -> Column:
    """Does the month fall in a period?  Unknown where missing parts leave it open."""
    return reduce(lambda a, b: a | b,
                  [(year == y) & (month >= first) & (month <= last) for y, first, last in periods])


def mask_periods(df: DataFrame, value: str, year: str = "year", month: str = "month",
                 periods: Iterable[tuple[int, int, int]] = BAD_HUMIDITY_PERIODS) -> DataFrame:
    """Null a sensor in its bad months, and where the date leaves that open."""
    bad = in_periods(F.col(year), F.col(month), periods)
    return df.withColumn(value, F.when(~bad, F.col(value)))


def anomaly(df: DataFrame, by: Sequence[str], value: str, *, short_groups: bool = False,
            bound: int | None = None) -> DataFrame:
    """Strict group mean (``<value>_u``) and distance from it (``<value>_anom``)."""
    x = F.col(value)
    means = {"__mean": F.avg(x), "__present": F.count(x), "__rows": F.count(F.lit(1))}
    out = on_each_row(df, by, means, short_groups=short_groups, bound=bound)
    whole = F.when(F.col("__present") == F.col("__rows"), F.col("__mean"))
    return (out.withColumn(f"{value}_u", whole).drop(*means)
            .withColumn(f"{value}_anom", x - F.col(f"{value}_u")))


def scale_units(df: DataFrame, factors: Mapping[str, float]) -> DataFrame:
    """Multiply columns by their source's unit factor."""
    return df.withColumns({c: F.col(c) * f for c, f in factors.items() if c in df.columns})
