"""Grouped reductions.

All of them are mergeable, so Spark combines on the map side and only one row
per task and group is shuffled, however large a group is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.functions import clock
from gapweave.functions.nullrules import numeric_columns

# Daily statistics in their stacking order.
DAILY_STATS = {"min": F.min, "mean": F.avg, "max": F.max}


def reduce_numeric(df: DataFrame, by: Sequence[str], skip: Sequence[str] = (), how=F.avg) -> DataFrame:
    """One statistic of every numeric column that is not a key."""
    columns = numeric_columns(df, skip=(*by, *skip))
    return df.groupBy(*by).agg(*[how(c).alias(c) for c in columns])


def hourly_mean(df: DataFrame, keys: Sequence[str], time: str, skip: Sequence[str] = (), *,
                rule: str = "nearest") -> DataFrame:
    """Mean of every numeric column per hour.

    ``nearest``  readings go to the nearest hour, a half hour to the later one
    ``on_hour``  only readings within a quarter hour of the full hour count
    ``clock``    all readings of the clock hour
    """
    t = F.col(time)
    if rule == "on_hour":
        slot = clock.round_time(t, 30)
        df = df.where(F.minute(slot) == 0).withColumn(time, slot)
    elif rule == "nearest":
        df = df.withColumn(time, clock.round_time(t, 60))
    elif rule == "clock":
        df = df.withColumn(time, clock.floor_time(t, 60))
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return reduce_numeric(df, [*keys, time], skip)


def daily_stats(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Daily min, mean and max in one pass, stacked under ``stat``."""
    wide = df.groupBy(*by).agg(*[
        how(v).alias(f"{stat}__{v}") for stat, how in DAILY_STATS.items() for v in values])
    layers = [F.struct(F.lit(stat).alias("stat"), *[F.col(f"{stat}__{v}").alias(v) for v in values])
              for stat in DAILY_STATS]
    return wide.select(*by, F.inline(F.array(*layers)))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column of the whole table, one row per column."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    return counts.unpivot(["n_rows"], columns, "column", "n_null").select("column", "n_null", "n_rows")


def frequencies(df: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def extent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[f(c).alias(f"{label}_{c}") for c in columns for label, f in (("min", F.min), ("max", F.max))])


def climatology(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Mean of each value and number of values per calendar group."""
    return df.groupBy(*by).agg(*[e for v in values for e in (F.avg(v).alias(v), F.count(v).alias(f"n_{v}"))])


def correlation(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation over the rows that hold both values."""
    return df.dropna(subset=[x, y]).groupBy(*by).agg(F.corr(x, y).alias("rho"), F.count(F.lit(1)).alias("n"))


def line_fit(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line ``y ~ x`` per group."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equal bins; bins 0 and ``bins + 1`` hold what lies outside."""
    bucket = F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins))
    return df.where(F.col(value).isNotNull()).groupBy(*by, bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def coarse(x: Column, per_unit: int = 5) -> Column:
    """Nearest multiple of ``1 / per_unit``, exact halves to the even multiple."""
    return F.bround(x * per_unit) / per_unit


def binned_error(df: DataFrame, obs: str, pred: str, per_unit: int = 5, by: Sequence[str] = ()) -> DataFrame:
    return (df.groupBy(*by, coarse(F.col(obs), per_unit).alias("obs_bin"))
            .agg(F.avg(F.abs(F.col(pred) - F.col(obs))).alias("mae"), F.count(F.lit(1)).alias("n")))


def totals(df: DataFrame, by: Sequence[str], sums: Mapping[str, Column], at_least: tuple[str, int] | None = None
           ) -> DataFrame:
    """Lenient sums per group, optionally only for groups with enough values of one column."""
    from gapweave.functions.nullrules import lenient_sum

    out = df.groupBy(*by).agg(*[lenient_sum(c).alias(n) for n, c in sums.items()],
                              *([F.count(at_least[0]).alias("nobs")] if at_least else []))
    return out.where(F.col("nobs") >= at_least[1]) if at_least else out
