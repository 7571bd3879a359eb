"""Trailing row frames on hourly and daily series.

Input has one row per series and hour (or day), so a series is at most 8,784
rows a year however much raw data went into it: one window per series is
bounded by the calendar.  All frames of a call share one sort.  Raw series go
through ``blocks.roll`` instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gapweave.functions import clock
from gapweave.functions.nullrules import guarded
from gapweave.operators.combine import join_groups

_AGGREGATES = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min}


def frame_columns(order: WindowSpec, frames: Mapping[str, tuple[str, str, int]]) -> dict[str, Column]:
    """``{name: (value, aggregate, n)}`` -> guarded columns over the last n rows."""
    return {
        name: guarded(_AGGREGATES[how](F.col(value)), F.col(value), order.rowsBetween(1 - n, 0), n)
        for name, (value, how, n) in frames.items()
    }


def roll_series(df: DataFrame, keys: Sequence[str], time: str,
                frames: Mapping[str, tuple[str, str, int]]) -> DataFrame:
    return df.withColumns(frame_columns(Window.partitionBy(*keys).orderBy(time), frames))


def extremes(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], n: int = 72) -> DataFrame:
    """Trailing max, mean and min of each value over ``n`` rows."""
    frames = {f"{v}_{label}_{n}h": (v, how, n)
              for v in values for label, how in (("max", "max"), ("mean", "avg"), ("min", "min"))}
    return roll_series(df, keys, time, frames)


def deaccumulate(df: DataFrame, keys: Sequence[str], order: str, value: str, into: str) -> DataFrame:
    """Step of an accumulated forecast quantity from one lead to the next.

    ``keys`` names one forecast run; a run has a handful of leads.
    """
    return df.withColumn(into, F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(order)))


def fill_hours(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Add the missing hours of each series, so that row frames are time frames.

    Every row stays: in a series with a NULL key, off the full hour, or without
    a time.  Only clock hours without any row are added.
    """
    hour = clock.floor_time(F.col(time), 60)
    timed = df.where(F.col(time).isNotNull()).withColumn("__hour", hour)
    spans = timed.groupBy(*keys).agg(F.min("__hour").alias("__from"), F.max("__hour").alias("__to"))
    hours = F.floor(clock.elapsed_seconds(F.col("__to"), F.col("__from")) / 3600).cast("int")
    grid = spans.select(*keys, "__from", F.explode(F.sequence(F.lit(0), hours)).alias("__h"))
    grid = grid.select(*keys, clock.add("HOUR", F.col("__h"), F.col("__from")).alias("__hour"))
    joined = join_groups(grid, timed, [*keys, "__hour"])
    filled = joined.withColumn(time, F.coalesce(F.col(time), F.col("__hour"))).select(*df.columns)
    return filled.unionByName(df.where(F.col(time).isNull()))
