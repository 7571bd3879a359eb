"""Station logs -> cleaned station record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.operators import blocks, clean
from gapweave.operators.aggregate import hourly_mean
from gapweave.operators.combine import stack_rows
from gapweave.sources import layouts, readers


def harmonise(logs: Sequence[DataFrame], site: str) -> DataFrame:
    """Stack yearly logs; a sensor a year did not have is NULL."""
    record = stack_rows(list(logs), fill_missing=True)
    missing = [c for c in layouts.STATION_COLUMNS if c not in record.columns]
    record = record.withColumns({c: F.lit(None).cast("double") for c in missing})
    return record.select(F.lit(site).alias("site"), "date", "year", "month", "day", "hour", *layouts.STATION_COLUMNS)


def remove_outliers(record: DataFrame) -> DataFrame:
    """Null temperature outliers and humidity in its bad months.

    Both flags are kept (``bad_rh28m``, ``bad``); the humidity flag nulls
    nothing, that sensor is masked by period only.
    """
    by = ["site", "month", "hour"]
    out = clean.flag_outliers(record, by, "rh28m", into="bad_rh28m")
    out = clean.mask_periods(out, "rh28m")
    out = clean.flag_outliers(out, by, "t28m", into="bad")
    return out.withColumn("t28m", clean.drop_flagged("t28m"))


def hourly_recent(log: DataFrame, site: str, ties: Sequence[str] = ()) -> DataFrame:
    """Recent log to hours: step and lag of the raw series first, then the mean of each nearest hour."""
    log = log.withColumn("site", F.lit(site))
    log = blocks.previous(log, ["site"], "date", ["t28m"], ties, difference={"t28m": "delta_t28"})
    log = log.withColumnRenamed("t28m_l1", "t_l1").where(F.col("date").isNotNull())
    hourly = hourly_mean(log, ["site"], "date", skip=("year", "month", "day", "hour"))
    return readers.with_calendar(hourly, "date")


def hourly_record(record: DataFrame) -> DataFrame:
    """Older logs to hours: readings within a quarter hour of the full hour."""
    return hourly_mean(record, ["site"], "date", skip=("year", "month", "day", "hour"), rule="on_hour")


def station_hours(older: DataFrame, recent: DataFrame) -> DataFrame:
    """Older and recent hourly records as one; a sensor one of them lacks is NULL."""
    return stack_rows([older, recent], fill_missing=True)
