"""File-to-file jobs; each returns what it wrote or learned."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.operators import gapfill, grid
from gapweave.plans import daily, filling, frame, hourly, merged, station
from gapweave.sources import layouts, readers, writers


def clean_station(spark: SparkSession, logs: Mapping[str, str | Sequence[str]], site: str, out: str,
                  run_date: dt.date | None = None) -> None:
    """Yearly logs (``{kind: paths}``) -> cleaned record."""
    record = station.harmonise([readers.read_station_log(spark, p, kind) for kind, p in logs.items()], site)
    writers.write_parquet(station.remove_outliers(record), out, run_date=run_date)


def clean_recent(spark: SparkSession, log: str | Sequence[str], site: str, out: str,
                 run_date: dt.date | None = None) -> None:
    """Recent log -> hourly record."""
    hours = station.hourly_recent(readers.read_station_log(spark, log, "2021"), site)
    writers.write_parquet(hours, out, run_date=run_date)


def latest(df: DataFrame) -> DataFrame:
    """Rows of the last run date (one small value comes back; the scan then reads that partition only)."""
    last = df.agg(F.max("run_date")).first()[0]
    return df.where(F.col("run_date") == F.lit(last)).drop("run_date")


def build_frame(spark: SparkSession, site: str, *, reanalysis: str, satellite: str, daily_rain: str, record: str,
                recent: str | None = None) -> DataFrame:
    """Covariate files and cleaned records -> model frame."""
    covariate = frame.covariates(readers.read_reanalysis(spark, reanalysis, site=site),
                                 readers.read_satellite_rain(spark, satellite, site),
                                 readers.read_daily_rain(spark, daily_rain, site))
    hours = station.hourly_record(latest(readers.read_table(spark, record)).where(F.col("site") == site))
    if recent:
        hours = station.station_hours(hours, latest(readers.read_table(spark, recent)).where(F.col("site") == site))
    return frame.model_frame(covariate, hours)


def hourly_product(dat: DataFrame, out: str, targets: Sequence[str] = layouts.TARGETS, *,
                   run_date: dt.date | None = None, same_rows_as: str | None = None, **search) -> dict[str, DataFrame]:
    """Fit, predict and write the hourly product (Parquet and CSV); returns the test skill per target."""
    split = hourly.split_frame(dat).persist()
    try:
        fitted = hourly.fit_targets(split, targets, same_rows_as, **search)
        writers.write_parquet(hourly.predict(dat, fitted), f"{out}/parquet", run_date=run_date)
        # the CSV is written from what was just written, not computed again
        writers.write_csv(latest(readers.read_table(dat.sparkSession, f"{out}/parquet")), f"{out}/csv", run_date=run_date)
        skill = {}
        for t in targets:  # one row each, taken while the split is kept
            found = hourly.test_skill(split, fitted, t)
            skill[t] = dat.sparkSession.createDataFrame(found.collect(), found.schema)
    finally:
        split.unpersist()
    return skill


def daily_product(dat: DataFrame, out: str, target: str = "t28m", *, run_date: dt.date | None = None,
                  **search) -> dict[str, DataFrame]:
    """Fit, predict and write the daily product (CSV); returns leaderboard, importance and held-out skill."""
    spark = dat.sparkSession
    product, found, skill = daily.run(dat, target, **search)
    writers.write_csv(product, out, run_date=run_date)
    return {"leaderboard": found.leaderboard(spark), "importance": found.importance(spark), "skill": skill}


def cell_product(spark: SparkSession, grid_path: str, out: str, *, lon: float = grid.CELL_LON, lat: float = grid.CELL_LAT,
                 variables: Sequence[str] | None = None, run_date: dt.date | None = None) -> None:
    """Long-form grid -> series of the station's cell, a folder per variable; one pass over the cell's row groups."""
    rows = readers.read_grid(spark, grid_path, F.col("variable").isin(list(variables)) if variables else None)
    writers.write_parquet(grid.select_cell(rows, lon, lat), out, run_date=run_date, partition_by=["variable"])


def rain_product(spark: SparkSession, half_hours: str, out: str, *, run_date: dt.date | None = None) -> None:
    """Half hours of gauge (``precip``) and satellite (``g_p``) rain by site and ``date`` -> hours, gaps filled."""
    hours = gapfill.fill_rain(readers.read_table(spark, half_hours, ["site", "date", "precip", "g_p"]), ["site"], "date", "precip", "g_p")
    writers.write_parquet(hours, out, run_date=run_date)


def smooth_product(spark: SparkSession, frame_path: str, target: str, terms: Mapping[str, Column], out: str, *,
                   run_date: dt.date | None = None, **options) -> None:
    """Model frame -> one variable observed, predicted by a smooth model, and filled."""
    filled = filling.smooth_fill(readers.read_table(spark, frame_path), target, terms, ["site", "date"], **options)
    writers.write_parquet(filled, out, run_date=run_date)


def wind_product(spark: SparkSession, hours_path: str, out: str, *, run_date: dt.date | None = None) -> None:
    """Modelled and observed wind by site, date and hour -> modelled and corrected wind."""
    hours = readers.read_table(spark, hours_path, ["site", "date", "hour", "ws", "vv"])
    writers.write_parquet(filling.corrected_wind(hours), out, run_date=run_date)


def merged_product(spark: SparkSession, inputs: Mapping[str, str], out: str, *, run_date: dt.date | None = None,
                   check: bool = True) -> None:
    """Filled variables (``{name of merge's input: path}``, last run date of each) -> merged product, Parquet and CSV.

    The join runs once: the CSV is written from the Parquet files.
    """
    tables = {}
    for name, path in inputs.items():
        df = readers.read_table(spark, path)
        tables[name] = latest(df) if "run_date" in df.columns else df
    writers.write_parquet(merged.merge(**tables, check=check), f"{out}/parquet", run_date=run_date)
    written = latest(readers.read_table(spark, f"{out}/parquet"))
    writers.write_csv(written, f"{out}/csv", run_date=run_date)
