"""Readers.

CSV columns are matched by header name and cast explicitly: no inference pass
over the data, and a file with a different column order reads the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gapweave.functions import clock, naming
from gapweave.functions.nullrules import nan_to_null
from gapweave.operators.clean import scale_units
from gapweave.operators.combine import stack_rows
from gapweave.sources import layouts


#: Above the size of any text file: a scan with this cost per file gives every file a task of its own.
_OWN_TASK = 1 << 40


def _first_lines(spark: SparkSession, paths: Sequence[str], name_pattern: str | None) -> list[Row]:
    """``path, line``: the first line with content of every file, in one job with a task per file.

    A task stops after that line, so little of a file is read.  A file without
    such a line is left out.  Names and header lines reach the driver, no data.
    """
    apart = spark.newSession()  # the settings of the caller's session stay as they are
    for name in ("maxPartitionBytes", "openCostInBytes"):
        apart.conf.set(f"spark.sql.files.{name}", _OWN_TASK)
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    reader = apart.read.option("pathGlobFilter", name_pattern) if name_pattern else apart.read

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, line in enumerate(batch.column("line").to_pylist()):
                if line.strip():
                    yield batch.slice(i, 1)
                    return

    lines = reader.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    return lines.mapInArrow(first, "path string, line string").collect()


def read_csv(spark: SparkSession, paths: str | Sequence[str], name_pattern: str | None = None) -> DataFrame:
    """Text columns under their header names; a folder may be narrowed by file name.

    Files with one header share a scan; scans of different headers are joined
    by name, and a column that a file lacks is NULL there.  A file that does not
    keep its header stops the job; one without a header line has no rows.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("enforceSchema", False)
    alike: dict[str, list[str]] = {}
    for row in sorted(_first_lines(spark, [paths] if isinstance(paths, str) else paths, name_pattern)):
        alike.setdefault(row["line"], []).append(unquote(row["path"]))  # the scan escapes names
    if not alike:
        raise FileNotFoundError(f"no file with a header at {paths}")
    # one file of each kind tells how its header line is read
    headers = [reader.csv(found[0]).columns for found in alike.values()]
    scans = [reader.schema(StructType([StructField(c, StringType()) for c in header])).csv(found)
             for header, found in zip(headers, alike.values())]
    return stack_rows(scans, fill_missing=True)


def cast_columns(df: DataFrame, names: Mapping[str, str], kinds: Mapping[str, str] | None = None) -> DataFrame:
    """Pick, rename and cast; unreadable values give NULL, NaN gives NULL."""
    kinds = kinds or {}
    picked = [F.col(f"`{old}`").try_cast(kinds.get(new, "double")).alias(new)
              for old, new in names.items() if old in df.columns]
    return nan_to_null(df.select(*picked))


_TEXT = {"site": "string", "clock": "string", "date": "timestamp_ntz", "day": "int", "month": "int", "year": "int"}


def with_calendar(df: DataFrame, time: str) -> DataFrame:
    p = clock.parts(F.col(time))
    return df.withColumns({k: p[k] for k in ("year", "month", "day", "hour")})


def read_station_log(spark: SparkSession, paths: str | Sequence[str], kind: str) -> DataFrame:
    """One station log in common names and units, with ``date`` on the station clock."""
    log = layouts.LOGS[kind]
    df = cast_columns(read_csv(spark, paths), log.names, _TEXT)
    if "clock" in df.columns:
        day = clock.date_from_parts(clock.full_year(F.col("year")), F.col("month"), F.col("day"))
        df = df.withColumn("date", F.when(day.isNotNull(), clock.from_clock_text(day, F.col("clock"))))
        df = df.drop("clock", "year", "month", "day")
    return with_calendar(scale_units(df, log.factors), "date")


def read_reanalysis(spark: SparkSession, folder: str, name_pattern: str | None = "ERA5-Land-hourly___*",
                    site: str | None = None) -> DataFrame:
    raw = read_csv(spark, folder, name_pattern).drop(*layouts.EXPORT_ONLY)
    df = cast_columns(raw, layouts.REANALYSIS, _TEXT).withColumnRenamed("date", "time_utc")
    return df.where(F.col("site") == site) if site else df


def read_satellite_rain(spark: SparkSession, path: str, site: str | None = None) -> DataFrame:
    df = cast_columns(read_csv(spark, path), layouts.SATELLITE_RAIN, _TEXT).withColumnRenamed("date", "time_utc")
    return df.where(F.col("site") == site) if site else df


def read_satellite_rain_by_id(spark: SparkSession, paths: Sequence[str], cell: str | None = None) -> DataFrame:
    """Older export: the time is the head of the record id; repeated records go."""
    raw = read_csv(spark, paths)
    df = raw.select(F.col("grid_cell").alias("site"),
                    clock.from_stamp_prefix(F.col("`system:index`")).alias("time_utc"),
                    F.col("precipitationCal").try_cast("double").alias("precip"))
    return nan_to_null(df.where(F.col("site") == cell) if cell else df).distinct()


def read_daily_rain(spark: SparkSession, path: str, site: str | None = None) -> DataFrame:
    df = cast_columns(read_csv(spark, path), layouts.DAILY_RAIN, {"site": "string", "date": "date"})
    return df.where(F.col("site") == site) if site else df


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet; only the named columns are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_grid(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Long-form grid table, best partitioned by ``variable`` and sorted by cell."""
    df = spark.read.parquet(path)
    return df.where(where) if where is not None else df


def with_file_variable(df: DataFrame, into: str = "variable") -> DataFrame:
    """Variable code from the name of the file a row came from."""
    return df.withColumn(into, naming.variable_of(F.col("_metadata.file_name")))


def variables_in(df: DataFrame) -> DataFrame:
    """Distinct variable codes of the files behind ``df``: from their names, no file is opened."""
    names = df.sparkSession.createDataFrame([(unquote(path.rsplit("/", 1)[-1]),) for path in df.inputFiles()], "name string")
    return names.select(naming.variable_of(F.col("name")).alias("variable")).where("variable IS NOT NULL").distinct()
