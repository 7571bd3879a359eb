"""Writers.  Every task writes its own files; nothing is gathered first."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamped(df: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """Add the run date, the partition column of every product."""
    return df.withColumn("run_date", F.lit(run_date or dt.date.today()))


def write_parquet(df: DataFrame, path: str, *, run_date: dt.date | None = None, stamp: bool = True,
                  partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    out = stamped(df, run_date) if stamp else df
    writer = out.write.mode(mode).option("compression", "snappy")
    if stamp:
        # a rerun replaces its own day and leaves the others
        writer = writer.option("partitionOverwriteMode", "dynamic")
    by = [*(["run_date"] if stamp else []), *partition_by]
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, *, run_date: dt.date | None = None, stamp: bool = True,
              mode: str = "overwrite") -> None:
    out = stamped(df, run_date) if stamp else df
    writer = out.write.mode(mode).option("header", True)
    if stamp:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("run_date")
    writer.csv(path)


def write_grid(df: DataFrame, path: str) -> None:
    """Grid rows by variable, cells together, so a cell filter skips row groups.

    Range partitioning goes on into time, so a cell with very many rows is cut.
    """
    by = ["variable", "lon", "lat", "time_hours"]
    (df.repartitionByRange(*by).sortWithinPartitions(*by)
     .write.mode("overwrite").partitionBy("variable").parquet(path))
