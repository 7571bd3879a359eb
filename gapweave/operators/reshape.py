"""Wide <-> long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions.naming import label_from, starting_with

# Marks in product column names and what they stand for.
STAT_MARKS = {"max": "max", "mean": "mean", "min": "min"}
ORIGIN_MARKS = {"obs_": "observation", "pred_": "prediction"}


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "name",
            value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def decoded_long(df: DataFrame, ids: Sequence[str], starts: Sequence[str] = ("obs_", "pred_")) -> DataFrame:
    """Stack observed and predicted columns and decode statistic and origin from their names."""
    long = to_long(df, ids, starting_with(df.columns, *starts))
    return long.withColumns({"stat": label_from(F.col("name"), STAT_MARKS),
                             "origin": label_from(F.col("name"), ORIGIN_MARKS)})


def to_wide(df: DataFrame, ids: Sequence[str], name: str, names: Sequence[str], value: str, how=F.first) -> DataFrame:
    """One column per listed name; the list is given, so no extra pass looks for it."""
    return df.groupBy(*ids).pivot(name, list(names)).agg(how(value))
