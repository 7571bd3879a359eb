"""Data checks that stop a job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataCheckError(ValueError):
    """A precondition of a job does not hold for its data."""


def count_violations(df: DataFrame, rules: Mapping[str, Column]) -> dict[str, int]:
    """Rows breaking each rule, all in one pass; unknown is not a violation."""
    row = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()]).first()
    return row.asDict()


def require(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    broken = {name: n for name, n in count_violations(df, rules).items() if n}
    if broken:
        raise DataCheckError(f"rows breaking rules: {broken}")
    return df


def require_some_finite(df: DataFrame, column: str) -> DataFrame:
    """At least one value must be finite."""
    x = F.col(column)
    finite = df.agg(F.count_if(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).first()[0]
    if not finite:
        raise DataCheckError(f"{column} has no finite value")
    return df


def warm(column: str) -> Column:
    """Temperatures for which the humidity formula holds."""
    return F.col(column) >= 0
