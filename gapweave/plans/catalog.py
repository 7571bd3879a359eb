"""Registry of checked queries.

Each query runs operators of this package over whole input tables; most come
with the SQL that another engine runs on the same tables for comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The input tables of one data folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, rounded: Sequence[str] = (), name: str | None = None):
    """Register ``f(tables) -> DataFrame``.

    ``rounded`` columns are cut to six decimals on both sides, because the
    engines add floating-point numbers in different orders.
    """

    def register(f: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = f(Tables(spark, folder))
            return df.withColumns({c: F.round(F.col(c), 6) + F.lit(0.0) for c in rounded})

        text = sql
        if sql is not None and rounded:
            swaps = ", ".join(f"round({c}, 6) + 0.0::DOUBLE AS {c}" for c in rounded)
            text = f"SELECT * REPLACE ({swaps}) FROM ({sql}) AS q"
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(run, text)
        return f

    return register


def load() -> dict[str, Query]:
    """All queries; importing the modules registers them."""
    from gapweave.plans import (  # noqa: F401
        queries_checks,
        queries_cleaning,
        queries_filling,
        queries_models,
        queries_relating,
        queries_series,
        queries_smooth,
        queries_summaries,
    )

    return QUERIES
