"""Model frame -> daily min / mean / max product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapweave.functions import naming
from gapweave.functions.nullrules import numeric_columns
from gapweave.operators import checks, evaluate, models, sampling
from gapweave.operators.aggregate import daily_stats

#: The daily search: ten candidates.
CANDIDATES = {"depths": (3, 4, 5, 6, 7), "steps": (0.05, 0.1)}
#: Calendar and key columns that are no daily values.
_NOT_VALUES = ("year", "month", "day", "hour", "ddate")


def with_stat_code(days: DataFrame) -> DataFrame:
    """The statistic as a number, for the trees."""
    code = F.when(F.col("stat") == "min", 0.0).when(F.col("stat") == "mean", 1.0).otherwise(2.0)
    return days.withColumn("stat_code", code)


def complete_days(frame: DataFrame, target: str, n: int = 24, day: Sequence[str] = ("site", "date")) -> DataFrame:
    """Rows of days with exactly ``n`` observations.

    The count rides on the same partitioning the daily statistics use next, so
    the hours are shuffled once for both.
    """
    seen = F.count(target).over(Window.partitionBy(*day))
    return frame.withColumn("__seen", seen).where(F.col("__seen") == n).drop("__seen")


def daily(frame: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """Stacked statistics by site and station-clock date; the month follows from the date."""
    values = list(values or numeric_columns(frame, skip=_NOT_VALUES))
    return daily_stats(frame, ["site", "date"], values).withColumn("month", F.month("date"))


def run(frame: DataFrame, target: str = "t28m", *, hours: int = 24, values: Sequence[str] | None = None,
        seed: int = models.SEED, **search) -> tuple[DataFrame, models.Search, DataFrame]:
    """Fit on complete days, predict all days.  Returns the product, the search and the skill on held-out months."""
    days = with_stat_code(daily(complete_days(frame, target, hours), values))
    split = sampling.block_split(days, "date", ["site", "date", "stat"], seed).persist()
    train = models.usable(split.where("part = 'train'"), target, "train")
    checks.require_some_finite(train, target)
    inputs = naming.covariates(days.columns, extra=("month", "stat_code"))
    found = models.search_boosted(train, target, inputs, **{**CANDIDATES, **search})
    held = models.usable(split.where("part = 'test'"), target, "test")
    skill = evaluate.skill(models.score(found.best, held, "pred", inputs), target, "pred")
    skill = frame.sparkSession.createDataFrame(skill.collect(), skill.schema)  # one row; the split can go
    split.unpersist()
    out = models.score(found.best, with_stat_code(daily(frame, values)), f"pred_{target}", inputs)
    return out.select("site", "date", "stat", f"pred_{target}", target), found, skill
