"""Skill of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.functions import clock
from gapweave.operators.aggregate import line_fit
from gapweave.operators.rolling import extremes


def _error(obs: str, pred: str) -> Column:
    return F.col(pred) - F.col(obs)


def skill(df: DataFrame, obs: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Root mean squared error, bias, mean absolute error and squared correlation."""
    e = _error(obs, pred)
    held = df.where(F.col(obs).isNotNull() & F.col(pred).isNotNull())
    return held.groupBy(*by).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), F.avg(F.abs(e)).alias("mae"),
        F.pow(F.corr(obs, pred), 2).alias("r2"), F.count(F.lit(1)).alias("n"))


def rolling_extreme_error(df: DataFrame, keys: Sequence[str], time: str, obs: str, pred: str, member: str,
                          n: int = 72) -> DataFrame:
    """Mean absolute error of the trailing max, mean and min, inside and outside the training data."""
    rolled = extremes(df, keys, time, (obs, pred), n)
    rolled = rolled.where(F.col(f"{obs}_mean_{n}h").isNotNull())
    pairs = {"val_hi": "max", "val_mean": "mean", "val_lo": "min"}
    return rolled.groupBy(member).agg(*[
        F.avg(F.abs(F.col(f"{obs}_{stat}_{n}h") - F.col(f"{pred}_{stat}_{n}h"))).alias(name)
        for name, stat in pairs.items()], F.count(F.lit(1)).alias("n"))


def monthly_means(df: DataFrame, time: str, obs: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Monthly mean observed and predicted, and how many observations carry it."""
    month = F.trunc(F.to_date(F.col(time)), "month")
    return df.groupBy(*by, month.alias("month_start")).agg(
        F.avg(pred).alias("val_pred"), F.avg(obs).alias("val_obs"), F.count(obs).alias("nobs"))


def fit_lines(df: DataFrame, obs: str, pred: str, time: str, by: Sequence[str] = ("stat",)) -> DataFrame:
    """Observed against predicted, one line per year and statistic."""
    return line_fit(df.withColumn("year", clock.parts(F.col(time))["year"]), obs, pred, ("year", *by))
