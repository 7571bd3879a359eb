"""Model frame -> observed and predicted hourly product."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from gapweave.functions import naming
from gapweave.operators import evaluate, models, sampling
from gapweave.sources import layouts

#: Product names of predictions that differ from ``pred_<target>``.
PREDICTION_NAMES = {"vv": "pred_windspeed"}


def prediction_name(target: str) -> str:
    return PREDICTION_NAMES.get(target, f"pred_{target}")


def fit_targets(split: DataFrame, targets: Sequence[str] = layouts.TARGETS, same_rows_as: str | None = None,
                **search) -> dict[str, models.Search]:
    """One search per target on the training months.

    ``same_rows_as`` restricts every target to rows where that column is
    observed; by default each target uses all of its own observations.
    """
    inputs = naming.covariates(split.columns)
    train = split.where("part = 'train'")
    if same_rows_as:
        train = train.where(train[same_rows_as].isNotNull())

    def search_one(target: str) -> models.Search:
        return models.search_boosted(models.usable(train, target, "train"), target, inputs, **search)

    # searches of different targets do not depend on each other; Spark runs their jobs side by side,
    # all of them: with a few left for a second round the cores would wait for single chains of jobs
    with ThreadPool(len(targets)) as pool:
        found = pool.map(inheritable_thread_target(train.sparkSession)(search_one), targets)
    return dict(zip(targets, found))


def predict(frame: DataFrame, fitted: Mapping[str, models.Search]) -> DataFrame:
    """Observed and predicted columns on one row; one pass over the frame."""
    out = frame
    for target, search in fitted.items():
        out = models.score(search.best, out, prediction_name(target), search.covariates)
    base = ["site", "time_utc", "time_local", "date", "year", "month", "hour"]
    return out.select(*base, *fitted, *[prediction_name(t) for t in fitted])


def test_skill(split: DataFrame, fitted: Mapping[str, models.Search], target: str) -> DataFrame:
    held = models.usable(split.where("part = 'test'"), target, "test")
    search = fitted[target]
    return evaluate.skill(models.score(search.best, held, "pred", search.covariates), target, "pred")


def split_frame(frame: DataFrame, seed: int = models.SEED) -> DataFrame:
    return sampling.block_split(frame, "time_local", ["site", "time_utc"], seed)
