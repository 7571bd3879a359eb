"""Regression of station variables on covariates with MLlib.

Training data stays distributed; the driver sees fitted models and metrics.
Trees cannot take missing inputs, so covariates are completed with their mean
and, where asked, get a missing-flag column next to them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.session import use_checkpoints

# Rows of each target that training / testing may use.
TARGET_RULES: dict[str, tuple[str, str]] = {
    "t28m": ("true", "true"),
    "vpd28m": ("vpd28m > 0", "vpd28m > 0"),
    "rh28m": ("rh28m < 100", "rh28m > 0"),
    "rad_global": ("true", "true"),
    "precip": ("true", "true"),
    "vv": ("true", "true"),
}
# Fixed value: seed of the model searches.
SEED = 3
#: Training rows worth a task of their own.
PARTITION_ROWS = 50_000


def usable(df: DataFrame, target: str, phase: str) -> DataFrame:
    """Rows of ``train`` or ``test`` that the target's rule admits."""
    rule = TARGET_RULES.get(target, ("true", "true"))[0 if phase == "train" else 1]
    return df.where(F.col(target).isNotNull()).where(rule)


def _private(columns: Sequence[str]) -> list[str]:
    return [f"__x_{c}" for c in columns]


def _features(covariates: Sequence[str]) -> list:
    filled = [f"__f_{c}" for c in covariates]
    return [Imputer(inputCols=_private(covariates), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="__features")]


def with_inputs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Model inputs as doubles in columns of their own; the frame's columns keep their types."""
    return df.withColumns({x: F.col(c).cast("double") for c, x in zip(columns, _private(columns))})


@dataclass
class Search:
    """A fitted model search."""

    best: PipelineModel
    covariates: Sequence[str]
    scores: list[tuple[str, float]] = field(default_factory=list)

    def leaderboard(self, spark) -> DataFrame:
        """Candidates, best (lowest error) first; one row per grid point."""
        rows = sorted(self.scores, key=lambda r: r[1])
        return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], "place int, params string, rmse double")

    def importance(self, spark) -> DataFrame:
        return importance(spark, self.best, self.covariates)


@contextmanager
def kept(train: DataFrame, covariates: Sequence[str], target: str, extra: Sequence[Column] = (), cut: bool = False):
    """Target and inputs as doubles, kept while a model iterates over them.

    Every iteration runs a few jobs, so a small set should not be spread over
    more tasks than it has work for; a large one keeps its partitions.  With
    ``cut`` the rows are checkpointed in the same order: jobs that come by the
    thousand then do not carry the plan that made the rows, whose stages grow
    with the input.
    """
    picked = with_inputs(train, covariates).withColumn(target, F.col(target).cast("double"))
    data = picked.select(*_private(covariates), target, *extra).persist()
    try:
        few = data.coalesce(1 + data.count() // PARTITION_ROWS)
        yield few.checkpoint() if cut else few
    finally:
        data.unpersist()


def fold_of(columns: Sequence[str], folds: int) -> Column:
    """Cross-validation fold: whole months take turns, so neighbouring hours share a fold.

    Without a calendar among ``columns`` a hash of all of them decides.  Either
    way the fold belongs to the row, however the rows are partitioned.
    """
    if "year" in columns and "month" in columns:
        number = F.col("year").cast("long") * 12 + F.col("month").cast("long")
    elif "date" in columns:
        number = F.year("date").cast("long") * 12 + F.month("date").cast("long")
    else:
        number = F.xxhash64(*columns)
    return F.pmod(F.coalesce(number, F.lit(0)), F.lit(folds)).cast("int")


def _search(train: DataFrame, target: str, covariates: Sequence[str], model, grid, folds: int,
            parallelism: int) -> Search:
    """Best of the grid by error across folds of months; a single candidate is fitted once, on all rows."""
    stages = Pipeline(stages=[*_features(covariates), model])
    evaluator = RegressionEvaluator(labelCol=target, predictionCol="__pred", metricName="rmse")
    named = [", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)) for m in grid]
    boosted = isinstance(model, GBTRegressor)  # a few jobs per tree and candidate
    with kept(train, covariates, target, [fold_of(train.columns, folds).alias("__fold")], cut=boosted) as data:
        if len(grid) == 1:
            best = stages.fit(data, grid[0])
            return Search(best, list(covariates), [(named[0], float(evaluator.evaluate(best.transform(data))))])
        # folds without rows are left out: a short record has few months
        present = sorted(r[0] for r in data.select("__fold").distinct().collect())
        places = {old: new for new, old in enumerate(present)}
        if len(places) < 2:
            raise ValueError("a search needs training rows of two months at least")
        data = data.replace(places, subset=["__fold"]) if len(places) < folds else data
        if boosted and data.rdd.getNumPartitions() == 1:  # a candidate's jobs fill one core: all go side by side
            parallelism = max(parallelism, len(grid))
        search = CrossValidator(estimator=stages, estimatorParamMaps=grid, evaluator=evaluator, numFolds=len(places),
                                parallelism=parallelism, seed=SEED, foldCol="__fold")
        found: CrossValidatorModel = search.fit(data)
    return Search(found.bestModel, list(covariates), list(zip(named, map(float, found.avgMetrics))))


def search_boosted(train: DataFrame, target: str, covariates: Sequence[str], *, depths: Sequence[int] = (3, 5, 7),
                   steps: Sequence[float] = (0.1,), rates: Sequence[float] = (0.8,),
                   subsets: Sequence[str] = ("0.8",), trees: int = 50, folds: int = 3,
                   parallelism: int = 4) -> Search:
    """Boosted trees over a grid; the grid's size is the number of models tried.

    Folds are the same however the rows are partitioned.  The trees draw their
    row samples per partition, so with a rate below one they still vary with
    the partitioning.
    """
    use_checkpoints(train.sparkSession)
    model = GBTRegressor(labelCol=target, featuresCol="__features", predictionCol="__pred", maxIter=trees, seed=SEED)
    grid = (ParamGridBuilder().addGrid(model.maxDepth, list(depths)).addGrid(model.stepSize, list(steps))
            .addGrid(model.subsamplingRate, list(rates)).addGrid(model.featureSubsetStrategy, list(subsets)).build())
    return _search(train, target, covariates, model, grid, folds, parallelism)


def search_linear(train: DataFrame, target: str, covariates: Sequence[str], *,
                  penalties: Sequence[float] = (0.0, 0.01, 0.1), mixes: Sequence[float] = (0.0, 0.5, 1.0),
                  folds: int = 3, parallelism: int = 4) -> Search:
    """Elastic-net linear models over a grid."""
    model = LinearRegression(labelCol=target, featuresCol="__features", predictionCol="__pred")
    grid = (ParamGridBuilder().addGrid(model.regParam, list(penalties))
            .addGrid(model.elasticNetParam, list(mixes)).build())
    return _search(train, target, covariates, model, grid, folds, parallelism)


def fit_forest(train: DataFrame, target: str, covariates: Sequence[str], *, trees: int = 50,
               depth: int = 8) -> PipelineModel:
    model = RandomForestRegressor(labelCol=target, featuresCol="__features", predictionCol="__pred",
                                  numTrees=trees, maxDepth=depth, seed=SEED)
    with kept(train, covariates, target) as data:
        return Pipeline(stages=[*_features(covariates), model]).fit(data)


def fit_linear(train: DataFrame, target: str, covariates: Sequence[str]) -> PipelineModel:
    """All covariates, additive and straight."""
    model = LinearRegression(labelCol=target, featuresCol="__features", predictionCol="__pred")
    with kept(train, covariates, target) as data:
        return Pipeline(stages=[*_features(covariates), model]).fit(data)


def fit_general(train: DataFrame, target: str, terms: Sequence[str], *, family: str = "gaussian",
                link: str = "identity", ridge: float = 0.0) -> PipelineModel:
    """Generalised linear model on term columns; rows that lack a term take no part."""
    model = GeneralizedLinearRegression(labelCol=target, featuresCol="__features", predictionCol="__pred",
                                        family=family, link=link, regParam=ridge, maxIter=50)
    assemble = VectorAssembler(inputCols=_private(terms), outputCol="__features", handleInvalid="keep")
    whole = train.dropna(subset=[*terms, target])
    with kept(whole, terms, target) as data:
        return Pipeline(stages=[assemble, model]).fit(data)


def score(model: PipelineModel, df: DataFrame, into: str, covariates: Sequence[str]) -> DataFrame:
    """Add predictions as a column; rows stay where they are, and all columns keep their types.

    A row that lacks a term of a generalised linear model has no prediction.
    """
    scored = model.transform(with_inputs(df, covariates))
    return scored.select(*df.columns, F.when(~F.isnan("__pred"), F.col("__pred")).alias(into))


def importance(spark, model: PipelineModel, covariates: Sequence[str]) -> DataFrame:
    weights = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(c, float(w)) for c, w in zip(covariates, weights)],
                                 "covariate string, importance double").orderBy(F.desc("importance"))


# --- smooth terms -----------------------------------------------------------

def cyclic(x: str, period: int, waves: int = 2) -> dict[str, Column]:
    """Smooth effect that closes on itself: sine and cosine pairs."""
    out = {}
    for k in range(1, waves + 1):
        angle = F.col(x) * (2 * 3.141592653589793 * k / period)
        out[f"{x}_sin{k}"], out[f"{x}_cos{k}"] = F.sin(angle), F.cos(angle)
    return out


def spline(x: str, knots: Sequence[float]) -> dict[str, Column]:
    """Cubic through the origin with a bend at every knot, on a scale of about one."""
    width = (max(knots) - min(knots)) or 1.0
    u = (F.col(x) - min(knots)) / width
    out = {f"{x}_p{k}": F.pow(u, k) for k in (1, 2, 3)}
    for i, knot in enumerate(knots[1:-1]):
        over = F.greatest(u - (knot - min(knots)) / width, F.lit(0.0))
        out[f"{x}_k{i}"] = F.pow(over, 3)
    return out


def tensor(*margins: Mapping[str, Column]) -> dict[str, Column]:
    """All products of one term from each margin, margins included."""
    out = dict(margins[0])
    for margin in margins[1:]:
        crossed = {f"{a}_x_{b}": out[a] * margin[b] for a in out for b in margin}
        out = {**out, **margin, **crossed}
    return out


def knots(df: DataFrame, x: str, n: int = 5) -> list[float]:
    """Evenly ranked knots (``n`` numbers reach the driver)."""
    points = df.agg(F.percentile_approx(x, F.array(*[F.lit(i / (n - 1)) for i in range(n)]))).first()[0]
    return sorted(set(points or [0.0, 1.0]))


def with_terms(df: DataFrame, terms: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(terms))


def rank_by_aic(spark, fitted: Mapping[str, PipelineModel]) -> DataFrame:
    """Models by Akaike's criterion, best first, with the distance from the best."""
    aic = sorted(((name, float(m.stages[-1].summary.aic)) for name, m in fitted.items()), key=lambda r: r[1])
    rows = [(i + 1, name, a, a - aic[0][1]) for i, (name, a) in enumerate(aic)]
    return spark.createDataFrame(rows, "place int, model string, aic double, delta double")
