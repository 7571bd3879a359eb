"""Gap filling of single variables with smooth models, and of wind by quantile mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame

from gapweave.operators import gapfill, models, sampling, smooth

#: Share of the observed rows a smooth model is trained on; as many again test it.
TRAIN_SHARE = 0.3


def calendar_terms() -> dict[str, Column]:
    """Hour of day and month of year, both closing on themselves."""
    return {**models.cyclic("hour", 24), **models.cyclic("month", 12)}


def smooth_model(df: DataFrame, target: str, terms: Mapping[str, Column], keys: Sequence[str], *,
                 seed: int = models.SEED, ridge: float = 1e-6, **family) -> tuple[PipelineModel, DataFrame]:
    """Fit on a random share of the observed rows; also returns the test rows (with terms)."""
    whole = models.with_terms(models.usable(df, target, "train"), terms)
    train = sampling.take_fraction(whole, TRAIN_SHARE, keys, seed)
    rest = whole.where(sampling.draw(keys, seed) >= sampling.fraction_limit(TRAIN_SHARE))
    test = sampling.take_fraction(rest, TRAIN_SHARE / (1 - TRAIN_SHARE), keys, seed + 1)
    return models.fit_general(train, target, list(terms), ridge=ridge, **family), test


def smooth_fill(df: DataFrame, target: str, terms: Mapping[str, Column], keys: Sequence[str], **options) -> DataFrame:
    """``<target>``, ``<target>_pred``, ``<target>_gf`` and ``gapfill`` for every row; no prediction where a covariate lacks."""
    model, _ = smooth_model(df, target, terms, keys, **options)
    scored = models.score(model, models.with_terms(df, terms), f"{target}_pred", list(terms))
    return gapfill.fill(scored, target, f"{target}_pred", f"{target}_gf").select(
        *keys, target, f"{target}_pred", f"{target}_gf", "gapfill")


def additive_fill(df: DataFrame, target: str, terms: Sequence[smooth.Term], keys: Sequence[str], *, drop: bool = False) -> DataFrame:
    """As ``smooth_fill``, from an additive model of all observed rows whose smoothing the data choose."""
    observed = models.usable(df, target, "train")
    fitted = smooth.fit(smooth.gram(observed, smooth.prepare(terms, observed), target), drop=drop)
    filled = gapfill.fill(fitted.predict(df, f"{target}_pred"), target, f"{target}_pred", f"{target}_gf")
    return filled.select(*keys, target, f"{target}_pred", f"{target}_gf", "gapfill")


def corrected_wind(hours: DataFrame, keys: Sequence[str] = ("site", "date")) -> DataFrame:
    """Modelled wind ``ws`` and its version mapped to the observed wind ``vv``, per site and hour of day."""
    full = hours.where("ws IS NOT NULL")
    out = gapfill.quantile_map(full, full.where("vv IS NOT NULL"), ["site", "hour"], "ws", "vv", "ws_bc")
    return out.select(*keys, "ws", "ws_bc")
