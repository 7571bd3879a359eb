"""Filling gaps: predictions, satellite rain, bias-corrected wind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapweave.functions import clock, moisture
from gapweave.functions.nullrules import lenient_sum, strict_sum
from gapweave.operators import quantiles
from gapweave.operators.attach import attach, largest_group, on_each_row
from gapweave.operators.quantiles import value_ranks

#: Hours of a day, and the missing one.
HOURS = 25


def fill(df: DataFrame, obs: str, pred: str, into: str, flag: str | None = "gapfill") -> DataFrame:
    """Observation where there is one, else prediction; optionally say which."""
    out = df.withColumn(into, F.coalesce(F.col(obs), F.col(pred)))
    return out.withColumn(flag, F.col(obs).isNull()) if flag else out


def fill_rain(df: DataFrame, keys: Sequence[str], time: str, gauge: str, satellite: str) -> DataFrame:
    """Half-hour rain to hours, gaps in the gauge filled by the satellite.

    The satellite gives mm per hour and missing half hours count as dry; one
    missing gauge half hour makes the gauge's hour missing.
    """
    hourly = df.groupBy(*keys, clock.floor_time(F.col(time), 60).alias(time)).agg(
        moisture.half_hour_rate_to_amount(lenient_sum(F.col(satellite))).alias("p_gpm"),
        strict_sum(F.col(gauge)).alias("p_mm_obs"))
    return fill(hourly, "p_mm_obs", "p_gpm", "p_mm_gf", flag=None)


def _runs(ranks: DataFrame, by: Sequence[str], value: str, into: str, blocks: int) -> DataFrame:
    """Runs of equal values ``into`` from place ``__at`` of their group's sorted order, cut where a block of places begins."""
    width = F.ceil(F.col("total") / blocks)
    block = F.explode(F.sequence(F.floor(F.col("below") / width), F.floor((F.col("upto") - 1) / width)))
    pieces = ranks.select(*by, F.col(value).alias(into), "below", width.alias("__width"), block.alias("__block"))
    return pieces.select(*by, "__block", F.greatest("below", F.col("__block") * F.col("__width")).alias("__at"), into)


def quantile_map(full: DataFrame, overlap: DataFrame, by: Sequence[str], model: str, obs: str, into: str, *,
                 bound: int | None = None) -> DataFrame:
    """Quantile delta mapping (Cannon, Sobie and Murdock 2015, additive form).

    Each modelled value keeps its distance from the modelled calibration
    quantile and takes the observed quantile of the same rank:
    ``x + Q_obs(tau) - Q_model(tau)`` with ``tau = (rank - 1) / (n - 1)`` in the
    full record (equal values share the lowest rank).  Quantiles are linear
    between neighbouring order statistics of the calibration rows, the rows of
    ``overlap`` with both values; no grid of nodes stands between.  A group
    without such a row has no result.

    Equal values stay one run, however many there are.  A wanted place meets the
    run that holds it in one sort of runs and places, in blocks of places that
    fit a task.
    """
    pairs = overlap.where(F.col(obs).isNotNull() & F.col(model).isNotNull())
    n_pairs, n_full = largest_group(pairs, by), largest_group(full, by)
    blocks = 1 + (n_pairs + n_full) // max(1, quantiles.GROUP_ROWS)
    seen = _runs(value_ranks(pairs, by, obs, bound=bound, largest=n_pairs), by, obs, "__o", blocks)
    made = _runs(value_ranks(pairs, by, model, bound=bound, largest=n_pairs), by, model, "__m", blocks)

    ranks = value_ranks(full, by, model, bound=bound, largest=n_full)
    sizes = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    placed = attach(ranks, sizes, by, bound=bound).where("__n IS NOT NULL")
    tau = F.when(F.col("total") > 1, F.col("below") / (F.col("total") - 1)).otherwise(F.lit(0.0))
    placed = placed.withColumn("__place", tau * (F.col("__n") - 1))
    low = F.floor("__place")
    # the place below and the one above, which may lie in the next block
    ends = F.explode(F.array(F.struct(F.lit(0).alias("up"), low.alias("at")),
                             F.struct(F.lit(1).alias("up"), F.least(low + 1, F.col("__n") - 1).alias("at"))))
    wanted = placed.select(*by, F.col(model).alias("__x"), F.col("n").alias("__weight"), (F.col("__place") - low).alias("__w"), "__n", ends.alias("__e"))
    wanted = wanted.select(*by, "__x", "__weight", "__w", F.col("__e.up").alias("__up"), F.col("__e.at").alias("__at"),
                           F.floor(F.col("__e.at") / F.ceil(F.col("__n") / blocks)).alias("__block"))

    # runs come before the places they begin at
    order = Window.partitionBy(*by, "__block").orderBy("__at", F.col("__up").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    together = wanted.unionByName(seen, allowMissingColumns=True).unionByName(made, allowMissingColumns=True)
    shift = F.last("__o", ignorenulls=True).over(order) - F.last("__m", ignorenulls=True).over(order)
    met = together.withColumn("__shift", shift).where("__up IS NOT NULL")
    lower, upper = F.max(F.when(F.col("__up") == 0, F.col("__shift"))), F.max(F.when(F.col("__up") == 1, F.col("__shift")))
    shifts = met.groupBy(*by, F.col("__x").alias(model)).agg(
        F.max("__weight").alias("__weight"), (lower + (upper - lower) * F.max("__w")).alias("__shift"))
    return attach(full, shifts, [*by, model], weight="__weight").withColumn(into, F.col(model) + F.col("__shift")).drop("__shift")


def fill_from_group_mean(df: DataFrame, by: Sequence[str], obs: str, pred: str, into: str, *,
                         short_groups: bool = False, bound: int | None = None) -> DataFrame:
    """Predict by covariate plus the group's mean offset from it, then fill."""
    offset = {"__offset": F.avg(F.col(obs) - F.col(pred))}
    out = on_each_row(df, by, offset, short_groups=short_groups, bound=bound)
    out = out.withColumn(f"{obs}_pred", F.col(pred) + F.coalesce("__offset", F.lit(0.0))).drop("__offset")
    return fill(out, obs, f"{obs}_pred", into)


def running_within(df: DataFrame, keys: Sequence[str], time: str, value: str, into: str) -> DataFrame:
    """Cumulative sum of an hourly series (bounded by the calendar)."""
    order = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(into, F.sum(value).over(order))
