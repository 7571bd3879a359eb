"""Repeatable samples and splits.

Randomness is a hash of a row's key and a seed: the same rows are chosen on any
number of executors, and again when a lost task is run a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapweave.functions import clock
from gapweave.operators.attach import attach

#: Calendar months a four-digit year can name.
MONTHS = 12 * 10_000
#: Hex digits of the hash looked at per counting pass (65,536 steps).
_DIGITS = 4
#: A step with no more rows than this is sorted instead of counted further.
_SORT_ROWS = 100_000


def draw(keys: Sequence[str], seed: int) -> Column:
    """Hash of the key as a 32-digit hex text; its order is the random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def fraction_limit(fraction: float) -> str:
    """Hash text below which ``fraction`` of all hashes lie."""
    return format(min(int(fraction * 16**8), 16**8 - 1), "08x")


def take_fraction(df: DataFrame, fraction: float, keys: Sequence[str], seed: int) -> DataFrame:
    """About ``fraction`` of the rows."""
    if fraction >= 1:
        return df
    return df.where(draw(keys, seed) < fraction_limit(fraction))


def draw_limit(df: DataFrame, keys: Sequence[str], seed: int, *, n: int | None = None,
               fraction: float | None = None) -> str:
    """Hash of the ``n``-th row (or ``floor(fraction * rows)``-th) in hash order; empty text for none.

    The hash is counted on a coarse scale, then the step holding the n-th row
    on a finer one, until few rows are left to sort.  Three passes reach one
    row in 10^14; each shuffles at most 65,536 counts per task.
    """
    drawn = df.select(draw(keys, seed).alias("draw"))
    prefix, left = "", n
    while True:
        step = F.substring("draw", 1, len(prefix) + _DIGITS)
        counts = drawn.where(F.col("draw").startswith(prefix)).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("c"))
        steps = sorted(counts.collect())  # 65,536 at the most
        if left is None:
            left = int(fraction * sum(c for _, c in steps))
        left = min(left, sum(c for _, c in steps))
        if left <= 0:
            return ""
        for edge, c in steps:
            if left <= c:
                break
            left -= c
        prefix = edge
        if len(prefix) == 32:
            return prefix
        if c <= _SORT_ROWS:
            break
    last = drawn.where(F.col("draw").startswith(prefix)).orderBy("draw").limit(left)
    return last.agg(F.max("draw")).first()[0]


def mark_exactly(df: DataFrame, keys: Sequence[str], seed: int, *, n: int | None = None,
                 fraction: float | None = None, into: str = "chosen") -> DataFrame:
    """Mark exactly ``n`` rows (or ``floor(fraction * rows)``) by hash order.

    ``keys`` identify a row; rows that share a key share their fate.  The rows
    themselves are not shuffled.
    """
    return df.withColumn(into, draw(keys, seed) <= F.lit(draw_limit(df, keys, seed, n=n, fraction=fraction)))


def take_exactly(df: DataFrame, n: int, keys: Sequence[str], seed: int) -> DataFrame:
    return mark_exactly(df, keys, seed, n=n).where("chosen").drop("chosen")


def month_sets(df: DataFrame, time: str, seed: int, train_share: float = 0.9) -> DataFrame:
    """Year-months with the flag ``in_train_months``: ``floor(share * months)`` are drawn.

    Ranks at most one row per calendar month.
    """
    months = df.select(clock.year_month(F.col(time)).alias("ym")).where("ym <> ''").distinct()
    ranked = months.withColumn("__r", F.row_number().over(Window.orderBy(draw(["ym"], seed))))
    size = F.count(F.lit(1)).over(Window.partitionBy())
    return ranked.select("ym", (F.col("__r") <= F.floor(size * F.lit(train_share))).alias("in_train_months"))


def block_split(df: DataFrame, time: str, keys: Sequence[str], seed: int, train_share: float = 0.9) -> DataFrame:
    """Label rows ``train`` / ``test`` / ``valid``.

    Whole year-months go to training, so that neighbouring hours of an
    autocorrelated series do not leak across; the held-out rows are halved.
    Rows without a time are held out.
    """
    months = month_sets(df, time, seed, train_share).persist()
    labelled = attach(df.withColumn("ym", clock.year_month(F.col(time))), months, ["ym"], bound=MONTHS)
    in_train = F.coalesce("in_train_months", F.lit(False))
    limit = draw_limit(labelled.where(~in_train), keys, seed + 1, fraction=0.5)
    part = F.when(in_train, "train").when(draw(keys, seed + 1) <= F.lit(limit), "test").otherwise("valid")
    return labelled.withColumn("part", part).drop("in_train_months")


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in the given order (a top-n, no full sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def last_by(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])
