"""All gap-filled variables -> one product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions import moisture
from gapweave.operators import checks
from gapweave.operators.combine import suffix_join

KEY = ["site", "date"]


def shortwave(df: DataFrame) -> DataFrame:
    """Predicted radiation is never negative; fill with it."""
    df = df.withColumn("shortwave_pred", moisture.not_negative(F.col("shortwave_pred")))
    return df.withColumn("shortwave_gf", F.coalesce("shortwave_obs", "shortwave_pred"))


def longwave(df: DataFrame) -> DataFrame:
    return df.select(*KEY, moisture.joules_to_watts(F.col("strd")).alias("longwave"))


def merge(rain: DataFrame, temperature: DataFrame, humidity: DataFrame, radiation: DataFrame, wind: DataFrame,
          pressure: DataFrame, thermal: DataFrame, *, check: bool = True) -> DataFrame:
    """Hours that every variable covers.

    Each input has one row per site and hour, so the joins share one
    partitioning.  ``check`` stops on temperatures below zero, for which the
    humidity formula does not hold.
    """
    moist = suffix_join(temperature, humidity, KEY, ("_temp", "_rh")).join(pressure.select(*KEY, "sp"), KEY)
    if check:  # rides on the same pass
        moist = moist.withColumn("t28m_gf", F.when(checks.warm("t28m_gf"), F.col("t28m_gf")).otherwise(
            F.raise_error(F.concat(F.lit("t28m_gf >= 0 does not hold: "), F.col("t28m_gf").cast("string")))))
    moist = moist.withColumn("specific_humidity_gf", moisture.specific_humidity(
        F.col("rh28m_gf") / 100, F.col("t28m_gf"), F.col("sp")))
    out = rain.join(moist, KEY).join(shortwave(radiation), KEY).join(wind, KEY).join(longwave(thermal), KEY)
    return out.select(
        *KEY, "p_mm_obs", "p_gpm", "p_mm_gf",
        F.col("t28m").alias("t28m_obs"), "t28m_pred", "t28m_gf",
        F.col("rh28m").alias("rh28m_obs"), "rh28m_pred", "rh28m_gf",
        "specific_humidity_gf", "sp", "shortwave_obs", "shortwave_pred", "shortwave_gf",
        F.col("ws").alias("windspeed"), F.col("ws_bc").alias("windspeed_bc"), "longwave")
