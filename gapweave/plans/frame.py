"""Covariates and station record -> model frame.

Keys are ``site`` and ``time_utc``; the station clock is derived once, and the
calendar (date, month, hour) always comes from the station clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions import clock, moisture, naming
from gapweave.functions.nullrules import strict_mean
from gapweave.operators import clean
from gapweave.operators.rolling import roll_series
from gapweave.sources import layouts


def reanalysis_features(raw: DataFrame) -> DataFrame:
    """Celsius, wind speed, vapour pressure deficit, 24 h rain; names led by ``e5_``."""
    df = raw.withColumns({"t2m": moisture.kelvin_to_celsius(F.col("t2m")),
                          "d2m": moisture.kelvin_to_celsius(F.col("d2m")),
                          "ws": moisture.wind_speed(F.col("u"), F.col("v"))})
    df = df.withColumns({"esat": moisture.saturation_pressure(F.col("t2m")),
                         "vpd": moisture.deficit_from_dew_point(F.col("t2m"), F.col("d2m"))})
    df = roll_series(df, ["site"], "time_utc", {"__max": ("total_precipitation", "max", 24),
                                                "__sum": ("total_precipitation", "sum", 24)})
    df = df.withColumns({"tot_p24h_max": moisture.metres_to_mm(F.col("__max")),
                         "tot_p24h_sum": moisture.metres_to_mm(F.col("__sum"))}).drop("__max", "__sum")
    return naming.prefix(df, "e5_", layouts.REANALYSIS_KEEP_NAMES)


def satellite_features(raw: DataFrame) -> DataFrame:
    """Hourly mean rain (NULL if a half hour is missing) and its trailing sums."""
    hourly = raw.groupBy("site", clock.floor_time(F.col("time_utc"), 60).alias("time_utc")).agg(
        strict_mean(F.col("precip")).alias("g_p"))
    frames = {f"g_p{n}h_sum": ("g_p", "sum", n) for n in layouts.RAIN_HOURS}
    return roll_series(hourly, ["site"], "time_utc", frames)


def daily_rain_features(raw: DataFrame) -> DataFrame:
    frames = {name: ("c_p24h", "sum", n) for name, n in layouts.RAIN_DAYS.items()}
    return roll_series(raw, ["site"], "date", frames)


def covariates(reanalysis: DataFrame, satellite: DataFrame, daily_rain: DataFrame) -> DataFrame:
    """All covariates by site and hour; daily rain is repeated on the hours of its UTC day."""
    hourly = reanalysis_features(reanalysis).join(satellite_features(satellite), ["site", "time_utc"], "inner")
    hourly = hourly.withColumn("date", F.to_date("time_utc"))
    return hourly.join(daily_rain_features(daily_rain), ["site", "date"], "inner").drop("date")


def model_frame(covariate: DataFrame, station: DataFrame) -> DataFrame:
    """Observations next to covariates for every covariate hour, calendar and anomaly added.

    ``station`` is hourly on the station clock (``date``).
    """
    station = station.withColumn("vpd28m", moisture.deficit_from_humidity(F.col("t28m"), F.col("rh28m")))
    station = station.withColumn("time_local", F.col("date")).drop("date", "year", "month", "day", "hour")
    df = covariate.withColumn("time_local", clock.to_local(F.col("time_utc")))
    df = df.join(station, ["site", "time_local"], "left")
    t = F.col("time_local")
    df = df.withColumns({"date": F.to_date(t), "year": F.year(t), "month": F.month(t), "hour": F.hour(t),
                         "ddate": clock.decimal_year(t)})
    return clean.anomaly(df, ["site", "month", "hour"], "e5_t2m", short_groups=True)
