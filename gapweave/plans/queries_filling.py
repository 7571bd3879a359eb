"""Checked queries: gap filling, daily product, merged product, skill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions import clock
from gapweave.operators import evaluate, gapfill
from gapweave.operators.combine import member_flag
from gapweave.plans import daily as daily_plan
from gapweave.plans import merged
from gapweave.plans.catalog import Tables, query
from gapweave.plans.standin import HOURLY, LOG, SENSOR_HOURS, frame_sql, hourly, log, sensors

@query(f"""
WITH {SENSOR_HOURS} SELECT site, time, t28m, e5_t2m, coalesce(t28m, e5_t2m) AS t28m_gf, t28m IS NULL AS gapfill FROM sensors
""", rounded=["t28m", "e5_t2m", "t28m_gf"])
def gap_fill(t: Tables) -> DataFrame:
    df = gapfill.fill(sensors(t), "t28m", "e5_t2m", "t28m_gf")
    return df.select("site", "time", "t28m", "e5_t2m", "t28m_gf", "gapfill")


_RAIN = ("half AS (SELECT site, date_trunc('day', time) + to_minutes(((hour(time) * 60 + minute(time)) // 30 * 30)::BIGINT) AS time, "
         "avg(x) AS sat, CASE WHEN min(x) > 1.5 THEN max(x) END AS gauge FROM log GROUP BY 1, 2), "
         "rain AS (SELECT *, coalesce(p_mm_obs, p_gpm) AS p_mm_gf FROM (SELECT site, date_trunc('hour', time) AS time, "
         "coalesce(sum(sat), 0.0::DOUBLE) * 0.5 AS p_gpm, CASE WHEN count(gauge) = count(*) THEN sum(gauge) END AS p_mm_obs "
         "FROM half GROUP BY 1, 2))")


def _rain(t: Tables) -> DataFrame:
    half = log(t).groupBy("site", clock.floor_time(F.col("time"), 30).alias("time")).agg(
        F.avg("x").alias("sat"), F.when(F.min("x") > 1.5, F.max("x")).alias("gauge"))
    return gapfill.fill_rain(half, ["site"], "time", "gauge", "sat")


@query(f"WITH {LOG}, {_RAIN} SELECT site, time, p_gpm, p_mm_obs, p_mm_gf FROM rain", rounded=["p_gpm", "p_mm_obs", "p_mm_gf"])
def rain_fill(t: Tables) -> DataFrame:
    """Half hours to hours; a missing gauge half hour hands the hour to the satellite."""
    return _rain(t)


@query(f"""
WITH {SENSOR_HOURS}, m AS (SELECT site, time, hour(time)::INTEGER AS hour, t28m AS vv, coalesce(e5_t2m, e5_ws, g_p, c_p) AS ws FROM sensors),
maps AS (SELECT hour, list(vv ORDER BY vv) AS qo, list(ws ORDER BY ws) AS qm, count(*) AS k FROM m WHERE vv IS NOT NULL AND ws IS NOT NULL GROUP BY 1),
ranked AS (SELECT *, percent_rank() OVER (PARTITION BY hour ORDER BY ws) AS tau FROM m WHERE ws IS NOT NULL),
cut AS (SELECT r.*, qo, qm, k, tau * (k - 1) AS place, floor(tau * (k - 1))::INTEGER AS low FROM ranked AS r LEFT JOIN maps ON r.hour = maps.hour)
SELECT site, time, hour, ws, ws + (qo[low + 1] + (qo[least(low + 2, k)] - qo[low + 1]) * (place - low))
  - (qm[low + 1] + (qm[least(low + 2, k)] - qm[low + 1]) * (place - low)) AS ws_bc FROM cut
""", rounded=["ws", "ws_bc"])
def quantile_map(t: Tables) -> DataFrame:
    """Wind bias corrected by quantile delta mapping per hour of day, every value at its own rank."""
    ws = F.coalesce("e5_t2m", "e5_ws", "g_p", "c_p")
    df = sensors(t).select("site", "time", F.hour("time").alias("hour"), F.col("t28m").alias("vv"), ws.alias("ws")).where("ws IS NOT NULL")
    out = gapfill.quantile_map(df.drop("vv"), df.where("vv IS NOT NULL"), ["hour"], "ws", "vv", "ws_bc", bound=gapfill.HOURS)
    return out.select("site", "time", "hour", "ws", "ws_bc")


_P = ("p AS (SELECT site, time AS date, t28m, coalesce(e5_t2m, 3.0::DOUBLE) AS t28m_pred, coalesce(t28m, e5_t2m, 3.0::DOUBLE) AS t28m_gf, "
      "e5_ws AS rh28m, coalesce(g_p, 5.0::DOUBLE) AS rh28m_pred, coalesce(e5_ws, g_p, 5.0::DOUBLE) AS rh28m_gf, c_p AS sw, "
      "coalesce(g_p, 1.0::DOUBLE) - 4 AS swp FROM sensors)")


@query(f"""
WITH {SENSOR_HOURS}, {_P} SELECT site, date, t28m AS p_mm_obs, rh28m_pred AS p_gpm, coalesce(t28m, rh28m_pred) AS p_mm_gf,
  t28m AS t28m_obs, t28m_pred, t28m_gf, rh28m AS rh28m_obs, rh28m_pred, rh28m_gf,
  0.622 * e / (sp / 100 - 0.378 * e) AS specific_humidity_gf, sp, sw AS shortwave_obs,
  CASE WHEN swp < 0 THEN 0.0 ELSE swp END AS shortwave_pred, coalesce(sw, CASE WHEN swp < 0 THEN 0.0 ELSE swp END) AS shortwave_gf,
  t28m_gf AS windspeed, t28m_gf + 1 AS windspeed_bc, rh28m_gf * 1000 / 3600 AS longwave
FROM (SELECT *, 101325 + 10 * rh28m_gf AS sp, rh28m_gf / 100 * 6.112 * exp(17.67 * t28m_gf / (t28m_gf + 243.5)) AS e FROM p)
""", rounded=["p_mm_obs", "p_gpm", "p_mm_gf", "t28m_obs", "t28m_pred", "t28m_gf", "rh28m_obs", "rh28m_pred", "rh28m_gf",
              "specific_humidity_gf", "sp", "shortwave_obs", "shortwave_pred", "shortwave_gf", "windspeed", "windspeed_bc", "longwave"])
def merged_product(t: Tables) -> DataFrame:
    """Seven gap-filled inputs joined by hour, humidity and longwave derived."""
    s = sensors(t).withColumnRenamed("time", "date").where("site IS NOT NULL").persist()
    key = merged.KEY
    temp = gapfill.fill(s.select(*key, "t28m", F.coalesce("e5_t2m", F.lit(3.0)).alias("t28m_pred")), "t28m", "t28m_pred", "t28m_gf")
    hum = gapfill.fill(s.select(*key, F.col("e5_ws").alias("rh28m"), F.coalesce("g_p", F.lit(5.0)).alias("rh28m_pred")),
                       "rh28m", "rh28m_pred", "rh28m_gf")
    rain = gapfill.fill(s.select(*key, F.col("t28m").alias("p_mm_obs"), F.coalesce("g_p", F.lit(5.0)).alias("p_gpm")),
                        "p_mm_obs", "p_gpm", "p_mm_gf", flag=None)
    light = s.select(*key, F.col("c_p").alias("shortwave_obs"), (F.coalesce("g_p", F.lit(1.0)) - 4).alias("shortwave_pred"))
    wind = temp.select(*key, F.col("t28m_gf").alias("ws"), (F.col("t28m_gf") + 1).alias("ws_bc"))
    pressure = hum.select(*key, (101325 + 10 * F.col("rh28m_gf")).alias("sp"))
    thermal = hum.select(*key, (F.col("rh28m_gf") * 1000).alias("strd"))
    return merged.merge(rain, temp, hum, light, wind, pressure, thermal)


# --- daily ------------------------------------------------------------------

_DAYS = "day_hours AS (SELECT site, time, time::DATE AS date, x FROM hourly)"


@query(f"""
WITH {LOG}, {HOURLY}, {_DAYS} SELECT site, time, x FROM day_hours QUALIFY count(x) OVER (PARTITION BY site, date) = 24
""", rounded=["x"])
def complete_days(t: Tables) -> DataFrame:
    """Hours of days with all 24 values."""
    df = hourly(t).withColumn("date", F.to_date("time"))
    return daily_plan.complete_days(df, "x").drop("date")


_STATS = ", ".join(f"{f}({{c}}) AS {s}_{{c}}" for s, f in (("min", "min"), ("mean", "avg"), ("max", "max")))


@query(f"""
WITH {SENSOR_HOURS}, d AS (SELECT site, time::DATE AS date, {", ".join(_STATS.format(c=c) for c in ("t28m", "e5_t2m"))} FROM sensors GROUP BY 1, 2)
SELECT site, date, month(date)::INTEGER AS month, unnest(['min', 'mean', 'max']) AS stat,
  unnest([min_t28m, mean_t28m, max_t28m]) AS t28m, unnest([min_e5_t2m, mean_e5_t2m, max_e5_t2m]) AS e5_t2m FROM d
""", rounded=["t28m", "e5_t2m"])
def daily_min_mean_max(t: Tables) -> DataFrame:
    """Three statistics of every value in one pass, stacked; month from the same clock as the date."""
    df = sensors(t).withColumn("date", F.to_date("time"))
    return daily_plan.daily(df, ["t28m", "e5_t2m"])


@query(f"""
WITH {LOG}, {HOURLY}, local_hours AS (SELECT site, (time - INTERVAL 3 HOUR)::DATE AS date, x FROM hourly)
SELECT site, date, month(date)::INTEGER AS month, min(x) AS x_min, avg(x) AS x_mean, max(x) AS x_max, count(*) AS n FROM local_hours GROUP BY 1, 2
""", rounded=["x_min", "x_mean", "x_max"])
def daily_on_station_clock(t: Tables) -> DataFrame:
    """Days cut on the station clock; one group per day even on the first of a month."""
    day = F.to_date(clock.to_local(F.col("time")))
    return hourly(t).groupBy("site", day.alias("date")).agg(
        F.min("x").alias("x_min"), F.avg("x").alias("x_mean"), F.max("x").alias("x_max"), F.count(F.lit(1)).alias("n")
    ).withColumn("month", F.month("date"))


# --- skill ------------------------------------------------------------------


@query(f"""
WITH {SENSOR_HOURS} SELECT site, sqrt(avg((e5_t2m - t28m) ** 2)) AS rmse, avg(e5_t2m - t28m) AS bias, avg(abs(e5_t2m - t28m)) AS mae,
  corr(t28m, e5_t2m) ** 2 AS r2, count(*) AS n FROM sensors WHERE t28m IS NOT NULL AND e5_t2m IS NOT NULL GROUP BY 1
""", rounded=["rmse", "bias", "mae", "r2"])
def skill(t: Tables) -> DataFrame:
    return evaluate.skill(sensors(t), "t28m", "e5_t2m", ["site"])


_ROLLED = ", ".join(f"{frame_sql(how, x, 72)} AS {x}_{stat}" for x in ("x", "y")
                    for stat, how in (("max", "max"), ("mean", "avg"), ("min", "min")))


@query(f"""
WITH {LOG}, {HOURLY}, pairs AS (SELECT site, time, x, x * x / 5 AS y, x > 6 AND dayofmonth(time) <= 15 AS in_train FROM hourly),
rolled AS (SELECT site, time, in_train, {_ROLLED} FROM pairs)
SELECT in_train, avg(abs(x_max - y_max)) AS val_hi, avg(abs(x_mean - y_mean)) AS val_mean, avg(abs(x_min - y_min)) AS val_lo,
  count(*) AS n FROM rolled WHERE x_mean IS NOT NULL GROUP BY 1
""", rounded=["val_hi", "val_mean", "val_lo"])
def rolling_extreme_error(t: Tables) -> DataFrame:
    """Error of 72-row extremes, in and out of the training rows."""
    df = hourly(t).withColumn("y", F.col("x") * F.col("x") / 5)
    df = member_flag(df, df.where((F.col("x") > 6) & (F.dayofmonth("time") <= 15)), ["site", "time"], also="x")
    return evaluate.rolling_extreme_error(df, ["site"], "time", "x", "y", "in_train")


@query("""
SELECT date_trunc('month', l_shipdate)::DATE AS month_start, avg(sqrt(l_quantity)) AS val_pred, avg(CASE WHEN l_tax > 0.02 THEN sqrt(l_extendedprice) END) AS val_obs,
  count(CASE WHEN l_tax > 0.02 THEN l_extendedprice END) AS nobs FROM lineitem GROUP BY 1
""", rounded=["val_pred", "val_obs"])
def monthly_means(t: Tables) -> DataFrame:
    df = t.lineitem.select(F.col("l_shipdate").alias("time"), F.sqrt("l_quantity").alias("pred"),
                           F.when(F.col("l_tax") > 0.02, F.sqrt("l_extendedprice")).alias("obs"))
    return evaluate.monthly_means(df, "time", "obs", "pred")


@query("""
SELECT year(l_shipdate)::INTEGER AS year, l_linestatus AS stat, regr_slope(sqrt(l_extendedprice), sqrt(l_quantity)) AS slope,
  regr_intercept(sqrt(l_extendedprice), sqrt(l_quantity)) AS intercept, regr_r2(sqrt(l_extendedprice), sqrt(l_quantity)) AS r2,
  count(*) AS n FROM lineitem GROUP BY 1, 2
""", rounded=["slope", "intercept", "r2"])
def fit_lines(t: Tables) -> DataFrame:
    """Observed on predicted by year and statistic."""
    df = t.lineitem.select(F.col("l_shipdate").alias("time"), F.col("l_linestatus").alias("stat"),
                           F.sqrt("l_quantity").alias("pred"), F.sqrt("l_extendedprice").alias("obs"))
    return evaluate.fit_lines(df, "obs", "pred", "time")
