"""Input tables in the role of station and grid data, in Spark and in SQL.

``events`` is the sensor log: its type is the series, its square-rooted value
the reading (a root keeps readings off the decimal grid, so that six-decimal
results have no rounding ties).  Readings above 10 count as missing where gaps
are wanted.  ``customer`` places a user's events at one of a few sites, where
the five types are five sensors.  ``orders`` and ``lineitem`` span years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions import clock
from gapweave.operators.aggregate import hourly_mean
from gapweave.operators.attach import look_up
from gapweave.plans.catalog import Tables

SENSORS = {"purchase": "t28m", "view": "e5_t2m", "click": "e5_ws", "signup": "g_p", "error": "c_p"}
GAP_ABOVE = 10.0


def frame_sql(how: str, x: str, n: int, order: str = "time") -> str:
    """SQL of a guarded trailing frame per site."""
    over = f"(PARTITION BY site ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {over} = {n} THEN {how}({x}) OVER {over} END"


def log(t: Tables, gaps: bool = False) -> DataFrame:
    x = F.sqrt("value")
    if gaps:
        x = F.when(x <= GAP_ABOVE, x)
    return t.events.select(F.col("event_type").alias("site"), F.col("ts").alias("time"), "event_id", x.alias("x"))


LOG = "log AS (SELECT event_type AS site, ts AS time, event_id, sqrt(value) AS x FROM events)"
GAPPY = ("log AS (SELECT event_type AS site, ts AS time, event_id, "
         "CASE WHEN sqrt(value) <= 10.0 THEN sqrt(value) END AS x FROM events)")


def hourly(t: Tables, gaps: bool = False) -> DataFrame:
    """Hourly mean per series (nearest hour)."""
    return hourly_mean(log(t, gaps), ["site"], "time", skip=("event_id",))


HOURLY = ("hourly AS (SELECT site, date_trunc('hour', time + INTERVAL 30 MINUTE) AS time, avg(x) AS x "
          "FROM log GROUP BY 1, 2)")


def placed(t: Tables) -> DataFrame:
    """Sensor readings with the site of their user."""
    sites = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("site"))
    return (look_up(t.events, sites, ["user_id"])
            .select("site", F.col("ts").alias("time"), "event_id", "event_type", F.sqrt("value").alias("x")))


PLACED = ("placed AS (SELECT c_mktsegment AS site, ts AS time, event_id, event_type, sqrt(value) AS x "
          "FROM events LEFT JOIN customer ON user_id = c_custkey)")


def sensors(t: Tables) -> DataFrame:
    """One row per site and clock hour, one column per sensor; absent readings are NULL."""
    hour = clock.floor_time(F.col("time"), 60).alias("time")
    return placed(t).groupBy("site", hour).agg(*[
        F.avg(F.when(F.col("event_type") == kind, F.col("x"))).alias(name) for kind, name in SENSORS.items()])


SENSOR_HOURS = (PLACED + ", sensors AS (SELECT site, date_trunc('hour', time) AS time, "
                + ", ".join(f"avg(x) FILTER (WHERE event_type = '{k}') AS {n}" for k, n in SENSORS.items())
                + " FROM placed GROUP BY 1, 2)")


def shipments(t: Tables) -> DataFrame:
    """Multi-year series from lineitem: one reading per shipped line."""
    return t.lineitem.select(
        F.col("l_returnflag").alias("site"), F.col("l_shipdate").alias("time"),
        F.sqrt("l_extendedprice").alias("x"), F.sqrt("l_quantity").alias("y"),
        F.col("l_discount").alias("d"), F.col("l_tax").alias("p"), "l_orderkey", "l_linenumber")


SHIPMENTS = ("shipments AS (SELECT l_returnflag AS site, l_shipdate AS time, sqrt(l_extendedprice) AS x, "
             "sqrt(l_quantity) AS y, l_discount AS d, l_tax AS p, l_orderkey, l_linenumber FROM lineitem)")


def grid(t: Tables) -> DataFrame:
    """Long-form grid: cell from the user, archive hours and lead from the clock."""
    hours = F.floor(clock.elapsed_seconds(F.col("ts"), F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")) / 3600)
    u = F.col("user_id")
    return t.events.select(
        F.col("event_type").alias("variable"),
        (F.lit(308.0) + (u % 5) * 0.25).alias("lon"), (F.lit(-2.25) + (u % 7) * 0.25).alias("lat"),
        (hours - hours % 12).alias("time_hours"), (hours % 12).cast("int").alias("lead_hours"),
        F.sqrt("value").alias("value"), "event_id")


GRID = ("grid AS (SELECT event_type AS variable, 308.0::DOUBLE + (user_id % 5) * 0.25::DOUBLE AS lon, "
        "-2.25::DOUBLE + (user_id % 7) * 0.25::DOUBLE AS lat, h - h % 12 AS time_hours, "
        "(h % 12)::INTEGER AS lead_hours, x AS value, event_id FROM (SELECT event_type, user_id, event_id, "
        "sqrt(value) AS x, date_diff('hour', TIMESTAMP '1900-01-01 00:00:00', date_trunc('hour', ts)) AS h FROM events))")


def covariate_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Raw reanalysis, satellite rain, daily rain and hourly station record, from the sensors."""
    s = sensors(t).where("site IS NOT NULL")
    reanalysis = s.select(
        "site", F.col("time").alias("time_utc"), (F.coalesce("e5_t2m", F.lit(7.0)) + 290).alias("t2m"),
        (F.coalesce("e5_ws", F.lit(6.0)) + 280).alias("d2m"), F.coalesce("g_p", F.lit(1.0)).alias("u"),
        F.coalesce("c_p", F.lit(2.0)).alias("v"), (F.coalesce("g_p", F.lit(0.0)) / 1000).alias("total_precipitation"))
    p = placed(t).where("site IS NOT NULL")
    satellite = p.groupBy("site", clock.floor_time(F.col("time"), 30).alias("time_utc")).agg(F.avg("x").alias("precip"))
    rain = p.groupBy("site", F.to_date("time").alias("date")).agg(F.sum("x").alias("c_p24h"))
    station = s.select("site", clock.to_local(F.col("time")).alias("date"), "t28m",
                       (F.coalesce("e5_ws", F.lit(4.0)) * 5).alias("rh28m"),
                       F.year("time").alias("year"), F.month("time").alias("month"), F.dayofmonth("time").alias("day"),
                       F.hour("time").alias("hour"))
    return reanalysis, satellite, rain, station


def model_days(t: Tables) -> DataFrame:
    """Multi-year model frame: one row per site and day, covariates and all targets."""
    df = shipments(t).groupBy("site", F.col("time").alias("time_utc")).agg(
        F.avg("x").alias("t28m"), F.avg(F.when(F.col("d") > 0.02, 100 * F.col("d"))).alias("rh28m"),
        F.max(F.when(F.col("p") > 0.01, F.col("x") / 100)).alias("vv"),
        F.avg(F.col("x") / 100).alias("vpd28m"), F.max("x").alias("rad_global"), F.avg(100 * F.col("p")).alias("precip"),
        F.avg("y").alias("e5_t2m"), F.max("y").alias("e5_ws"), F.avg("d").alias("g_p"),
        F.sum("y").alias("c_p24h"))
    time = F.col("time_utc")
    return df.withColumns({"time_local": time, "date": F.to_date(time), "year": F.year(time), "month": F.month(time),
                           "hour": F.dayofweek(time)})


def model_slots(t: Tables) -> DataFrame:
    """Frame for the daily plan: months in the role of days, weeks in the role of hours."""
    month = F.trunc(F.to_date("time"), "month")
    slot = F.floor((F.dayofmonth("time") - 1) / 7)
    return shipments(t).groupBy("site", month.alias("date"), slot.alias("slot")).agg(
        F.avg("x").alias("t28m"), F.avg("y").alias("e5_t2m"), F.max("y").alias("e5_ws"), F.avg("d").alias("g_p")
    ).drop("slot")
