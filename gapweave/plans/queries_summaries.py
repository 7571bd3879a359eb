"""Checked queries: null rules, counts, climatologies, trends, correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions.nullrules import lenient_sum, present, strict_mean, strict_sum
from gapweave.operators import aggregate
from gapweave.plans.catalog import Tables, query
from gapweave.plans.standin import GAPPY, LOG, SENSOR_HOURS, SHIPMENTS, log, sensors, shipments

_HOUR = "date_trunc('hour', time)"


@query(f"""
WITH {GAPPY} SELECT site, {_HOUR} AS time, avg(x) AS mean, CASE WHEN count(x) = count(*) THEN avg(x) END AS strict_mean,
  coalesce(sum(x), 0.0::DOUBLE) AS total, CASE WHEN count(x) = count(*) THEN sum(x) END AS strict_total, stddev_samp(x) AS sd,
  count(x) AS n_obs, count(*) AS n FROM log GROUP BY 1, 2
""", rounded=["mean", "strict_mean", "total", "strict_total", "sd"])
def null_rules(t: Tables) -> DataFrame:
    """Lenient and strict means and sums, sample deviation, value and row counts."""
    from gapweave.functions.clock import floor_time

    x = F.col("x")
    return log(t, gaps=True).groupBy("site", floor_time(F.col("time"), 60).alias("time")).agg(
        F.avg(x).alias("mean"), strict_mean(x).alias("strict_mean"), lenient_sum(x).alias("total"),
        strict_sum(x).alias("strict_total"), F.stddev_samp(x).alias("sd"), present(x).alias("n_obs"),
        F.count(F.lit(1)).alias("n"))


_SENSOR_COLUMNS = ["site", "time", "t28m", "e5_t2m", "e5_ws", "g_p", "c_p"]


@query(f"WITH {SENSOR_HOURS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null, count(*) AS n_rows FROM sensors" for c in _SENSOR_COLUMNS))
def null_counts(t: Tables) -> DataFrame:
    """Missing values of every column in one pass."""
    return aggregate.null_counts(sensors(t), _SENSOR_COLUMNS)


@query("SELECT event_type, value > 100 AS high, count(*) AS n FROM events GROUP BY 1, 2")
def frequency_table(t: Tables) -> DataFrame:
    return aggregate.frequencies(t.events, ["event_type", (F.col("value") > 100).alias("high")])


@query("SELECT min(ts) AS min_ts, max(ts) AS max_ts, min(value) AS min_value, max(value) AS max_value FROM events")
def extent(t: Tables) -> DataFrame:
    return aggregate.extent(t.events, ["ts", "value"])


@query(f"WITH {SENSOR_HOURS} SELECT site, date_trunc('day', time)::DATE AS date, avg(t28m) AS t28m, avg(e5_t2m) AS e5_t2m, "
       "avg(e5_ws) AS e5_ws, avg(g_p) AS g_p, avg(c_p) AS c_p FROM sensors GROUP BY 1, 2",
       rounded=["t28m", "e5_t2m", "e5_ws", "g_p", "c_p"])
def reduce_every_number(t: Tables) -> DataFrame:
    return aggregate.reduce_numeric(sensors(t).withColumn("date", F.to_date("time")), ["site", "date"])


def _climatology(name: str, parts: dict[str, str]) -> None:
    keys = ", ".join(f"{e} AS {k}" for k, e in parts.items())
    functions = {"year": F.year, "month": F.month, "hour": F.hour, "yday": F.dayofyear}

    @query(f"WITH {SHIPMENTS} SELECT {keys}, avg(x) AS x, count(x) AS n_x, avg(y) AS y, count(y) AS n_y "
           "FROM shipments GROUP BY ALL", rounded=["x", "y"], name=name)
    def run(t: Tables) -> DataFrame:
        df = shipments(t).withColumns({k: functions[k]("time") for k in parts})
        return aggregate.climatology(df, list(parts), ["x", "y"])


_climatology("climatology_year_month", {"year": "year(time)::INTEGER", "month": "month(time)::INTEGER"})
_climatology("climatology_month", {"month": "month(time)::INTEGER"})
_climatology("climatology_year", {"year": "year(time)::INTEGER"})
_climatology("climatology_year_day", {"year": "year(time)::INTEGER", "yday": "dayofyear(time)::INTEGER"})


@query(f"WITH {LOG} SELECT site, month(time)::INTEGER AS month, hour(time)::INTEGER AS hour, avg(x) AS x, count(x) AS n_x "
       "FROM log GROUP BY ALL", rounded=["x"])
def climatology_month_hour(t: Tables) -> DataFrame:
    df = log(t).withColumns({"month": F.month("time"), "hour": F.hour("time")})
    return aggregate.climatology(df, ["site", "month", "hour"], ["x"])


@query(f"WITH {SENSOR_HOURS} SELECT corr(t28m, e5_t2m) AS rho, count(*) AS n FROM sensors WHERE t28m IS NOT NULL AND e5_t2m IS NOT NULL",
       rounded=["rho"])
def correlation(t: Tables) -> DataFrame:
    return aggregate.correlation(sensors(t), "e5_t2m", "t28m")


@query(f"WITH {SHIPMENTS} SELECT year(time)::INTEGER AS year, corr(x, y) AS rho, count(*) AS n FROM shipments GROUP BY 1",
       rounded=["rho"])
def correlation_by_year(t: Tables) -> DataFrame:
    return aggregate.correlation(shipments(t).withColumn("year", F.year("time")), "x", "y", ["year"])


@query(f"""
WITH {SHIPMENTS}, daily AS (SELECT year(time)::INTEGER AS year, dayofyear(time) AS d, site, sum(x) AS x, sum(y) AS y FROM shipments GROUP BY ALL)
SELECT year, corr(x, y) AS rho, count(*) AS n FROM daily GROUP BY 1
""", rounded=["rho"])
def daily_sum_correlation(t: Tables) -> DataFrame:
    """Correlation of daily totals, by year."""
    df = shipments(t).withColumns({"year": F.year("time"), "d": F.dayofyear("time")})
    daily = aggregate.totals(df, ["year", "d", "site"], {"x": F.col("x"), "y": F.col("y")})
    return aggregate.correlation(daily, "x", "y", ["year"])


@query(f"""
WITH {SHIPMENTS} SELECT site, regr_slope(x, year(time)) AS slope, regr_intercept(x, year(time)) AS intercept,
  regr_r2(x, year(time)) AS r2, regr_count(x, year(time))::BIGINT AS n FROM shipments GROUP BY 1
""", rounded=["slope", "intercept", "r2"])
def trend(t: Tables) -> DataFrame:
    """Straight line of the reading over the years, per site."""
    return aggregate.line_fit(shipments(t).withColumn("year", F.year("time")), "x", "year", ["site"])


@query(f"""
WITH {LOG} SELECT site, CASE WHEN x < 0 THEN 0 WHEN x >= 20 THEN 41 ELSE floor(x * 2) + 1 END::BIGINT AS bin, count(*) AS n
FROM log GROUP BY 1, 2
""")
def histogram(t: Tables) -> DataFrame:
    return aggregate.histogram(log(t), "x", 0.0, 20.0, 40, ["site"])


@query("""
SELECT CASE WHEN (value * 5) - floor(value * 5) = 0.5 THEN 2 * round(floor(value * 5) / 2 + 0.25)
       ELSE round(value * 5) END / 5 AS obs_bin, avg(abs(sqrt(value) - value)) AS mae, count(*) AS n FROM events GROUP BY 1
""", rounded=["obs_bin", "mae"])
def binned_error(t: Tables) -> DataFrame:
    """Mean absolute error in bins of a fifth; exact halves go to the even bin."""
    return aggregate.binned_error(t.events.withColumn("pred", F.sqrt("value")), "value", "pred")


@query(f"""
WITH {SHIPMENTS} SELECT year(time)::INTEGER AS year, month(time)::INTEGER AS month, coalesce(sum(x), 0.0::DOUBLE) AS obs,
  coalesce(sum(y), 0.0::DOUBLE) AS pred, count(x) AS nobs FROM shipments GROUP BY 1, 2 HAVING count(x) >= 20
""", rounded=["obs", "pred"])
def monthly_totals(t: Tables) -> DataFrame:
    """Monthly totals of months with enough readings."""
    df = shipments(t).withColumns({"year": F.year("time"), "month": F.month("time")})
    return aggregate.totals(df, ["year", "month"], {"obs": F.col("x"), "pred": F.col("y")}, at_least=("x", 20))


@query(f"""
WITH {SHIPMENTS} SELECT year(time)::INTEGER AS year, count(x) AS n_obs, count(DISTINCT time) AS n_times FROM shipments GROUP BY 1
""")
def coverage(t: Tables) -> DataFrame:
    """Readings and distinct times per year; times are made distinct before they are counted."""
    per_time = shipments(t).groupBy("time").agg(F.count("x").alias("n"))
    return per_time.groupBy(F.year("time").alias("year")).agg(
        F.sum("n").alias("n_obs"), F.count("time").alias("n_times"))
