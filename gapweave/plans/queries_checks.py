"""What another engine can know of the fitted models: keys, observed values, counts, order, and joins on NULL keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapweave.functions import clock, naming
from gapweave.operators import combine, models
from gapweave.plans import queries_models as fitted
from gapweave.plans.catalog import Tables, query
from gapweave.plans.standin import HOURLY, LOG, SHIPMENTS, hourly, model_days

_DAYS = (SHIPMENTS + ", days AS (SELECT site, time AS time_utc, time AS time_local, time::DATE AS date, year(time)::INTEGER AS year, "
         "month(time)::INTEGER AS month, (dayofweek(time) + 1)::INTEGER AS hour, avg(x) AS t28m, "
         "avg(CASE WHEN d > 0.02 THEN 100 * d END) AS rh28m, max(CASE WHEN p > 0.01 THEN x / 100 END) AS vv, avg(y) AS e5_t2m, "
         "max(y) AS e5_ws, avg(d) AS g_p, sum(y) AS c_p24h FROM shipments GROUP BY site, time)")
_GAPPY_DAYS = (", gappy AS (SELECT site, date, year, CASE WHEN round(g_p, 6) > 0.045 THEN t28m END AS t28m, "
               "CASE WHEN dayofyear(date) > 20 THEN e5_ws END AS e5_ws FROM days)")


def _found(name: str):
    return F.col(name).isNotNull().alias(f"has_{name}")


@query(f"""
WITH {_DAYS} SELECT site, time_utc, time_local, date, year, month, hour, t28m, rh28m, vv, TRUE AS has_pred_t28m, TRUE AS has_pred_rh28m,
  TRUE AS has_pred_windspeed FROM days
""", rounded=["t28m", "rh28m", "vv"])
def hourly_product_rows(t: Tables) -> DataFrame:
    """Keys and observed columns of the product keep rows, values and types; every row has its predictions."""
    out = fitted.hourly_product(t)
    return out.select("site", "time_utc", "time_local", "date", "year", "month", "hour", "t28m", "rh28m", "vv",
                      *[_found(c) for c in ("pred_t28m", "pred_rh28m", "pred_windspeed")])


@query(f"""
WITH {SHIPMENTS}, slots AS (SELECT site, date_trunc('month', time)::DATE AS date, (day(time) - 1) // 7 AS slot, avg(x) AS t28m FROM shipments GROUP BY 1, 2, 3),
stats AS (SELECT site, date, min(t28m) AS a, avg(t28m) AS b, max(t28m) AS c FROM slots GROUP BY 1, 2)
SELECT site, date, unnest(['min', 'mean', 'max']) AS stat, unnest([a, b, c]) AS t28m, TRUE AS has_pred_t28m FROM stats
""", rounded=["t28m"])
def daily_product_rows(t: Tables) -> DataFrame:
    return fitted.daily_product(t).select("site", "date", "stat", "t28m", _found("pred_t28m"))


@query(f"""
WITH {_DAYS}{_GAPPY_DAYS} SELECT site, date, t28m, e5_ws IS NOT NULL AS has_t28m_pred, t28m IS NULL AS gapfill,
  CASE WHEN t28m IS NULL AND e5_ws IS NULL THEN NULL ELSE t28m IS NOT NULL END AS observed FROM gappy
""", rounded=["t28m"])
def smooth_gapfill_rows(t: Tables) -> DataFrame:
    """Every row stays; no prediction where a covariate lacks; observed values go through."""
    out = fitted.smooth_gapfill(t)
    same = F.when(F.col("t28m_gf").isNotNull(), F.coalesce(F.col("t28m_gf") == F.col("t28m"), F.lit(False)))
    return out.select("site", "date", "t28m", _found("t28m_pred"), "gapfill", same.alias("observed"))


def _spread(df: DataFrame, target: str) -> float:
    return df.agg(F.stddev_pop(target)).first()[0]


@query("SELECT TRUE AS tested, TRUE AS bounded")
def hourly_skill_bound(t: Tables) -> DataFrame:
    """Held-out error no more than a tenth above the spread of the target; the stand-in tables hold no more signal."""
    spread = _spread(model_days(t), "t28m")
    return fitted.hourly_skill(t).select((F.col("n") > 0).alias("tested"), (F.col("rmse") < 1.1 * spread).alias("bounded"))


@query("SELECT TRUE AS tested, TRUE AS bounded")
def smooth_error_bound(t: Tables) -> DataFrame:
    spread = _spread(fitted._gappy_days(t), "t28m")
    return fitted.smooth_test_error(t).select((F.col("n") > 0).alias("tested"), (F.col("rmse") < 1.1 * spread).alias("bounded"))


@query(f"WITH {_DAYS}{_GAPPY_DAYS} SELECT site, count(t28m) AS n FROM gappy GROUP BY 1")
def gamma_rows(t: Tables) -> DataFrame:
    return fitted.gamma_skill(t).select("site", "n")


@query(f"WITH {_DAYS} SELECT site, year, count(*) AS n FROM days GROUP BY 1, 2")
def expectation_rows(t: Tables) -> DataFrame:
    return fitted.expectation_model(t).select("site", "year", "n")


@query("SELECT unnest(['e5_t2m', 'e5_ws', 'g_p', 'c_p24h', 'month', 'hour']) AS covariate, 1.0::DOUBLE AS total", rounded=["total"])
def forest_names(t: Tables) -> DataFrame:
    """Every covariate has an importance; together they are one."""
    return fitted.forest_importance(t).select("covariate", F.sum("importance").over(Window.partitionBy()).alias("total"))


def _board(df: DataFrame, label: str, error: str) -> DataFrame:
    """Places, names and whether errors rise, of a leaderboard (as long as the grid)."""
    before = F.lag(error).over(Window.partitionBy().orderBy("place"))
    marked = df.withColumn("__up", F.coalesce(F.col(error) >= before, F.lit(True)))
    return marked.agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(label)), "; ").alias("names"),
                      F.max("place").cast("bigint").alias("last"), F.bool_and("__up").alias("ordered"))


@query("""
SELECT 3::BIGINT AS n, string_agg('featureSubsetStrategy=0.8, maxDepth=' || d || ', stepSize=0.1, subsamplingRate=0.8', '; ' ORDER BY d) AS names,
  3::BIGINT AS last, TRUE AS ordered FROM (VALUES (3), (5), (7)) AS x(d)
""")
def boosted_board(t: Tables) -> DataFrame:
    return _board(fitted.boosted_search(t), "params", "rmse")


@query("""
SELECT 9::BIGINT AS n, string_agg('elasticNetParam=' || m || ', regParam=' || r, '; ' ORDER BY m, r) AS names, 9::BIGINT AS last, TRUE AS ordered
FROM (VALUES ('0.0'), ('0.5'), ('1.0')) AS x(m), (VALUES ('0.0'), ('0.01'), ('0.1')) AS y(r)
""")
def linear_board(t: Tables) -> DataFrame:
    return _board(fitted.linear_search(t), "params", "rmse")


@query("SELECT 4::BIGINT AS n, 'calendar; calendar_warm; calendar_warm_wind; warm_by_wind' AS names, 4::BIGINT AS last, TRUE AS ordered")
def aic_board(t: Tables) -> DataFrame:
    return _board(fitted.smooth_models_by_aic(t), "model", "aic")


# --- small operators --------------------------------------------------------

_NAMED = "named AS (SELECT CASE WHEN site <> 'error' THEN site END AS site, time, x FROM hourly)"


@query(f"""
WITH {LOG}, {HOURLY}, {_NAMED}, means AS (SELECT site, avg(x) AS m FROM named GROUP BY 1)
SELECT named.site, time, x, m FROM named JOIN means ON named.site IS NOT DISTINCT FROM means.site
""", rounded=["x", "m"])
def null_key_join(t: Tables) -> DataFrame:
    """A series without a name meets its own mean."""
    named = hourly(t).withColumn("site", F.when(F.col("site") != "error", F.col("site")))
    return combine.natural_join(named, named.groupBy("site").agg(F.avg("x").alias("m")))


@query(f"""
WITH {LOG}, {HOURLY}, {_NAMED} SELECT s IS NULL OR s < 'm' AS found, count(*) AS n FROM (SELECT DISTINCT site AS s FROM named) AS q GROUP BY 1
""")
def null_key_coverage(t: Tables) -> DataFrame:
    named = hourly(t).withColumn("site", F.when(F.col("site") != "error", F.col("site")))
    return combine.key_coverage(named, named.where("site IS NULL OR site < 'm'"), ["site"])


@query(f"WITH {_DAYS} SELECT site, time_utc, e5_t2m, e5_ws, g_p, c_p24h, month, hour FROM days", rounded=["e5_t2m", "e5_ws", "g_p", "c_p24h"])
def covariate_columns(t: Tables) -> DataFrame:
    """Model inputs chosen by the beginning of their names."""
    df = model_days(t).withColumn("specific_humidity_gf", F.lit(1.0))
    return df.select("site", "time_utc", *naming.covariates(df.columns))


@query(f"WITH {_DAYS} SELECT site, count(*) FILTER (WHERE rh28m < 100) AS n_train, count(*) FILTER (WHERE rh28m > 0) AS n_test FROM days GROUP BY 1")
def usable_rows(t: Tables) -> DataFrame:
    """Rows that the target's own rule admits to training and to testing."""
    df = model_days(t)
    counts = [models.usable(df, "rh28m", phase).groupBy("site").agg(F.count(F.lit(1)).alias(f"n_{phase}")) for phase in ("train", "test")]
    return combine.natural_join(*counts)


@query("SELECT event_id, ts AS time FROM events")
def zone_relabel(t: Tables) -> DataFrame:
    """A time with a zone keeps its clock reading (the session's zone is UTC)."""
    return t.events.select("event_id", clock.relabel(F.col("ts").cast("timestamp")).alias("time"))
