"""Checked queries: joins, sets, splits, samples, reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions import clock
from gapweave.operators import clean, combine, reshape, sampling
from gapweave.plans.catalog import Tables, query
from gapweave.plans.standin import GAPPY, HOURLY, LOG, SENSOR_HOURS, hourly, log, sensors

# --- joins ------------------------------------------------------------------


def _one(df: DataFrame, site: str, name: str) -> DataFrame:
    return df.where(F.col("site") == site).select("time", F.col("x").alias(name))


_ONE = "{n} AS (SELECT time, x AS {n} FROM hourly WHERE site = '{s}')"
_FIVE = ", ".join(_ONE.format(n=n, s=s) for n, s in
                  {"t28m": "purchase", "e5_t2m": "view", "e5_ws": "click", "g_p": "signup", "c_p": "error"}.items())


@query(f"""
WITH {LOG}, {HOURLY}, {_FIVE} SELECT e5_t2m.time, e5_t2m, e5_ws, g_p, c_p, t28m, hour(e5_t2m.time)::INTEGER AS hour
FROM e5_t2m JOIN e5_ws ON e5_t2m.time = e5_ws.time JOIN g_p ON e5_t2m.time = g_p.time JOIN c_p ON e5_t2m.time = c_p.time
LEFT JOIN t28m ON e5_t2m.time = t28m.time
""", rounded=["e5_t2m", "e5_ws", "g_p", "c_p", "t28m"])
def align_covariates(t: Tables) -> DataFrame:
    """Covariates inner-joined by time, observations left-joined."""
    h = hourly(t)
    df = combine.join_on(_one(h, "view", "e5_t2m"), _one(h, "click", "e5_ws"), ["time"])
    df = combine.join_on(df, _one(h, "signup", "g_p"), ["time"])
    df = combine.join_on(df, _one(h, "error", "c_p"), ["time"])
    df = combine.join_on(df, _one(h, "purchase", "t28m"), ["time"], "left")
    return df.withColumn("hour", F.hour("time"))


@query(f"""
WITH {LOG}, {HOURLY}, n AS (SELECT site, date_trunc('hour', time + INTERVAL 30 MINUTE) AS time, max(x) AS top FROM log GROUP BY 1, 2)
SELECT h.site, year(h.time)::INTEGER AS year, month(h.time)::INTEGER AS month, day(h.time)::INTEGER AS day,
  hour(h.time)::INTEGER AS hour, x, top FROM hourly AS h JOIN n ON h.site = n.site AND h.time = n.time
""", rounded=["x", "top"])
def join_on_parts(t: Tables) -> DataFrame:
    """Inner join on series, year, month, day and hour."""
    keys = ["year", "month", "day", "hour"]

    def by_parts(df: DataFrame) -> DataFrame:
        p = clock.parts(F.col("time"))
        return df.withColumns({k: p[k] for k in keys}).drop("time")

    tops = log(t).groupBy("site", clock.round_time(F.col("time"), 60).alias("time")).agg(F.max("x").alias("top"))
    return combine.join_on(by_parts(hourly(t)), by_parts(tops), ["site", *keys])


@query("""
SELECT l_orderkey AS o_orderkey, l_linenumber, l_shipdate, o_custkey, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def natural_join(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate")
    return combine.natural_join(lines, t.orders.select("o_orderkey", "o_custkey", "o_totalprice"))


@query("""
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON o_custkey = c_custkey
""")
def natural_left_join(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    people = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return combine.natural_join(people, orders, "left")


@query(f"""
WITH {LOG}, {HOURLY} SELECT h.site, h.time, h.x AS x_temp, m.x AS x_rh FROM hourly AS h
JOIN (SELECT time, avg(x) AS x FROM hourly GROUP BY 1) AS m ON h.time = m.time
""", rounded=["x_temp", "x_rh"])
def suffix_join(t: Tables) -> DataFrame:
    """Every series beside the mean of all; the clashing value gets a suffix on either side."""
    h = hourly(t)
    means = h.groupBy("time").agg(F.avg("x").alias("x"))
    return combine.suffix_join(h, means, ["time"], ("_temp", "_rh")).select("site", "time", "x_temp", "x_rh")


@query(f"""
WITH {SENSOR_HOURS} SELECT site, time, e5_t2m, e5_t2m_u, e5_t2m - e5_t2m_u AS e5_t2m_anom FROM (
  SELECT *, CASE WHEN count(e5_t2m) OVER w = count(*) OVER w THEN avg(e5_t2m) OVER w END AS e5_t2m_u FROM sensors
  WINDOW w AS (PARTITION BY site, month(time), hour(time)))
""", rounded=["e5_t2m", "e5_t2m_u", "e5_t2m_anom"])
def anomaly(t: Tables) -> DataFrame:
    """Distance from the strict month-by-hour mean of the site."""
    df = sensors(t).withColumns({"month": F.month("time"), "hour": F.hour("time")})
    return clean.anomaly(df, ["site", "month", "hour"], "e5_t2m", short_groups=True).select("site", "time", "e5_t2m", "e5_t2m_u", "e5_t2m_anom")


@query(f"""
WITH {LOG} SELECT event_id, site, x, x - avg(x) OVER (PARTITION BY site, hour(time)) AS x_anom FROM log
""", rounded=["x", "x_anom"])
def anomaly_raw(t: Tables) -> DataFrame:
    """The same on raw readings: group means come to the rows, rows are not grouped."""
    df = log(t).withColumn("hour", F.hour("time"))
    return clean.anomaly(df, ["site", "hour"], "x").select("event_id", "site", "x", "x_anom")


@query(f"""
WITH {LOG}, {HOURLY}, rain AS (SELECT site, time::DATE AS date, sum(x) AS c_p24h FROM log WHERE site <> 'error' GROUP BY 1, 2)
SELECT h.site, h.time, h.time::DATE AS date, h.x, c_p24h FROM hourly h JOIN rain r ON h.site = r.site AND h.time::DATE = r.date
""", rounded=["x", "c_p24h"])
def daily_on_hourly(t: Tables) -> DataFrame:
    """Daily totals repeated on the hours of their day."""
    rain = (log(t).where("site <> 'error'").groupBy("site", F.to_date("time").alias("date"))
            .agg(F.sum("x").alias("c_p24h")))
    return combine.daily_onto_hourly(hourly(t).withColumn("date", F.to_date("time")), rain, ["site", "date"])


# --- sets -------------------------------------------------------------------

_A = "SELECT l_suppkey, l_linenumber, CASE WHEN l_tax > 0.02 THEN l_tax END AS tax FROM lineitem"
_B = "SELECT l_suppkey, l_linenumber, CASE WHEN l_tax > 0.02 THEN l_tax END AS tax FROM lineitem WHERE l_returnflag = 'A'"


def _ab(t: Tables) -> tuple[DataFrame, DataFrame]:
    df = t.lineitem.withColumn("tax", F.when(F.col("l_tax") > 0.02, F.col("l_tax")))
    cols = ["l_suppkey", "l_linenumber", "tax"]
    return df.select(*cols), df.where("l_returnflag = 'A'").select(*cols)


@query(f"SELECT * FROM ({_A}) EXCEPT SELECT * FROM ({_B})")
def set_difference(t: Tables) -> DataFrame:
    """Distinct rows of one table that another lacks, NULL equal to NULL."""
    return combine.set_difference(*_ab(t))


@query(f"""
SELECT * FROM ({_A}) a WHERE NOT EXISTS (SELECT 1 FROM ({_B}) b WHERE a.l_suppkey IS NOT DISTINCT FROM b.l_suppkey
  AND a.l_linenumber IS NOT DISTINCT FROM b.l_linenumber AND a.tax IS NOT DISTINCT FROM b.tax)
""")
def anti_join(t: Tables) -> DataFrame:
    """Rows without an equal row in the other table, duplicates kept."""
    return combine.rows_not_in(*_ab(t))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_discount, year(l_shipdate)::INTEGER AS year FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_discount", F.year("l_shipdate").alias("year")).distinct()


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def keep_members(t: Tables) -> DataFrame:
    rich = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return combine.keep_members(t.orders.select("o_orderkey", "o_custkey"), rich, ["o_custkey"])


@query(f"""
WITH {GAPPY} SELECT event_id, x, x IS NOT NULL AND time::DATE IN (SELECT time::DATE FROM log WHERE x > 9.9) AS in_train FROM log
""", rounded=["x"])
def member_flag(t: Tables) -> DataFrame:
    """Is the row's day among the training days, and the reading there?"""
    df = log(t, gaps=True).withColumn("date", F.to_date("time"))
    return combine.member_flag(df, df.where("x > 9.9"), ["date"], also="x").select("event_id", "x", "in_train")


@query("""
SELECT found, count(*) AS n FROM (SELECT DISTINCT user_id, user_id IN (SELECT o_custkey FROM orders) AS found FROM events) GROUP BY 1
""")
def key_coverage(t: Tables) -> DataFrame:
    return combine.key_coverage(t.events, t.orders.select(F.col("o_custkey").alias("user_id")), ["user_id"])


@query("""
SELECT o_orderkey AS id, o_orderdate AS time, o_totalprice AS x FROM orders
UNION ALL SELECT l_orderkey, l_shipdate, l_extendedprice FROM lineitem
""")
def stack_rows(t: Tables) -> DataFrame:
    """Two sources of one layout, duplicates kept."""
    a = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("x"))
    b = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("time"), F.col("l_extendedprice").alias("x"))
    return combine.stack_rows([a, b])


@query("""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
""")
def time_range(t: Tables) -> DataFrame:
    """Half-open time range, pushed into the scan."""
    time = F.col("o_orderdate")
    start, end = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (1996, 1999))
    return t.orders.where((time >= start) & (time < end)).select("o_orderkey", "o_orderdate", "o_totalprice")


@query(f"""
WITH {SENSOR_HOURS} SELECT site, time, t28m, e5_t2m FROM sensors WHERE t28m IS NOT NULL AND e5_t2m IS NOT NULL
""", rounded=["t28m", "e5_t2m"])
def complete_rows(t: Tables) -> DataFrame:
    """Rows without a missing value."""
    return sensors(t).select("site", "time", "t28m", "e5_t2m").dropna(subset=["t28m", "e5_t2m"])


# --- splits and samples -----------------------------------------------------


@query("""
WITH o AS (SELECT o_orderkey, year(o_orderdate)::VARCHAR || '_' || month(o_orderdate)::VARCHAR AS ym FROM orders),
months AS (SELECT ym, row_number() OVER (ORDER BY md5('3|' || ym)) <= floor(count(*) OVER () * 0.9) AS tr FROM (SELECT DISTINCT ym FROM o)),
held AS (SELECT o_orderkey, o.ym, row_number() OVER (ORDER BY md5('4|' || o_orderkey::VARCHAR)) AS r, count(*) OVER () AS n
  FROM o JOIN months ON o.ym = months.ym WHERE NOT tr)
SELECT o_orderkey, o.ym, 'train' AS part FROM o JOIN months ON o.ym = months.ym WHERE tr
UNION ALL SELECT o_orderkey, ym, CASE WHEN r <= floor(n * 0.5) THEN 'test' ELSE 'valid' END FROM held
""")
def block_split(t: Tables) -> DataFrame:
    """Nine tenths of the year-months to training, the rest halved by row."""
    return sampling.block_split(t.orders, "o_orderdate", ["o_orderkey"], seed=3).select("o_orderkey", "ym", "part")


@query("""
SELECT event_id, value FROM events QUALIFY row_number() OVER (ORDER BY md5('7|' || event_id::VARCHAR)) <= 1000
""")
def sample_exact(t: Tables) -> DataFrame:
    """Exactly 1,000 random rows."""
    return sampling.take_exactly(t.events.select("event_id", "value"), 1000, ["event_id"], seed=7)


@query("SELECT event_id, value FROM events WHERE substring(md5('5|' || event_id::VARCHAR), 1, 8) < '4ccccccc'")
def sample_fraction(t: Tables) -> DataFrame:
    """Three tenths of the rows."""
    return sampling.take_fraction(t.events.select("event_id", "value"), 0.3, ["event_id"], seed=5)


@query("SELECT event_id, ts, value FROM events ORDER BY ts NULLS LAST, event_id LIMIT 100")
def first_rows(t: Tables) -> DataFrame:
    return sampling.first_rows(t.events.select("event_id", "ts", "value"), 100, "ts", "event_id")


@query("SELECT event_type, arg_max(value, ts) AS value, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1")
def last_reading(t: Tables) -> DataFrame:
    return sampling.last_by(t.events, ["event_type"], "ts", ["value", "event_id"])


# --- reshape ----------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, sensor, temp FROM (
  SELECT l_orderkey, l_linenumber, l_shipdate, unnest(['l_quantity', 'l_discount', 'l_tax']) AS sensor,
    unnest([l_quantity, l_discount, l_tax]) AS temp FROM lineitem)
""")
def to_long(t: Tables) -> DataFrame:
    return reshape.to_long(t.lineitem, ["l_orderkey", "l_linenumber", "l_shipdate"],
                           ["l_quantity", "l_discount", "l_tax"], "sensor", "temp")


@query(f"""
WITH {LOG}, {HOURLY}, long AS (SELECT site, time, unnest(['obs_x_max_72h', 'pred_x_min_72h', 'obs_x_mean_72h']) AS name,
  unnest([x, x + 1, x * 2]) AS value FROM hourly)
SELECT site, time, name, value, CASE WHEN contains(name, 'max') THEN 'max' WHEN contains(name, 'mean') THEN 'mean' ELSE 'min' END AS stat,
  CASE WHEN starts_with(name, 'obs') THEN 'observation' ELSE 'prediction' END AS origin FROM long
""", rounded=["value"])
def decoded_long(t: Tables) -> DataFrame:
    """Stack product columns and read statistic and origin from their names."""
    df = hourly(t).select("site", "time", F.col("x").alias("obs_x_max_72h"), (F.col("x") + 1).alias("pred_x_min_72h"),
                          (F.col("x") * 2).alias("obs_x_mean_72h"))
    return reshape.decoded_long(df, ["site", "time"])


@query("""
SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
  count(*) FILTER (WHERE o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1
""")
def to_wide(t: Tables) -> DataFrame:
    df = reshape.to_wide(t.orders, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], "o_orderkey", how=F.count)
    return df.na.fill(0, ["F", "O", "P"])
