"""Checked queries: ingest, cleaning, time and unit expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions import clock, moisture, naming
from gapweave.functions.nullrules import choose
from gapweave.operators import blocks, clean
from gapweave.operators.aggregate import hourly_mean
from gapweave.operators.combine import stack_rows
from gapweave.operators.gapfill import fill_from_group_mean
from gapweave.plans.catalog import Tables, query
from gapweave.plans.standin import HOURLY, LOG, SENSOR_HOURS, SHIPMENTS, hourly, log, sensors, shipments
from gapweave.session import staging_path
from gapweave.sources import readers, writers

# --- flagship ---------------------------------------------------------------


@query(f"""
WITH {SENSOR_HOURS},
stats AS (SELECT site, hour(time) AS h, avg(t28m) AS u, stddev_samp(t28m) AS s FROM sensors GROUP BY 1, 2),
flagged AS (
  SELECT sensors.*, CASE WHEN t28m < u - 3.5 * s OR t28m > u + 3 * s THEN 'bad' ELSE 'good' END AS bad
  FROM sensors JOIN stats ON sensors.site IS NOT DISTINCT FROM stats.site AND hour(time) = h),
masked AS (SELECT * REPLACE (CASE WHEN bad <> 'bad' THEN t28m END AS t28m) FROM flagged),
offsets AS (SELECT site, hour(time) AS h, avg(t28m - e5_t2m) AS o FROM masked GROUP BY 1, 2)
SELECT masked.site, time, hour(time)::INTEGER AS hour, t28m, e5_t2m, bad,
  e5_t2m + coalesce(o, 0.0::DOUBLE) AS t28m_pred,
  coalesce(t28m, e5_t2m + coalesce(o, 0.0::DOUBLE)) AS t28m_gf, t28m IS NULL AS gapfill
FROM masked JOIN offsets ON masked.site IS NOT DISTINCT FROM offsets.site AND hour(time) = h
""", rounded=["t28m", "e5_t2m", "t28m_pred", "t28m_gf"])
def hourly_gapfill(t: Tables) -> DataFrame:
    """Hourly means, outlier flag by site and hour, flagged readings nulled, gaps filled from a covariate."""
    df = sensors(t).withColumn("hour", F.hour("time"))
    df = clean.flag_outliers(df, ["site", "hour"], "t28m", short_groups=True)
    df = df.withColumn("t28m", clean.drop_flagged("t28m"))
    df = fill_from_group_mean(df, ["site", "hour"], "t28m", "e5_t2m", "t28m_gf", short_groups=True)
    return df.select("site", "time", "hour", "t28m", "e5_t2m", "bad", "t28m_pred", "t28m_gf", "gapfill")


# --- cleaning ---------------------------------------------------------------


@query(f"WITH {LOG}, {HOURLY} SELECT site, time, x FROM hourly", rounded=["x"])
def hourly_reduce(t: Tables) -> DataFrame:
    return hourly(t)


@query(f"""
WITH {LOG}, slots AS (
  SELECT site, x, date_trunc('day', s) + to_minutes(((hour(s) * 60 + minute(s)) // 30 * 30)::BIGINT) AS time
  FROM (SELECT site, x, time + INTERVAL 15 MINUTE AS s FROM log))
SELECT site, time, avg(x) AS x FROM slots WHERE minute(time) = 0 GROUP BY 1, 2
""", rounded=["x"])
def hourly_on_hour(t: Tables) -> DataFrame:
    """Only readings within a quarter hour of the full hour."""
    return hourly_mean(log(t), ["site"], "time", skip=("event_id",), rule="on_hour")


@query(f"""
WITH {LOG} SELECT event_id, site, x, bad FROM (
  SELECT log.*, CASE WHEN x < u - 3.5 * s OR x > u + 3 * s THEN 'bad' ELSE 'good' END AS bad
  FROM log JOIN (SELECT month(time) AS m, hour(time) AS h, avg(x) AS u, stddev_samp(x) AS s FROM log GROUP BY 1, 2) g
  ON month(time) = m AND hour(time) = h)
""", rounded=["x"])
def outlier_flag(t: Tables) -> DataFrame:
    """Month-by-hour climatology; its groups are bounded by the calendar."""
    df = log(t).withColumns({"month": F.month("time"), "hour": F.hour("time")})
    df = clean.flag_outliers(df, ["month", "hour"], "x", bound=clean.MONTH_HOUR_GROUPS)
    return df.select("event_id", "site", "x", "bad")


@query(f"""
WITH {LOG} SELECT site, h AS hour, sigma_x, u_x, count(*) FILTER (WHERE x < u_x - 3.5 * sigma_x OR x > u_x + 3 * sigma_x) AS n_bad,
  count(*) AS n FROM (
  SELECT site, hour(time)::INTEGER AS h, x, avg(x) OVER w AS u_x, stddev_samp(x) OVER w AS sigma_x
  FROM log WINDOW w AS (PARTITION BY site, hour(time))) GROUP BY ALL
""", rounded=["sigma_x", "u_x"])
def outlier_counts(t: Tables) -> DataFrame:
    df = clean.with_group_stats(log(t).withColumn("hour", F.hour("time")), ["site", "hour"], "x")
    return df.groupBy("site", "hour", "sigma_x", "u_x").agg(
        F.count_if(clean.outlier_test("x")).alias("n_bad"), F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {SHIPMENTS} SELECT l_orderkey, l_linenumber, time,
  CASE WHEN (year(time) = 1996 AND month(time) BETWEEN 4 AND 6) OR (year(time) = 1997 AND month(time) = 6)
       OR (year(time) = 2001 AND month(time) >= 3) THEN NULL ELSE x END AS x FROM shipments
""", rounded=["x"])
def period_mask(t: Tables) -> DataFrame:
    """Known-bad sensor months nulled."""
    df = shipments(t).withColumns({"year": F.year("time"), "month": F.month("time")})
    df = clean.mask_periods(df, "x", periods=((1996, 4, 6), (1997, 6, 6), (2001, 3, 12)))
    return df.select("l_orderkey", "l_linenumber", "time", "x")


@query(f"""
WITH {LOG} SELECT site, time, event_id, lag(x) OVER w AS x_l1,
  CASE WHEN row_number() OVER w = 1 THEN 0.0::DOUBLE ELSE x - lag(x) OVER w END AS delta
FROM log WINDOW w AS (PARTITION BY site ORDER BY time, event_id)
""", rounded=["x_l1", "delta"])
def first_difference(t: Tables) -> DataFrame:
    """Step and lag of the raw log, in blocks of time."""
    out = blocks.previous(log(t), ["site"], "time", ["x"], ["event_id"], difference={"x": "delta"})
    return out.select("site", "time", "event_id", "x_l1", "delta")


@query(f"""
WITH {LOG}, raw AS (
  SELECT site, time, x, CASE WHEN row_number() OVER w = 1 THEN 0.0::DOUBLE ELSE x - lag(x) OVER w END AS delta_x,
    lag(x) OVER w AS x_l1 FROM log WINDOW w AS (PARTITION BY site ORDER BY time, event_id))
SELECT site, date_trunc('hour', time + INTERVAL 30 MINUTE) AS time, avg(x) AS x, avg(x_l1) AS x_l1, avg(delta_x) AS delta_x
FROM raw GROUP BY 1, 2
""", rounded=["x", "x_l1", "delta_x"])
def difference_then_hourly(t: Tables) -> DataFrame:
    """Step and lag are taken on raw rows before the hourly mean."""
    out = blocks.previous(log(t), ["site"], "time", ["x"], ["event_id"], difference={"x": "delta_x"})
    return hourly_mean(out.drop("event_id"), ["site"], "time")


@query("""
SELECT event_id AS id, ts AS time, value AS x, NULL::DOUBLE AS price, event_type AS kind FROM events
UNION ALL
SELECT o_orderkey, o_orderdate, NULL, o_totalprice, o_orderstatus FROM orders
""")
def union_fill(t: Tables) -> DataFrame:
    """Stack two sources; a column one of them lacks is NULL."""
    a = t.events.select(F.col("event_id").alias("id"), F.col("ts").alias("time"), F.col("value").alias("x"),
                        F.col("event_type").alias("kind"))
    b = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("time"),
                        F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("kind"))
    return stack_rows([a, b], fill_missing=True).select("id", "time", "x", "price", "kind")


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate,
  CASE WHEN l_tax IS NULL OR l_discount IS NULL THEN NULL WHEN nullif(l_tax, 0.0) > l_discount THEN 'above'
       WHEN nullif(l_tax, 0.0) <= l_discount THEN 'not above' END AS side FROM lineitem
""")
def unknown_condition(t: Tables) -> DataFrame:
    """A two-way choice whose unknown condition stays unknown."""
    test = F.nullif(F.col("l_tax"), F.lit(0.0)) > F.col("l_discount")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate",
                             choose(test, F.lit("above"), F.lit("not above")).alias("side"))


# --- ingest -----------------------------------------------------------------


@query("""
SELECT 'mast' AS site, count(*) AS n, count(t28m) AS n_t, sum(t28m) AS t28m, sum(rh28m) AS rh28m, sum(precip) AS precip, year, month, day, hour
FROM (SELECT value AS t28m, sqrt(value) AS rh28m, value / 10 AS precip, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month,
      day(ts)::INTEGER AS day, hour(ts)::INTEGER AS hour FROM events) GROUP BY ALL
""", rounded=["t28m", "rh28m", "precip"])
def station_log_csv(t: Tables) -> DataFrame:
    """Write the log in the station's CSV layout, read it back into common names."""
    ts = F.col("ts")
    raw = t.events.select(
        F.dayofmonth(ts).alias("Dia"), F.month(ts).alias("Mês"), (F.year(ts) - 2000).alias("Ano"),
        F.when(F.col("event_id") % 2 == 0, F.date_format(ts, "H:mm")).otherwise(F.date_format(ts, "HH:mm:ss")).alias("Hora"),
        F.col("value").alias("Tar_28m (°C)"), F.sqrt("value").alias("RH_28m (%)"),
        (F.col("value") / 10).alias("Chuva (mm)"))
    path = staging_path(t.spark, "station-log")
    writers.write_csv(raw, path, stamp=False)
    df = readers.read_station_log(t.spark, path, "2021").withColumn("site", F.lit("mast"))
    return df.groupBy("site", "year", "month", "day", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.count("t28m").alias("n_t"),
        *[F.sum(c).alias(c) for c in ("t28m", "rh28m", "precip")])


@query("""
SELECT event_type AS site, date_trunc('hour', ts) AS time_utc, count(*) AS n, sum(value) AS t2m, sum(value / 2) AS d2m
FROM events WHERE event_type <> 'error' GROUP BY 1, 2
""", rounded=["t2m", "d2m"])
def reanalysis_csv(t: Tables) -> DataFrame:
    """Many CSV files chosen by name, half of them with the columns reversed, export-only columns dropped, names mapped, site filtered."""
    raw = t.events.select(F.col("event_id").cast("string").alias("system:index"), F.lit("{}").alias(".geo"),
                          F.col("event_type").alias("site"),
                          F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("date"),
                          F.col("value").alias("temperature_2m"), (F.col("value") / 2).alias("dewpoint_temperature_2m"))
    path = staging_path(t.spark, "reanalysis")
    even = F.col("`system:index`").cast("bigint") % 2 == 0
    writers.write_csv(raw.where(even), f"{path}/a", stamp=False)
    writers.write_csv(raw.where(~even).select(*[f"`{c}`" for c in reversed(raw.columns)]), f"{path}/b", stamp=False)
    df = readers.read_reanalysis(t.spark, f"{path}/*", name_pattern="part-*.csv").where("site <> 'error'")
    return df.groupBy("site", clock.floor_time(F.col("time_utc"), 60).alias("time_utc")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("t2m").alias("t2m"), F.sum("d2m").alias("d2m"))


@query("""
SELECT event_type, count(*) AS n, sum(value) AS value, max(ts) AS last_ts, DATE '2024-02-01' AS run_date FROM events GROUP BY 1
""", rounded=["value"])
def product_parquet(t: Tables) -> DataFrame:
    """Run-dated snappy Parquet out, three columns of it back in."""
    path = staging_path(t.spark, "product")
    writers.write_parquet(t.events, path, run_date=dt.date(2024, 2, 1))
    df = readers.read_table(t.spark, path, ["event_type", "ts", "value", "run_date"])
    return df.groupBy("event_type", "run_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"), F.max("ts").alias("last_ts"))


def _archive(t: Tables, label: str) -> list[str]:
    """Events as CSV, written to one folder a type, ``archive.<type>.e5``; the folders."""
    path = staging_path(t.spark, label)
    kinds = [r[0] for r in t.events.select("event_type").where("event_type IS NOT NULL").distinct().collect()]  # a handful of types
    for kind in kinds:
        rows = t.events.where(F.col("event_type") == kind).select("event_id", "value")
        writers.write_csv(rows, f"{path}/archive.{kind}.e5", stamp=False)
    return [f"{path}/archive.{kind}.e5" for kind in sorted(kinds)]


@query(f"""
WITH {LOG} SELECT DISTINCT site AS variable FROM log
""")
def variable_from_name(t: Tables) -> DataFrame:
    """Variable code between the first two dots of a file name, distinct."""
    named = log(t).select(F.concat_ws(".", F.lit("401905"), "site", F.lit("e5.nc")).alias("file"))
    return named.select(naming.variable_of(F.col("file")).alias("variable")).where("variable IS NOT NULL").distinct()


@query("""
SELECT event_type AS variable, count(*) AS n, sum(value) AS value FROM events WHERE event_type IN ('click', 'view') GROUP BY 1
""", rounded=["value"])
def files_from_list(t: Tables) -> DataFrame:
    """CSV files from an explicit list of paths; each row's variable is in the path it came from."""
    listed = [p for p in _archive(t, "listed") if ".click." in p or ".view." in p]
    df = readers.read_csv(t.spark, listed).withColumn("variable", naming.variable_of(F.element_at(F.split("_metadata.file_path", "/"), -2)))
    return df.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").try_cast("double")).alias("value"))


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity AS e5_quantity, l_extendedprice AS e5_price FROM lineitem
""")
def prefixed_names(t: Tables) -> DataFrame:
    """Rename by map, lower-case, prefix all but protected names."""
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate",
                           F.col("l_quantity").alias("QUANTITY"), F.col("l_extendedprice").alias("Price"))
    df = naming.prefix(naming.lower_names(df), "e5_", ("l_orderkey", "l_linenumber", "l_shipdate"))
    return naming.rename(df, {"e5_quantity": "e5_quantity"})


@query("""
SELECT p_partkey, string_split(p_type, ' ')[1] AS head, substring(p_name, 1, 4) AS four, regexp_replace(p_brand, '[^0-9]', '', 'g')::INTEGER AS code,
  p_brand || '/' || p_type AS joined, contains(p_type, 'STEEL') AS steel FROM part
""")
def string_pieces(t: Tables) -> DataFrame:
    """Split, cut, replace, join and test text; cast what is a number."""
    return t.part.select(
        "p_partkey", F.split("p_type", " ", 2)[0].alias("head"), F.substring("p_name", 1, 4).alias("four"),
        F.regexp_replace("p_brand", "[^0-9]", "").try_cast("int").alias("code"),
        F.concat_ws("/", "p_brand", "p_type").alias("joined"), F.col("p_type").contains("STEEL").alias("steel"))


# --- time -------------------------------------------------------------------


@query("""
SELECT event_id, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day,
  hour(ts)::INTEGER AS hour, minute(ts)::INTEGER AS minute, dayofyear(ts)::INTEGER AS yday,
  (ts - INTERVAL 3 HOUR) AS time_local, (ts - INTERVAL 3 HOUR)::DATE AS date_local,
  date_trunc('hour', ts + INTERVAL 30 MINUTE) AS nearest_hour, date_trunc('month', ts)::DATE AS month_start,
  year(ts)::VARCHAR || '_' || month(ts)::VARCHAR AS ym,
  date_trunc('hour', ts) AS rebuilt
FROM events
""")
def time_parts(t: Tables) -> DataFrame:
    ts = F.col("ts")
    p = clock.parts(ts)
    local = clock.to_local(ts)
    return t.events.select(
        "event_id", *[c.alias(n) for n, c in p.items()], local.alias("time_local"),
        F.to_date(local).alias("date_local"), clock.round_time(ts, 60).alias("nearest_hour"),
        F.trunc(F.to_date(ts), "month").alias("month_start"), clock.year_month(ts).alias("ym"),
        clock.from_parts(p["year"], p["month"], p["day"], p["hour"]).alias("rebuilt"))


@query("""
SELECT event_id, year(ts) + (epoch(date_trunc('second', ts)) - epoch(make_date(year(ts), 1, 1)::TIMESTAMP))
  / (epoch(make_date(year(ts) + 1, 1, 1)::TIMESTAMP) - epoch(make_date(year(ts), 1, 1)::TIMESTAMP)) AS ddate,
  date_diff('second', date_trunc('day', ts), date_trunc('second', ts)) AS into_day
FROM events
""", rounded=["ddate"])
def decimal_year(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select("event_id", clock.decimal_year(ts).alias("ddate"),
                           clock.elapsed_seconds(ts, clock.midnight(ts)).alias("into_day"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 31 + 1 <= day(last_day(o_orderdate)) THEN
    make_timestamp(year(o_orderdate), month(o_orderdate), o_orderkey % 31 + 1, o_orderkey % 24, 0, 0) END AS built,
  CASE WHEN year(o_orderdate) < 2000 THEN year(o_orderdate) - 1900 + 2000 ELSE year(o_orderdate) END::INTEGER AS year,
  make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), o_orderkey % 24, o_orderkey % 60,
    CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_orderkey % 59 END) AS clock_time
FROM orders
""")
def parsed_time(t: Tables) -> DataFrame:
    """Parts to time (30 February is NULL), two-digit years, two clock spellings."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    text = F.when(k % 2 == 0, F.format_string("%d:%02d", k % 24, k % 60)).otherwise(
        F.format_string("%02d:%02d:%02d", k % 24, k % 60, k % 59))
    short = F.when(F.year(d) < 2000, F.year(d) - 1900).otherwise(F.year(d))
    return t.orders.select(
        "o_orderkey", clock.from_parts(F.year(d), F.month(d), k % 31 + 1, k % 24).alias("built"),
        clock.full_year(short).alias("year"), clock.from_clock_text(F.to_date(d), text).alias("clock_time"))


@query("""
SELECT event_id, date_trunc('second', ts) AS stamp,
  TIMESTAMP '1900-01-01 00:00:00' + to_hours(date_diff('hour', TIMESTAMP '1900-01-01 00:00:00', date_trunc('hour', ts))) AS grid_time
FROM events
""")
def stamp_prefix(t: Tables) -> DataFrame:
    """Time from the digits of a record id, and from archive hours."""
    ts = F.col("ts")
    record = F.concat(F.date_format(ts, "yyyyMMddHHmmss"), F.lit("_0000"))
    hours = F.floor(clock.elapsed_seconds(ts, F.lit(clock.GRID_EPOCH).cast("timestamp_ntz")) / 3600)
    return t.events.select("event_id", clock.from_stamp_prefix(record).alias("stamp"),
                           clock.from_grid_hours(hours).alias("grid_time"))


# --- physics ----------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, t, rh, 0.6112 * exp(17.62 * t / (t + 243.12)) AS esat,
  0.6112 * exp(17.62 * t / (t + 243.12)) - 0.6112 * exp(17.62 * dew / (dew + 243.12)) AS vpd_dew,
  0.6112 * exp(17.62 * t / (t + 243.12)) * (1 - rh / 100) AS vpd_rh,
  0.622 * e / (p / 100 - 0.378 * e) AS q
FROM (SELECT *, rh / 100 * 6.112 * exp(17.67 * t / (t + 243.5)) AS e FROM (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity * 0.7::DOUBLE AS t, l_quantity * 0.7::DOUBLE - l_discount * 50 AS dew,
    100 - l_tax * 600 AS rh, 90000 + l_extendedprice / 10 AS p FROM lineitem))
""", rounded=["t", "rh", "esat", "vpd_dew", "vpd_rh", "q"])
def humidity(t: Tables) -> DataFrame:
    """Saturation pressure, vapour pressure deficit two ways, specific humidity."""
    temp, rh = F.col("l_quantity") * 0.7, 100 - F.col("l_tax") * 600
    dew, pressure = temp - F.col("l_discount") * 50, 90000 + F.col("l_extendedprice") / 10
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", temp.alias("t"), rh.alias("rh"),
        moisture.saturation_pressure(temp).alias("esat"), moisture.deficit_from_dew_point(temp, dew).alias("vpd_dew"),
        moisture.deficit_from_humidity(temp, rh).alias("vpd_rh"),
        moisture.specific_humidity(rh / 100, temp, pressure).alias("q"))


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, sqrt(u * u + v * v) AS ws, CASE WHEN u < 0 THEN 0.0 ELSE u END AS u_clamped,
  l_quantity - 273.15 AS celsius, l_extendedprice / 3600 AS flux, l_tax * 1000 AS mm, l_quantity * 2 AS mm_per_h,
  l_quantity + 180.0::DOUBLE - 360 AS lon, -0.5 * ((-l_tax - 1 + 0.1) / (-l_tax - 1 - 0.1)) + 0.5 AS conductance
FROM (SELECT *, (l_discount - 0.05) * 100 AS u, l_tax * 100 AS v FROM lineitem)
""", rounded=["ws", "u_clamped", "celsius", "flux", "mm", "mm_per_h", "lon", "conductance"])
def wind_and_units(t: Tables) -> DataFrame:
    u, v = (F.col("l_discount") - 0.05) * 100, F.col("l_tax") * 100
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", moisture.wind_speed(u, v).alias("ws"),
        moisture.not_negative(u).alias("u_clamped"), moisture.kelvin_to_celsius(F.col("l_quantity")).alias("celsius"),
        moisture.joules_to_watts(F.col("l_extendedprice")).alias("flux"),
        moisture.metres_to_mm(F.col("l_tax")).alias("mm"),
        moisture.half_hour_amount_to_rate(F.col("l_quantity")).alias("mm_per_h"),
        moisture.signed_longitude(F.col("l_quantity") + 180).alias("lon"),
        moisture.conductance_curve(-F.col("l_tax") - 1).alias("conductance"))
