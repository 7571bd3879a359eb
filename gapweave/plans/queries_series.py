"""Checked queries: moving frames, running sums, positions, ranks, quantiles, grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.operators import blocks, grid as grids, quantiles, rolling
from gapweave.operators.gapfill import running_within
from gapweave.operators.reshape import to_wide
from gapweave.plans.catalog import Tables, query
from gapweave.plans.standin import GAPPY, GRID, HOURLY, LOG, SHIPMENTS, frame_sql, grid, hourly, log, shipments
from gapweave.sources import layouts


# --- hourly series ----------------------------------------------------------

_SUMS = {f"g_p{n}h_sum": ("x", "sum", n) for n in layouts.RAIN_HOURS}


@query(f"WITH {GAPPY}, {HOURLY} SELECT site, time, "
       + ", ".join(f"{frame_sql('sum', 'x', n)} AS {name}" for name, (_, _, n) in _SUMS.items()) + " FROM hourly",
       rounded=list(_SUMS))
def rolling_sums(t: Tables) -> DataFrame:
    """Trailing sums over 3 to 120 rows; one gap empties the frame."""
    return rolling.roll_series(hourly(t, gaps=True), ["site"], "time", _SUMS).drop("x")


@query(f"WITH {LOG}, {HOURLY} SELECT site, time, {frame_sql('max', 'x', 24)} * 1000 AS tot_p24h_max, "
       f"{frame_sql('sum', 'x', 24)} * 1000 AS tot_p24h_sum FROM hourly", rounded=["tot_p24h_max", "tot_p24h_sum"])
def rolling_day(t: Tables) -> DataFrame:
    """24-row maximum and total."""
    df = rolling.roll_series(hourly(t), ["site"], "time", {"m": ("x", "max", 24), "s": ("x", "sum", 24)})
    return df.select("site", "time", (F.col("m") * 1000).alias("tot_p24h_max"), (F.col("s") * 1000).alias("tot_p24h_sum"))


@query(f"WITH {GAPPY}, {HOURLY} SELECT site, time, {frame_sql('max', 'x', 72)} AS x_max_72h, "
       f"{frame_sql('avg', 'x', 72)} AS x_mean_72h, {frame_sql('min', 'x', 72)} AS x_min_72h FROM hourly",
       rounded=["x_max_72h", "x_mean_72h", "x_min_72h"])
def rolling_extremes(t: Tables) -> DataFrame:
    return rolling.extremes(hourly(t, gaps=True), ["site"], "time", ["x"]).drop("x")


@query(f"""
WITH {LOG}, {HOURLY}, named AS (SELECT CASE WHEN site <> 'signup' THEN site END AS site, time, x FROM hourly),
span AS (SELECT site, min(time) AS a, max(time) AS b FROM named GROUP BY 1),
full_hours AS (SELECT site, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS time FROM span),
filled AS (SELECT f.site, f.time, h.x FROM full_hours f LEFT JOIN named h ON f.site IS NOT DISTINCT FROM h.site AND f.time = h.time)
SELECT site, time, x, {frame_sql('sum', 'x', 6)} AS x6h FROM filled
""", rounded=["x", "x6h"])
def rolling_by_time(t: Tables) -> DataFrame:
    """Missing hours added first, so six rows are six hours; one series has no name."""
    named = hourly(t).withColumn("site", F.when(F.col("site") != "signup", F.col("site")))
    full = rolling.fill_hours(named, ["site"], "time")
    return rolling.roll_series(full, ["site"], "time", {"x6h": ("x", "sum", 6)})


@query(f"WITH {SHIPMENTS}, daily AS (SELECT site, time, sum(x) AS c_p24h FROM shipments GROUP BY 1, 2) "
       f"SELECT site, time, c_p24h, {frame_sql('sum', 'c_p24h', 2)} AS c_p48h, "
       f"{frame_sql('sum', 'c_p24h', 5)} AS c_p120h FROM daily", rounded=["c_p24h", "c_p48h", "c_p120h"])
def rolling_days(t: Tables) -> DataFrame:
    """Daily series, two- and five-day sums."""
    daily = shipments(t).groupBy("site", "time").agg(F.sum("x").alias("c_p24h"))
    return rolling.roll_series(daily, ["site"], "time", {k: ("c_p24h", "sum", n) for k, n in layouts.RAIN_DAYS.items()})


@query(f"WITH {LOG}, {HOURLY} SELECT site, time, sum(x) OVER (PARTITION BY site ORDER BY time "
       "ROWS UNBOUNDED PRECEDING) AS total FROM hourly", rounded=["total"])
def cumulative_hours(t: Tables) -> DataFrame:
    return running_within(hourly(t), ["site"], "time", "x", "total").drop("x")


# --- raw series, in blocks --------------------------------------------------


@query(f"WITH {GAPPY} SELECT site, time, event_id, sum(x) OVER (PARTITION BY site ORDER BY time, event_id "
       "ROWS UNBOUNDED PRECEDING) AS running FROM log", rounded=["running"])
def cumulative_raw(t: Tables) -> DataFrame:
    return blocks.running_sum(log(t, gaps=True), ["site"], "time", "x", ["event_id"]).drop("x")


@query(f"WITH {LOG} SELECT site, time, event_id, row_number() OVER (PARTITION BY site ORDER BY time, event_id) AS idx FROM log")
def row_positions(t: Tables) -> DataFrame:
    return blocks.row_index(log(t), ["site"], "time", ["event_id"]).select("site", "time", "event_id", "idx")


@query(f"WITH {GAPPY} SELECT site, time, event_id, {frame_sql('sum', 'x', 12, 'time, event_id')} AS s12, "
       f"{frame_sql('max', 'x', 48, 'time, event_id')} AS m48 FROM log", rounded=["s12", "m48"])
def rolling_raw(t: Tables) -> DataFrame:
    """Row frames over raw readings, cut into chunks that carry a copy of the rows before them."""
    out = blocks.roll(log(t, gaps=True), ["site"], "time", {"s12": ("x", "sum", 12), "m48": ("x", "max", 48)},
                      ["event_id"])
    return out.drop("x")


# --- ranks and quantiles ----------------------------------------------------


@query(f"WITH {LOG} SELECT event_id, site, hour(time)::INTEGER AS hour, "
       "cume_dist() OVER (PARTITION BY hour(time) ORDER BY x) AS tau FROM log", rounded=["tau"])
def cumulative_share(t: Tables) -> DataFrame:
    """Empirical distribution per hour of day."""
    df = log(t).withColumn("hour", F.hour("time"))
    return quantiles.cumulative_share(df, ["hour"], "x", bound=25).select("event_id", "site", "hour", "tau")


@query(f"""
WITH {GAPPY} SELECT site, quantile_cont(x, 0.0) AS q_min, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q_median,
  quantile_cont(x, 0.75) AS q3, quantile_cont(x, 1.0) AS q_max, avg(x) AS q_mean, count(*) - count(x) AS n_null FROM log GROUP BY 1
""", rounded=["q_min", "q1", "q_median", "q3", "q_max", "q_mean"])
def five_numbers(t: Tables) -> DataFrame:
    return quantiles.five_numbers(log(t, gaps=True), ["site"], "x")


@query(f"""
WITH {SHIPMENTS} SELECT site, year(time)::INTEGER AS year, quantile_cont(x, 0.01) AS q01, quantile_cont(x, 0.5) AS q50,
  quantile_cont(x, 0.99) AS q99 FROM shipments GROUP BY 1, 2
""", rounded=["q01", "q50", "q99"])
def yearly_quantiles(t: Tables) -> DataFrame:
    df = shipments(t).withColumn("year", F.year("time"))
    q = quantiles.quantiles(df, ["site", "year"], {"q": "x"}, (0.01, 0.5, 0.99))
    return q.select("site", "year", *[F.col("q")[i].alias(n) for i, n in enumerate(("q01", "q50", "q99"))])


@query(f"""
WITH {SHIPMENTS} SELECT site, y, n, upto - n AS below, upto, total FROM (
  SELECT site, y, n, (sum(n) OVER (PARTITION BY site ORDER BY y))::BIGINT AS upto, (sum(n) OVER (PARTITION BY site))::BIGINT AS total
  FROM (SELECT site, y, count(*) AS n FROM shipments GROUP BY site, y))
""")
def value_ranks(t: Tables) -> DataFrame:
    """Heavily repeated values: ranks of the distinct values of each group."""
    return quantiles.value_ranks(shipments(t), ["site"], "y")


# --- grids ------------------------------------------------------------------


@query(f"""
WITH {GRID} SELECT event_id, variable, lon - 360 AS lon, lat, time_hours, lead_hours,
  TIMESTAMP '1900-01-01 00:00:00' + to_hours(time_hours + lead_hours) AS time_utc,
  TIMESTAMP '1900-01-01 00:00:00' + to_hours(time_hours + lead_hours - 3) AS time_local, value
FROM grid WHERE abs(lon - 360 + 51.5) < 0.1 AND abs(lat + 1.75) < 0.1
""", rounded=["value"])
def cell_series(t: Tables) -> DataFrame:
    """The station's cell of the grid; the cell test is on stored columns, so on a stored grid it reaches the scan."""
    return grids.select_cell(grid(t))


@query(f"""
WITH {GRID} SELECT lon, lat, time_hours, {", ".join(f"max(value) FILTER (WHERE variable = '{v}') AS {v}" for v in ("click", "error", "purchase", "signup", "view"))}
FROM grid WHERE lon = 308.5 AND lat = -1.75 GROUP BY 1, 2, 3
""", rounded=["click", "error", "purchase", "signup", "view"])
def variables_side_by_side(t: Tables) -> DataFrame:
    cell = grids.exact_cell(grid(t))
    kinds = ["click", "error", "purchase", "signup", "view"]
    return to_wide(cell, ["lon", "lat", "time_hours"], "variable", kinds, "value", how=F.max)


@query(f"WITH {GRID} SELECT variable, lon, lat, avg(value) AS val, count(*) AS n FROM grid GROUP BY 1, 2, 3", rounded=["val"])
def spatial_mean(t: Tables) -> DataFrame:
    return grids.spatial_mean(grid(t))


@query(f"WITH {GRID} SELECT variable, time_hours, avg(value) AS val, count(*) AS n_cells FROM grid GROUP BY 1, 2", rounded=["val"])
def areal_mean(t: Tables) -> DataFrame:
    return grids.areal_mean(grid(t))


@query(f"""
WITH {GRID} SELECT variable, lead_hours, avg(value) AS val, sum(value) AS total, count(*) AS n FROM grid GROUP BY 1, 2
""", rounded=["val", "total"])
def lead_time(t: Tables) -> DataFrame:
    return grids.lead_means(grid(t))


@query(f"""
WITH {GRID}, runs AS (SELECT variable, time_hours, lead_hours, sum(value) AS acc FROM grid GROUP BY 1, 2, 3)
SELECT variable, time_hours, lead_hours, acc, acc - lag(acc) OVER (PARTITION BY variable, time_hours ORDER BY lead_hours) AS step FROM runs
""", rounded=["acc", "step"])
def deaccumulate(t: Tables) -> DataFrame:
    """Steps between the leads of one forecast run."""
    runs = grid(t).groupBy("variable", "time_hours", "lead_hours").agg(F.sum("value").alias("acc"))
    return rolling.deaccumulate(runs, ["variable", "time_hours"], "lead_hours", "acc", "step")
