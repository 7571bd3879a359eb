"""Queries that build the model frame and fit models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions import naming
from gapweave.operators import evaluate, models
from gapweave.plans import daily as daily_plan
from gapweave.plans import filling, frame, hourly
from gapweave.plans.catalog import Tables, query
from gapweave.plans.standin import SENSOR_HOURS, covariate_inputs, frame_sql, model_days, model_slots, sensors


_ESAT = "0.6112 * exp(17.62 * {0} / ({0} + 243.12))"


@query(f"""
WITH {SENSOR_HOURS},
e AS (SELECT site, time AS time_utc, coalesce(e5_t2m, 7.0::DOUBLE) + 290 - 273.15 AS e5_t2m, coalesce(e5_ws, 6.0::DOUBLE) + 280 - 273.15 AS e5_d2m,
  sqrt(coalesce(g_p, 1.0::DOUBLE) ** 2 + coalesce(c_p, 2.0::DOUBLE) ** 2) AS e5_ws, coalesce(g_p, 0.0::DOUBLE) / 1000 AS r, t28m,
  coalesce(e5_ws, 4.0::DOUBLE) * 5 AS rh28m FROM sensors WHERE site IS NOT NULL),
e2 AS (SELECT *, {frame_sql('max', 'r', 24, 'time_utc')} * 1000 AS e5_tot_p24h_max, {frame_sql('sum', 'r', 24, 'time_utc')} * 1000 AS e5_tot_p24h_sum,
  {_ESAT.format('e5_t2m')} AS e5_esat, {_ESAT.format('e5_t2m')} - {_ESAT.format('e5_d2m')} AS e5_vpd FROM e),
half AS (SELECT site, date_trunc('day', time) + to_minutes(((hour(time) * 60 + minute(time)) // 30 * 30)::BIGINT) AS time_utc, avg(x) AS p
  FROM placed WHERE site IS NOT NULL GROUP BY 1, 2),
g AS (SELECT site, date_trunc('hour', time_utc) AS time_utc, avg(p) AS g_p FROM half GROUP BY 1, 2),
g2 AS (SELECT *, {frame_sql('sum', 'g_p', 3, 'time_utc')} AS g_p3h_sum, {frame_sql('sum', 'g_p', 120, 'time_utc')} AS g_p120h_sum FROM g),
c AS (SELECT site, time::DATE AS date, sum(x) AS c_p24h FROM placed WHERE site IS NOT NULL GROUP BY 1, 2),
c2 AS (SELECT *, {frame_sql('sum', 'c_p24h', 2, 'date')} AS c_p48h, {frame_sql('sum', 'c_p24h', 5, 'date')} AS c_p120h FROM c),
j AS (SELECT e2.*, g_p, g_p3h_sum, g_p120h_sum, c_p24h, c_p48h, c_p120h, e2.time_utc - INTERVAL 3 HOUR AS time_local,
  {_ESAT.format('t28m')} * (1 - rh28m / 100) AS vpd28m FROM e2 JOIN g2 ON e2.site = g2.site AND e2.time_utc = g2.time_utc
  JOIN c2 ON e2.site = c2.site AND e2.time_utc::DATE = c2.date)
SELECT site, time_utc, time_local, time_local::DATE AS date, month(time_local)::INTEGER AS month, hour(time_local)::INTEGER AS hour,
  e5_t2m, e5_d2m, e5_ws, e5_esat, e5_vpd, e5_tot_p24h_max, e5_tot_p24h_sum, g_p, g_p3h_sum, g_p120h_sum, c_p24h, c_p48h, c_p120h,
  t28m, rh28m, vpd28m, avg(e5_t2m) OVER w AS e5_t2m_u, e5_t2m - avg(e5_t2m) OVER w AS e5_t2m_anom
FROM j WINDOW w AS (PARTITION BY site, month(time_local), hour(time_local))
""", rounded=["e5_t2m", "e5_d2m", "e5_ws", "e5_esat", "e5_vpd", "e5_tot_p24h_max", "e5_tot_p24h_sum", "g_p", "g_p3h_sum",
              "g_p120h_sum", "c_p24h", "c_p48h", "c_p120h", "t28m", "rh28m", "vpd28m", "e5_t2m_u", "e5_t2m_anom"])
def model_frame(t: Tables) -> DataFrame:
    """The whole import chain: three covariate sources, station record, calendar, anomaly."""
    reanalysis, satellite, rain, station = covariate_inputs(t)
    out = frame.model_frame(frame.covariates(reanalysis, satellite, rain), station)
    return out.select("site", "time_utc", "time_local", "date", "month", "hour", "e5_t2m", "e5_d2m", "e5_ws", "e5_esat",
                      "e5_vpd", "e5_tot_p24h_max", "e5_tot_p24h_sum", "g_p", "g_p3h_sum", "g_p120h_sum", "c_p24h",
                      "c_p48h", "c_p120h", "t28m", "rh28m", "vpd28m", "e5_t2m_u", "e5_t2m_anom")


@query(f"""
WITH {SENSOR_HOURS}, fit AS (SELECT regr_slope(t28m, e5_t2m) AS a, regr_intercept(t28m, e5_t2m) AS b FROM sensors)
SELECT site, time, e5_t2m, b + a * e5_t2m AS pred FROM sensors, fit WHERE e5_t2m IS NOT NULL
""", rounded=["e5_t2m", "pred"])
def line_model(t: Tables) -> DataFrame:
    """Straight-line model fitted on rows with both values, scored on all rows with the covariate."""
    s = sensors(t).where("e5_t2m IS NOT NULL").select("site", "time", "e5_t2m", "t28m")
    model = models.fit_linear(s.where("t28m IS NOT NULL"), "t28m", ["e5_t2m"])
    return models.score(model, s, "pred", ["e5_t2m"]).drop("t28m")


# --- trees ------------------------------------------------------------------

@query()
def boosted_search(t: Tables) -> DataFrame:
    """Boosted-tree candidates on the training months, best first."""
    split = hourly.split_frame(model_days(t))
    found = hourly.fit_targets(split, ["t28m"])["t28m"]
    return found.leaderboard(t.spark)


@query()
def hourly_product(t: Tables) -> DataFrame:
    """Observed and predicted columns for every row, all targets."""
    data = model_days(t).persist()
    fitted = hourly.fit_targets(hourly.split_frame(data))
    return hourly.predict(data, fitted)


@query()
def hourly_skill(t: Tables) -> DataFrame:
    """Skill of the chosen model on the test half of the held-out months."""
    split = hourly.split_frame(model_days(t)).persist()
    return hourly.test_skill(split, hourly.fit_targets(split, ["t28m"]), "t28m")


@query()
def daily_product(t: Tables) -> DataFrame:
    """Fit on complete days, predict min, mean and max of all days."""
    out, _, _ = daily_plan.run(model_slots(t).persist(), hours=5)
    return out


@query()
def forest_importance(t: Tables) -> DataFrame:
    """Random forest, impurity importance of every covariate."""
    data = model_days(t)
    inputs = naming.covariates(data.columns)
    model = models.fit_forest(models.usable(data, "t28m", "train"), "t28m", inputs)
    return models.importance(t.spark, model, inputs)


# --- linear and smooth ------------------------------------------------------


@query()
def linear_search(t: Tables) -> DataFrame:
    """Elastic-net candidates, best first; the grid is the one that ``linear_board`` holds against SQL."""
    data = model_days(t)
    found = models.search_linear(models.usable(data, "t28m", "train"), "t28m", naming.covariates(data.columns))
    return found.leaderboard(t.spark)


def _smooth_terms(df: DataFrame) -> dict[str, dict]:
    calendar = {**models.cyclic("month", 12), **models.cyclic("hour", 7)}
    warm = models.spline("e5_t2m", models.knots(df, "e5_t2m"))
    wind = models.spline("e5_ws", models.knots(df, "e5_ws", 3))
    return {"calendar": calendar, "calendar_warm": {**calendar, **warm}, "calendar_warm_wind": {**calendar, **warm, **wind},
            "warm_by_wind": {**calendar, **models.tensor(warm, wind)}}


def _gappy_days(t: Tables) -> DataFrame:
    """A target and a covariate that are missing on some days."""
    df = model_days(t).select("site", "date", "month", "hour", "t28m", "e5_t2m", "e5_ws", "g_p")
    # wind is missing at the head of each year, as a rolling covariate is at the head of a series
    return df.withColumns({"t28m": F.when(F.round("g_p", 6) > 0.045, F.col("t28m")),
                           "e5_ws": F.when(F.dayofyear("date") > 20, F.col("e5_ws"))}).drop("g_p")


@query()
def smooth_models_by_aic(t: Tables) -> DataFrame:
    """Smooth additive models of growing size, ranked by Akaike's criterion."""
    data = _gappy_days(t).persist()
    train = models.usable(data, "t28m", "train")
    fitted = {n: models.fit_general(models.with_terms(train, v), "t28m", list(v), ridge=1e-6)
              for n, v in _smooth_terms(data).items()}
    return models.rank_by_aic(t.spark, fitted)


@query()
def smooth_gapfill(t: Tables) -> DataFrame:
    """Smooth additive model trained on three tenths of the rows, used to fill the gaps."""
    data = _gappy_days(t).persist()
    return filling.smooth_fill(data, "t28m", _smooth_terms(data)["calendar_warm_wind"], ["site", "date"])


@query()
def smooth_test_error(t: Tables) -> DataFrame:
    """Error of the smooth model on an equally large random test set."""
    data = _gappy_days(t).persist()
    terms = _smooth_terms(data)["calendar_warm"]
    model, test = filling.smooth_model(data, "t28m", terms, ["site", "date"])
    return evaluate.skill(models.score(model, test, "pred", list(terms)), "t28m", "pred")


@query()
def expectation_model(t: Tables) -> DataFrame:
    """Expected value from the calendar and a straight line over the years, by site and year."""
    data = model_days(t).select("site", "year", "month", "hour", "t28m").persist()
    terms = {**models.cyclic("month", 12), **models.cyclic("hour", 7), "year_line": F.col("year") - 1998}
    whole = models.with_terms(data, terms)
    model = models.fit_general(models.usable(whole, "t28m", "train"), "t28m", list(terms))
    return evaluate.skill(models.score(model, whole, "pred", list(terms)), "t28m", "pred", ["site", "year"])


@query()
def gamma_skill(t: Tables) -> DataFrame:
    """Gamma regression with log link, in-sample skill by site."""
    data = _gappy_days(t).persist()
    terms = _smooth_terms(data)["calendar_warm"]
    train = models.with_terms(models.usable(data, "t28m", "train"), terms)
    model = models.fit_general(train, "t28m", list(terms), family="gamma", link="log", ridge=1e-4)
    return evaluate.skill(models.score(model, train, "pred", list(terms)), "t28m", "pred", ["site"])
