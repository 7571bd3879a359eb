"""Smooth additive models against SQL: normal equations are solved by sweeps over a one-row table of cross products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.operators import smooth
from gapweave.operators.smooth import Cyclic, Line, Product, Spline, Surface
from gapweave.plans import filling
from gapweave.plans.catalog import Tables, query
from gapweave.plans.queries_checks import _DAYS, _GAPPY_DAYS
from gapweave.plans.queries_models import _gappy_days
from gapweave.plans.standin import model_days


def sweeps_sql(columns: Sequence[str], target: str, source: str, penalty: Sequence[Sequence[str]] | None = None) -> str:
    """CTEs ``s0`` (cross products of ``columns`` and the target) to ``s<n>`` (that many columns swept).

    After a sweep of the first columns, ``m_i_<y>`` holds their least-squares coefficients, ``m_y_y`` the residual sum of squares.
    """
    named = [*columns, target]
    n = len(named)
    cells = [(i, j) for i in range(n) for j in range(n)]
    sums = ", ".join(f"sum({named[i]} * {named[j]})" + (f" + {penalty[i][j]}" if penalty and max(i, j) < n - 1 else "") + f" AS m_{i}_{j}"
                     for i, j in cells)
    out = [f"s0 AS (SELECT {sums} FROM {source})"]
    for k in range(n - 1):
        step = []
        for i, j in cells:
            if i == k and j == k:
                new = f"1 / m_{k}_{k}"
            elif i == k:
                new = f"m_{k}_{j} / m_{k}_{k}"
            elif j == k:
                new = f"-m_{i}_{k} / m_{k}_{k}"
            else:
                new = f"m_{i}_{j} - m_{i}_{k} * m_{k}_{j} / m_{k}_{k}"
            step.append(f"{new} AS m_{i}_{j}")
        out.append(f"s{k + 1} AS (SELECT {', '.join(step)} FROM s{k})")
    return ", ".join(out)


_STRAIGHT = ("e5_t2m", "e5_ws", "g_p")
_LADDER = sweeps_sql(["1.0::DOUBLE", *_STRAIGHT], "t28m", "days")
_RUNGS = " UNION ALL ".join(
    f"SELECT {k} AS covariates, (SELECT count(*) FROM days)::DOUBLE AS n, m_0_4 AS b0, "
    + ", ".join(f"{f'm_{i}_4' if i <= k else 'NULL::DOUBLE'} AS b{i}" for i in (1, 2, 3)) + f", m_4_4 AS rss FROM s{k + 1}" for k in range(4))


@query(f"""
WITH {_DAYS}, {_LADDER}, rungs AS ({_RUNGS})
SELECT covariates, b0, b1, b2, b3, sqrt(rss / n) AS error, covariates + 1.0::DOUBLE AS edf,
  n * (ln(2 * pi() * rss / n) + 1) + 2 + 2 * (covariates + 1) AS aic FROM rungs
""", rounded=["b0", "b1", "b2", "b3", "error", "edf", "aic"])
def smooth_ladder(t: Tables) -> DataFrame:
    """Four nested models from one pass: coefficients, error, effective degrees of freedom and AIC."""
    g = smooth.gram(model_days(t), [Line(c) for c in _STRAIGHT], "t28m")
    rows = []
    for k in range(4):
        f = smooth.fit(g, _STRAIGHT[:k])
        b = [float(c[0]) for c in f.coefficients] + [None] * (3 - k)
        rows.append((k, f.intercept, *b, (f.rss / f.n) ** 0.5, f.edf, f.aic))
    return t.spark.createDataFrame(rows, "covariates int, b0 double, b1 double, b2 double, b3 double, error double, edf double, aic double")


_BUMP = "CASE WHEN abs({t}) < 1 THEN 2.0::DOUBLE / 3 - ({t}) ** 2 + abs({t}) ** 3 / 2 WHEN abs({t}) < 2 THEN (2 - abs({t})) ** 3 / 6 ELSE 0.0::DOUBLE END"


def _ring_sql(x: str, period: int, k: int, j: int) -> str:
    u = f"({x} * {k}.0::DOUBLE / {period})"
    # the distance around the ring
    t = f"(({u} - {j} + {k} / 2.0) - {k} * floor(({u} - {j} + {k} / 2.0) / {k}) - {k} / 2.0)"
    return _BUMP.format(t=t)


def _steps_sql(x: str, low: str, high: str, k: int, j: int) -> str:
    return _BUMP.format(t=f"(({x} - {low}) * {k - 3} / ({high} - {low}) - {j - 1})")


_WARM = 7
_BENT = smooth._bending(_WARM, _WARM - 3, lambda j: [j - 1])
_FIXED_RIDGE = [[repr(100.0 * float(v)) + "::DOUBLE" for v in row] for row in _BENT]


@query(f"""
WITH {_DAYS}, r AS (SELECT min(e5_t2m) AS low, max(e5_t2m) AS high FROM days),
b AS (SELECT site, date, t28m, {", ".join(_steps_sql('e5_t2m', 'low', 'high', _WARM, j) + f' AS w{j}' for j in range(_WARM))},
  {", ".join(_ring_sql('month', 12, 6, j) + f' AS c{j}' for j in range(6))} FROM days, r)
SELECT site, date, {", ".join(f"w{j}" for j in range(_WARM))}, {", ".join(f"c{j}" for j in range(6))} FROM b
""", rounded=[*[f"w{j}" for j in range(_WARM)], *[f"c{j}" for j in range(6)]])
def smooth_bases(t: Tables) -> DataFrame:
    """Values of a spline basis over the range of a covariate, and of a ring over the months."""
    data = model_days(t)
    held = smooth.with_basis(data, smooth.prepare([Spline("e5_t2m", _WARM), Cyclic("month", 12, 6)], data))
    return held.select("site", "date", *[F.get("__b0", F.lit(j)).alias(f"w{j}") for j in range(_WARM)],
                       *[F.get("__b1", F.lit(j)).alias(f"c{j}") for j in range(6)])


@query(f"""
WITH {_DAYS}, r AS (SELECT min(e5_t2m) AS low, max(e5_t2m) AS high FROM days),
b AS (SELECT site, date, t28m, {", ".join(_steps_sql('e5_t2m', 'low', 'high', _WARM, j) + f' AS w{j}' for j in range(_WARM))} FROM days, r),
{sweeps_sql([f"w{j}" for j in range(_WARM)], "t28m", "b", _FIXED_RIDGE)}
SELECT site, date, t28m, {" + ".join(f"w{j} * m_{j}_{_WARM}" for j in range(_WARM))} AS pred FROM b, s{_WARM}
""", rounded=["t28m", "pred"])
def smooth_penalised(t: Tables) -> DataFrame:
    """A spline whose bending costs a stated price, fitted from one pass and predicted for every row."""
    data = model_days(t).persist()
    g = smooth.gram(data, smooth.prepare([Spline("e5_t2m", _WARM)], data), "t28m")
    system = smooth._system(g, g.columns(), False)
    # the price in the units of the data, not of the data's own scale
    own = system.turn[1:, 1:].T @ _BENT @ system.turn[1:, 1:]
    scale = system.penalties[0][1:, 1:].trace() / own.trace()
    f = smooth.fit(g, smoothing=100.0 / scale)
    return f.predict(data.select("site", "date", "t28m", "e5_t2m"), "pred").drop("e5_t2m")


@query(f"WITH {_DAYS} SELECT site, avg(t28m) AS pred, count(*) AS n FROM days WHERE t28m > 0 GROUP BY 1", rounded=["pred"])
def gamma_means(t: Tables) -> DataFrame:
    """Gamma regression with log link on the series alone: the expected value of a series is its mean."""
    data = model_days(t).select("site", "t28m").where("t28m > 0").withColumns(
        {"is_a": (F.col("site") == "A").cast("double"), "is_n": (F.col("site") == "N").cast("double")}).persist()
    f = smooth.fit_gamma(data, [Line("is_a"), Line("is_n")], "t28m")
    return f.predict(data, "pred").groupBy("site").agg(F.avg("pred").alias("pred"), F.count(F.lit(1)).alias("n"))


# --- planted effects ----------------------------------------------------------

_PLANTED = ("planted AS (SELECT *, 20 + 3 * sin(month * pi() / 6) + (e5_t2m - 5) ** 2 / 4 + 0.5 * e5_ws * g_p * 10 "
            "+ (hash_ - 0.5) / 10 AS truth FROM (SELECT *, (year * 31 + month * 7 + dayofmonth(date) * 13) % 100 / 100.0::DOUBLE AS hash_ FROM days))")


def _planted(t: Tables) -> DataFrame:
    noise = F.pmod(F.col("year") * 31 + F.col("month") * 7 + F.dayofmonth("date") * 13, F.lit(100)) / 100.0
    truth = (F.lit(20.0) + 3 * F.sin(F.col("month") * 3.141592653589793 / 6) + F.pow(F.col("e5_t2m") - 5, 2) / 4
             + 0.5 * F.col("e5_ws") * F.col("g_p") * 10 + (noise - 0.5) / 10)
    return model_days(t).withColumn("truth", truth)


def _planted_terms() -> list:
    return [Cyclic("month", 12, 8), Spline("e5_t2m", 10), Product((Spline("e5_ws", 6), Spline("g_p", 6))), Surface("e5_ws", "e5_t2m", 10)]


@query(f"""
WITH {_DAYS}, {_PLANTED} SELECT site, count(*) AS n, TRUE AS close, avg(truth) AS truth FROM planted WHERE year >= 1999 GROUP BY 1
""", rounded=["truth"])
def smooth_skill(t: Tables) -> DataFrame:
    """A known effect of season, warmth and wind by rain: years that were not learned are predicted to a tenth of the spread."""
    data = _planted(t).persist()
    old, new = data.where("year < 1999"), data.where("year >= 1999")
    f = smooth.fit(smooth.gram(old, smooth.prepare(_planted_terms(), old), "truth"))
    out = f.predict(new, "pred")
    error = F.sqrt(F.avg(F.pow(F.col("pred") - F.col("truth"), 2)))
    return out.groupBy("site").agg(F.count(F.lit(1)).alias("n"), (error < 0.1 * F.stddev_pop("truth")).alias("close"), F.avg("truth").alias("truth"))


@query("""
SELECT unnest([1, 2, 3]) AS place, unnest(['season, warmth, wind by rain', 'season, warmth', 'season']) AS model, TRUE AS rises
""")
def smooth_board(t: Tables) -> DataFrame:
    """Nested choices of terms from one pass, best first by AIC with effective degrees of freedom."""
    data = _planted(t).persist()
    g = smooth.gram(data, smooth.prepare(_planted_terms()[:3], data), "truth")
    season, warmth, wind = (term.name for term in g.terms)
    board = smooth.ladder(g, {"season": [season], "season, warmth": [season, warmth], "season, warmth, wind by rain": [season, warmth, wind]})
    rows = [(i + 1, name, i == 0 or f.aic > board[i - 1][1].aic) for i, (name, f) in enumerate(board)]
    return t.spark.createDataFrame(rows, "place int, model string, rises boolean")


@query(f"""
WITH {_DAYS}{_GAPPY_DAYS} SELECT site, date, t28m, e5_ws IS NOT NULL AS has_t28m_pred, t28m IS NULL AS gapfill,
  CASE WHEN t28m IS NOT NULL THEN t28m END AS kept FROM gappy
""", rounded=["t28m", "kept"])
def additive_gapfill(t: Tables) -> DataFrame:
    """Gaps filled by an additive model with chosen smoothing; observed values stay."""
    data = _gappy_days(t).persist()
    terms = [Cyclic("month", 12, 6), Spline("e5_t2m", 8), Spline("e5_ws", 6)]
    out = filling.additive_fill(data, "t28m", terms, ["site", "date"])
    return out.select("site", "date", "t28m", F.col("t28m_pred").isNotNull().alias("has_t28m_pred"), "gapfill",
                      F.when(F.col("t28m").isNotNull(), F.col("t28m_gf")).alias("kept"))
