"""Smooth models from cross products, against dense least squares and the library's own GLM."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from gapweave.operators import smooth
from gapweave.operators.smooth import Cyclic, Line, Product, Spline, Surface

N = 3000


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    hour, x, z, noise = rng.integers(0, 24, N), rng.uniform(0, 10, N), rng.normal(0, 1, N), rng.normal(0, 1, N)
    y = 5 + 2 * np.sin(hour * np.pi / 12) + np.sin(x) * 3 + 0.5 * z + 0.3 * rng.normal(0, 1, N)
    rows = [(i, *map(float, r)) for i, r in enumerate(zip(hour, x, z, noise, y))]
    return spark.createDataFrame(rows, "id long, hour double, x double, z double, noise double, y double").repartition(4).persist()


def local(df, *columns):
    return np.array(df.orderBy("id").select(*columns).collect(), float)


def dense(df, terms):
    rows = smooth.with_basis(df, terms).orderBy("id").select(*[f"__b{i}" for i in range(len(terms))]).collect()
    return np.array([[1.0, *(v for block in r for v in block)] for r in rows])


def test_cross_products_and_plain_least_squares(spark, data):
    terms = [Line("x"), Line("z")]
    g = smooth.gram(data, terms, "y")
    x, y = dense(data, terms), local(data, "y")[:, 0]
    assert np.allclose(g.xx, x.T @ x, rtol=1e-12) and np.allclose(g.xy, x.T @ y) and g.n == N
    want, rss, *_ = np.linalg.lstsq(x, y, rcond=None)
    f = smooth.fit(g)
    assert np.allclose([f.intercept, *np.concatenate(f.coefficients)], want, atol=1e-9)
    assert f.rss == pytest.approx(rss[0]) and f.edf == pytest.approx(3)
    glm = GeneralizedLinearRegression(labelCol="y").fit(VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(data))
    assert f.aic == pytest.approx(glm.summary.aic, abs=1e-6)
    only = smooth.fit(g, ["z"])
    assert np.allclose([only.intercept, only.coefficients[0][0]], np.linalg.lstsq(x[:, [0, 2]], y, rcond=None)[0], atol=1e-9)


def test_rows_that_lack_something_take_no_part(spark, data):
    holes = data.withColumn("x", F.when(F.col("id") % 3 != 0, F.col("x"))).withColumn("y", F.when(F.col("id") % 5 != 0, F.col("y")))
    whole = data.where("id % 3 <> 0 AND id % 5 <> 0")
    terms = smooth.prepare([Spline("x"), Line("z")], data)
    a, b = (smooth.fit(smooth.gram(df, terms, "y"), smoothing=1.0) for df in (holes, whole))
    assert a.n == b.n and np.allclose(a.coefficients[0], b.coefficients[0])
    out = a.predict(holes, "pred")
    assert out.count() == N and out.where("(pred IS NULL) <> (x IS NULL)").count() == 0 and out.columns == [*data.columns, "pred"]
    with pytest.raises(ValueError):
        smooth.gram(data.limit(0), terms, "y")
    with pytest.raises(ValueError):
        smooth.prepare([Spline("x")], data.limit(0))


def test_penalised_fit_against_dense_algebra(spark, data):
    terms = smooth.prepare([Spline("x", 9)], data)
    g = smooth.gram(data, terms, "y")
    b, y = dense(data, terms)[:, 1:], local(data, "y")[:, 0]
    s = terms[0].penalties()[0]
    assert np.allclose(b.sum(axis=1), 1) and np.allclose(s @ np.ones(9), 0) and np.allclose(s @ np.arange(9), 0)
    f = smooth.fit(g, smoothing=0.01)
    z = smooth._null_space(b.sum(axis=0))
    scale = np.trace(z.T @ b.T @ b @ z) / np.trace(z.T @ s @ z)
    want = np.linalg.solve(b.T @ b + 0.01 * scale * s, b.T @ y)  # the intercept is in the span of the basis
    assert np.allclose(f.intercept + f.coefficients[0], want, atol=1e-6)
    hat = np.trace(np.linalg.solve(b.T @ b + 0.01 * scale * s, b.T @ b))
    assert f.edf == pytest.approx(hat, abs=1e-6)
    straight = smooth.fit(g, smoothing=1e9)
    assert straight.edf == pytest.approx(2, abs=1e-3)


def test_chosen_smoothing_is_no_worse_than_any_fixed_one(spark, data):
    terms = smooth.prepare([Cyclic("hour", 24), Spline("x", 15), Line("z")], data)
    train, test = data.where("id % 2 = 0"), data.where("id % 2 = 1")
    g = smooth.gram(train, terms, "y")
    y = local(test, "y")[:, 0]

    def error(f):
        return float(np.sqrt(np.mean((local(f.predict(test, "p"), "p")[:, 0] - y) ** 2)))

    chosen = smooth.fit(g)
    fixed = [smooth.fit(g, smoothing=10.0**p) for p in (-6, -4, -2, 0, 2, 4)]
    assert all(chosen.gcv <= f.gcv + 1e-9 for f in fixed)
    assert error(chosen) <= 1.01 * min(map(error, fixed)) and error(chosen) < 0.32 < 0.5 * error(fixed[-1])


def test_cyclic_effect_closes(spark, data):
    terms = [Cyclic("hour", 24, 8)]
    f = smooth.fit(smooth.gram(data, terms, "y"), smoothing=0.0)
    ends = spark.createDataFrame([(i, h) for i, h in enumerate((0.0, 24.0, 1e-4, 24 - 1e-4, -24.0))], "id int, hour double")
    p = local(f.predict(ends, "p"), "p")[:, 0]
    assert p[0] == pytest.approx(p[1], abs=1e-12) and p[0] == pytest.approx(p[4], abs=1e-12)
    assert (p[2] - p[0]) == pytest.approx(p[1] - p[3], abs=1e-6)
    s = terms[0].penalties()[0]
    assert np.allclose(s @ np.ones(8), 0) and np.linalg.matrix_rank(s) == 7


def test_surface_turns_with_its_axes(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, 800), rng.normal(0, 2, 800)
    y = np.sin(a) * b + 0.1 * rng.normal(0, 1, 800)
    turned = [a * np.cos(0.7) - b * np.sin(0.7), a * np.sin(0.7) + b * np.cos(0.7)]
    out = []
    for p, q in ((a, b), turned):
        df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(zip(p, q, y))], "id long, p double, q double, y double")
        f = smooth.fit(smooth.gram(df, smooth.prepare([Surface("p", "q", 20)], df), "y"))
        out.append(local(f.predict(df, "pred"), "pred")[:, 0])
    assert np.abs(out[0] - out[1]).max() < 1e-6
    assert np.sqrt(np.mean((out[0] - y) ** 2)) < 0.3 * y.std()


def test_products_and_nested_models_from_one_pass(spark, data):
    df = data.withColumn("y", F.col("x") * F.col("z") + F.col("y") / 100)
    terms = smooth.prepare([Spline("x", 6), Spline("z", 6), Product((Spline("x", 5), Spline("z", 5)))], df)
    g = smooth.gram(df, terms, "y")
    board = smooth.ladder(g, {"x": ["s(x)"], "both": ["s(x)", "s(z)"], "product": ["te(x,z)"]})
    assert [name for name, _ in board] == ["product", "both", "x"]
    best = board[0][1]
    p = best.predict(df, "p").agg(F.sqrt(F.avg(F.pow(F.col("p") - F.col("y"), 2)))).first()[0]
    assert p == pytest.approx(np.sqrt(best.rss / best.n), rel=1e-4) and p < 0.1


def test_terms_shrink_to_nothing(spark, data):
    terms = smooth.prepare([Cyclic("hour", 24), Spline("x", 12), Line("z"), Spline("noise")], data)
    f = smooth.fit(smooth.gram(data, terms, "y"), drop=True)
    spread = {n: f.effect(data, n, "e").agg(F.stddev("e")).first()[0] for n in ("cc(hour)", "s(x)", "z", "s(noise)")}
    assert spread["s(noise)"] < 1e-3 and min(spread["cc(hour)"], spread["s(x)"], spread["z"]) > 0.3


def test_cells_fit_close_to_rows(spark, data):
    terms = smooth.prepare([Cyclic("hour", 24), Spline("x", 10)], data)
    exact, g = smooth.gram(data, terms, "y"), smooth.binned_gram(data, terms, "y", {"x": 200})
    assert g.n == exact.n and g.yy == pytest.approx(exact.yy)
    a, b = (local(smooth.fit(m, smoothing=0.01).predict(data, "p"), "p")[:, 0] for m in (exact, g))
    assert np.abs(a - b).max() < 0.05  # half a step is 0.025, slopes reach 3 and average out
    cells = smooth.binned_gram(data.unionByName(data).unionByName(data), terms, "y", {"x": 200})
    assert cells.n == 3 * g.n and np.allclose(cells.xx, 3 * g.xx)


def test_gamma_against_the_librarys_glm(spark, data):
    df = data.withColumn("y", F.exp(0.3 * F.col("z") + 0.05 * F.col("x")) * (0.5 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000))
    f = smooth.fit_gamma(df, [Line("x"), Line("z")], "y")
    rows = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df)
    glm = GeneralizedLinearRegression(labelCol="y", family="gamma", link="log", maxIter=100, tol=1e-12).fit(rows)
    assert [f.intercept, *np.concatenate(f.coefficients)] == pytest.approx([glm.intercept, *glm.coefficients], abs=1e-6)
    assert f.deviance == pytest.approx(glm.summary.deviance, rel=1e-8)
    smoothed = smooth.fit_gamma(df, smooth.prepare([Spline("x"), Spline("z")], df), "y")
    assert smoothed.deviance < 1.01 * f.deviance and smoothed.edf < 8
    assert smoothed.predict(df, "p").where("p <= 0 OR p IS NULL").count() == 0
