"""Operators against brute force on small frames."""

import datetime as dt
import random
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gapweave.operators import aggregate, blocks, checks, clean, combine, gapfill, quantiles, reshape, rolling, sampling
from gapweave.operators import grid as grids

attach_module = sys.modules["gapweave.operators.attach"]
T0 = dt.datetime(2020, 1, 1)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def series(spark, n=300, hot=0.7, seed=1, gaps=0.1):
    """Two series, one of them hot, bursts of equal times, nulls in the values."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        site = "hot" if rnd.random() < hot else rnd.choice(["cold", None])
        time = T0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(86_400 * 4), 3_600 * 30]))
        data.append((site, time, i, None if rnd.random() < gaps else round(rnd.gauss(5, 3), 3)))
    return spark.createDataFrame(data, "site string, time timestamp_ntz, id int, x double").repartition(5)


def sorted_pandas(df):
    return df.toPandas().sort_values(["time", "id"]).reset_index(drop=True)


# --- attach -----------------------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("heavy_rows", [0, 5, 40, 10_000])
def test_split_attach_is_a_null_safe_join(spark, how, heavy_rows):
    rows = series(spark).withColumn("k", F.when(F.col("id") % 7 != 3, F.col("id") % 7))
    groups = rows.groupBy("site", "k").agg(F.avg("x").alias("m"), F.count("*").alias("n"))
    groups = groups.where("k IS NULL OR k <> 2")
    got = attach_module.attach_split(rows, groups, ["site", "k"], "n", heavy_rows=heavy_rows, how=how)
    want = attach_module.attach(rows, groups, ["site", "k"], how=how, weight="n")
    assert got.columns == want.columns == ["site", "time", "id", "x", "k", "m"]
    assert rows_of(got, "site", "id", "k", "m") == rows_of(want, "site", "id", "k", "m")
    assert got.count() == (rows.count() if how == "left" else rows.where("k IS NULL OR k <> 2").count())


def test_large_group_tables_take_the_split_way(spark, monkeypatch):
    rows = series(spark)
    want = rows_of(clean.flag_outliers(rows, ["site"], "x"), "id", "bad")
    monkeypatch.setattr(attach_module, "BROADCAST_ROWS", 1)
    out = clean.flag_outliers(rows, ["site"], "x")
    assert "__heavy" in out._jdf.queryExecution().analyzed().toString()
    assert rows_of(out, "id", "bad") == want


def test_lookup_beyond_the_broadcast_limit(spark, monkeypatch):
    rows = series(spark).withColumn("k", F.col("id") % 5)
    entries = spark.createDataFrame([("hot", 1, "a"), ("hot", 2, "b"), (None, 3, "c"), ("none", 4, "d")], "site string, k int, e string")
    want = rows_of(attach_module.look_up(rows, entries, ["site", "k"]), "id", "e")
    monkeypatch.setattr(attach_module, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(attach_module, "HEAVY_SHARE", 0.1)
    assert rows_of(attach_module.look_up(rows, entries, ["site", "k"]), "id", "e") == want
    hit = combine.keep_members(rows, entries, ["site", "k"])
    miss = combine.keep_members(rows, entries, ["site", "k"], inside=False)
    assert hit.count() == sum(e is not None for _, e in want) and hit.count() + miss.count() == len(want) == 300


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "month int, x double")
    for short in (True, False):
        got = clean.with_group_stats(df, ["month"], "x", short_groups=short)
        assert rows_of(got, "month", "x", "u_x") == sorted([(None, 1.0, 2.0), (None, 3.0, 2.0), (1, 5.0, 5.0)], key=str)


def test_both_ways_of_group_statistics_agree(spark):
    df = series(spark).withColumn("hour", F.hour("time"))
    for f in (clean.flag_outliers, clean.anomaly):
        a, b = (f(df, ["site", "hour"], "x", short_groups=s) for s in (True, False))
        cols = [c for c in a.columns if c not in ("time",)]
        key = [c for c in cols if dict(a.dtypes)[c] != "double"]
        assert rows_of(a, *key) == rows_of(b, *key)
        for c in set(cols) - set(key):
            left = {r["id"]: r[c] for r in a.collect()}
            for r in b.collect():
                assert (left[r["id"]] is None) == (r[c] is None)
                assert r[c] is None or left[r["id"]] == pytest.approx(r[c], abs=1e-9)


# --- order-dependent operators ----------------------------------------------


@pytest.mark.parametrize("seconds", [None, 86_400, 3_600, 60])
def test_row_index_and_running_sum(spark, seconds):
    df = series(spark)
    idx = {r["id"]: r["idx"] for r in blocks.row_index(df, ["site"], "time", ["id"], block_seconds=seconds).collect()}
    run = {r["id"]: r["running"] for r in blocks.running_sum(df, ["site"], "time", "x", ["id"], block_seconds=seconds).collect()}
    p = sorted_pandas(df)
    for _, g in p.groupby("site", dropna=False):
        total, seen = 0.0, False
        for place, r in enumerate(g.itertuples(), 1):
            assert idx[r.id] == place
            if not np.isnan(r.x):
                total, seen = total + r.x, True
            assert run[r.id] == (pytest.approx(total, abs=1e-9) if seen else None)


@pytest.mark.parametrize("seconds", [None, 3_600, 60])
def test_previous_value_and_step(spark, seconds):
    out = blocks.previous(series(spark), ["site"], "time", ["x"], ["id"], difference={"x": "step"}, block_seconds=seconds)
    got = {r["id"]: (r["x_l1"], r["step"]) for r in out.collect()}
    for _, g in sorted_pandas(series(spark)).groupby("site", dropna=False):
        before, first = None, True
        for r in g.itertuples():
            x = None if np.isnan(r.x) else r.x
            lag, step = got[r.id]
            assert lag == (None if first else before)
            want = 0.0 if first else (None if x is None or before is None else x - before)
            assert step == (want if want is None else pytest.approx(want))
            before, first = x, False


def test_missing_times_come_last(spark):
    df = spark.createDataFrame([("a", None, 1, 1.0), ("a", T0, 2, 2.0), ("a", T0 + dt.timedelta(days=3), 3, 3.0)],
                               "site string, time timestamp_ntz, id int, x double")
    got = {r["id"]: r["idx"] for r in blocks.row_index(df, ["site"], "time", ["id"]).collect()}
    assert got == {2: 1, 3: 2, 1: 3}


def test_series_too_long_for_a_task_are_cut(spark, monkeypatch):
    df = series(spark)
    whole = blocks.previous(df, ["site"], "time", ["x"], ["id"])
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 20)
    cut = blocks.previous(df, ["site"], "time", ["x"], ["id"])
    assert "__block" in cut._jdf.queryExecution().analyzed().toString()
    assert "__block" not in whole._jdf.queryExecution().analyzed().toString()
    assert rows_of(cut, "id", "x_l1") == rows_of(whole, "id", "x_l1")


@pytest.mark.parametrize("chunk_rows", [12, 17, 50, 1_000])
def test_chunked_frames_equal_one_window(spark, chunk_rows):
    frames = {"s3": ("x", "sum", 3), "m12": ("x", "max", 12), "a5": ("x", "avg", 5)}
    df = series(spark, gaps=0.03)
    got = blocks.roll(df, ["site"], "time", frames, ["id"], chunk_rows=chunk_rows, block_seconds=3_600)
    want = rolling.roll_series(df.withColumn("t", F.struct("time", "id")), ["site"], "t", frames)
    assert got.count() == df.count()
    left = {r["id"]: r for r in got.collect()}
    for r in want.collect():
        for c in frames:
            assert left[r["id"]][c] == (None if r[c] is None else pytest.approx(r[c]))


def crowded(spark):
    """One instant with ten blocks of rows, a burst of an hour, many rows without a time, a long thin series."""
    rows = [("full", T0, i, float(i % 7)) for i in range(200)]
    rows += [("burst", T0 + dt.timedelta(days=d), d, 1.0 + d) for d in range(40)]
    rows += [("burst", T0 + dt.timedelta(days=20, seconds=s), 100 + s, 0.5 * s) for s in range(150)]
    rows += [("none", None, i, 1.0) for i in range(100)] + [("none", T0, 500, 2.0)]
    rows += [(None, T0 + dt.timedelta(hours=i), i, 3.0) for i in range(60)]
    df = spark.createDataFrame(rows, "site string, time timestamp_ntz, id int, x double")
    return df.withColumn("uid", F.concat_ws("/", "site", "id"))


def test_full_instants_bursts_and_missing_times_are_cut(spark, monkeypatch):
    df = crowded(spark)
    whole = [rows_of(blocks.row_index(df, ["site"], "time", ["id"]), "uid", "idx"),
             rows_of(blocks.previous(df, ["site"], "time", ["x"], ["id"]), "uid", "x_l1"),
             rows_of(blocks.running_sum(df, ["site"], "time", "x", ["id"]), "uid", "running")]
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 20)
    cut = [rows_of(blocks.row_index(df, ["site"], "time", ["id"]), "uid", "idx"),
           rows_of(blocks.previous(df, ["site"], "time", ["x"], ["id"]), "uid", "x_l1"),
           rows_of(blocks.running_sum(df, ["site"], "time", "x", ["id"]), "uid", "running")]
    assert cut == whole
    needed = blocks._blocks_needed(df, ["site"])
    held = blocks._blocked(df, ["site"], "time", ["id"], None, needed).groupBy("site", "__block").count()
    assert held.agg(F.max("count")).first()[0] <= 3 * 20


def test_guard_needs_full_frames_without_gaps(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([0.0, 1.0, 2.0, None, 4.0])], "site string, t int, x double")
    got = rolling.roll_series(df, ["site"], "t", {"s": ("x", "sum", 3)}).orderBy("t").collect()
    assert [r["s"] for r in got] == [None, None, 3.0, None, None]


def test_fill_hours_adds_missing_hours(spark):
    df = spark.createDataFrame([("a", T0, 1.0), ("a", T0 + dt.timedelta(hours=3), 2.0)], "site string, time timestamp_ntz, x double")
    got = rolling.fill_hours(df, ["site"], "time").orderBy("time").collect()
    assert [(r["time"].hour, r["x"]) for r in got] == [(0, 1.0), (1, None), (2, None), (3, 2.0)]


def test_extremes_names(spark):
    df = series(spark)
    assert rolling.extremes(df, ["site"], "time", ["x"], 3).columns[-3:] == ["x_max_3h", "x_mean_3h", "x_min_3h"]


# --- samples ----------------------------------------------------------------


@pytest.mark.parametrize("sort_rows", [0, 20, 100_000])
@pytest.mark.parametrize("n", [0, 1, 137, 299, 300, 1_000])
def test_exactly_n_rows(spark, monkeypatch, n, sort_rows):
    monkeypatch.setattr(sampling, "_SORT_ROWS", sort_rows)
    df = series(spark)
    got = sampling.take_exactly(df, n, ["id"], seed=9)
    want = df.withColumn("d", sampling.draw(["id"], 9)).orderBy("d").limit(n)
    assert rows_of(got, "id") == rows_of(want, "id")
    assert got.count() == min(n, 300)


def test_samples_do_not_depend_on_partitioning(spark):
    df = series(spark)
    a, b = sampling.take_fraction(df, 0.4, ["id"], 3), sampling.take_fraction(df.repartition(13), 0.4, ["id"], 3)
    assert rows_of(a, "id") == rows_of(b, "id")
    assert 80 < a.count() < 160


def test_equal_keys_share_their_fate(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_SORT_ROWS", 10)
    df = spark.range(200).select(F.lit(7).alias("k"))
    assert sampling.take_exactly(df, 50, ["k"], 1).count() == 200


def test_block_split_keeps_rows_without_a_time(spark):
    df = spark.createDataFrame([(1, None), (2, T0), (3, T0)], "id int, time timestamp_ntz")
    assert sampling.block_split(df, "time", ["id"], 3, train_share=1.0).where("part <> 'train'").count() == 1


def test_block_split_keeps_months_whole(spark):
    df = spark.range(3_000).select("id", F.expr("timestamp_ntz'2001-01-15 00:00:00' + make_interval(0, cast(id % 40 as int))").alias("time"))
    out = sampling.block_split(df, "time", ["id"], seed=3).toPandas()
    assert len(out) == 3_000 and out["id"].is_unique
    per_month = out.groupby("ym")["part"].agg(lambda p: "train" in set(p))
    assert per_month.sum() == 36
    assert all(set(g["part"]) == {"train"} for ym, g in out.groupby("ym") if per_month[ym])
    held = out[out["part"] != "train"]["part"].value_counts()
    assert held["test"] == 150 and held["valid"] == 150
    again = sampling.block_split(df.repartition(7), "time", ["id"], seed=3).toPandas()
    assert dict(zip(out["id"], out["part"])) == dict(zip(again["id"], again["part"]))


# --- ranks and quantiles ----------------------------------------------------


@pytest.mark.parametrize("n_blocks", [2, 8, 64])
@pytest.mark.parametrize("bound", [None, 10])
def test_ranks(spark, n_blocks, bound):
    df = series(spark).withColumn("x", F.round("x"))
    got = {(r["site"], r["x"]): r for r in quantiles.value_ranks(df, ["site"], "x", n_blocks, bound).collect()}
    p = df.toPandas().dropna(subset=["x"])
    seen = 0
    for site, g in p.groupby("site", dropna=False):
        site = None if not isinstance(site, str) else site
        for x, n in g["x"].value_counts().items():
            r = got[(site, x)]
            assert (r["n"], r["below"], r["upto"], r["total"]) == (n, (g["x"] < x).sum(), (g["x"] <= x).sum(), len(g))
            seen += 1
    assert seen == len(got)


@pytest.mark.parametrize("group_rows", [0, 1_000_000])
@pytest.mark.parametrize("rounded", [True, False])
def test_quantiles_match_linear_interpolation(spark, rounded, group_rows, monkeypatch):
    monkeypatch.setattr(quantiles, "GROUP_ROWS", group_rows)
    df = series(spark)
    df = df.withColumn("x", F.round("x")) if rounded else df
    nodes = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0]
    got = {r["site"]: r["q"] for r in quantiles.quantiles(df, ["site"], {"q": "x"}, nodes).collect()}
    for site, g in df.toPandas().dropna(subset=["x"]).groupby("site", dropna=False):
        want = np.quantile(g["x"], nodes)
        assert got[site if isinstance(site, str) else None] == pytest.approx(list(want))


def test_only_blocks_with_a_wanted_rank_are_ranked(spark):
    df = spark.range(1_000).select(F.lit("a").alias("site"), (F.col("id") * 7 % 1_000).cast("double").alias("x"))
    some = {r["x"]: r["below"] for r in quantiles.value_ranks(df, ["site"], "x", blocks=50, wanted=[0.5]).collect()}
    assert len(some) <= 60 and {499.0, 500.0} <= set(some) and all(x == below for x, below in some.items())


@pytest.mark.parametrize("group_rows", [0, 1_000_000])
def test_quantiles_of_one_value(spark, group_rows, monkeypatch):
    monkeypatch.setattr(quantiles, "GROUP_ROWS", group_rows)
    df = spark.createDataFrame([("a", 2.0), ("b", None)], "g string, x double")
    got = {r["g"]: r["q"] for r in quantiles.quantiles(df, ["g"], {"q": "x"}, [0.0, 0.5, 1.0]).collect()}
    assert got == {"a": [2.0, 2.0, 2.0], "b": None}


@pytest.mark.parametrize("group_rows", [0, 1_000_000])
def test_cumulative_share(spark, group_rows, monkeypatch):
    monkeypatch.setattr(quantiles, "GROUP_ROWS", group_rows)
    df = series(spark).withColumn("x", F.round("x"))
    got = {r["id"]: r["tau"] for r in quantiles.cumulative_share(df, ["site"], "x").collect()}
    for _, g in df.toPandas().groupby("site", dropna=False):
        held = g["x"].dropna()
        for r in g.itertuples():
            assert got[r.id] == (None if np.isnan(r.x) else pytest.approx((held <= r.x).mean()))


@pytest.mark.parametrize("group_rows", [0, 1_000_000])
def test_quantile_mapping_against_numpy(spark, group_rows, monkeypatch):
    monkeypatch.setattr(quantiles, "GROUP_ROWS", group_rows)
    rnd = np.random.default_rng(5)
    n = 400
    p = pd.DataFrame({"id": range(n), "hour": rnd.integers(0, 3, n), "ws": rnd.gamma(2, 2, n)})
    p["vv"] = np.where(rnd.random(n) < 0.6, p["ws"] * 0.5 + rnd.gamma(1, 1, n), np.nan)
    p.loc[0, "ws"] = 99.0  # outside the calibration range
    p.loc[0, "vv"] = np.nan
    df = spark.createDataFrame(p).withColumn("vv", F.when(~F.isnan("vv"), F.col("vv")))
    out = gapfill.quantile_map(df, df.where("vv IS NOT NULL"), ["hour"], "ws", "vv", "bc")
    got = {r["id"]: r["bc"] for r in out.collect()}
    for _, g in p.groupby("hour"):
        cal = g.dropna(subset=["vv"])
        for r in g.itertuples():
            tau = (g["ws"] < r.ws).sum() / (len(g) - 1)
            assert got[r.id] == pytest.approx(r.ws + np.quantile(cal["vv"], tau) - np.quantile(cal["ws"], tau))
    assert len(got) == n


@pytest.mark.parametrize("group_rows", [0, 100, 1_000_000])
def test_quantile_mapping_of_ties(spark, group_rows, monkeypatch):
    """Half of the rows share a value; it stays one run a block."""
    monkeypatch.setattr(quantiles, "GROUP_ROWS", group_rows)
    rnd = np.random.default_rng(6)
    n = 600
    ws = np.where(rnd.random(n) < 0.5, 0.0, np.round(rnd.gamma(2, 2, n), 1))
    vv = np.where(rnd.random(n) < 0.7, np.where(rnd.random(n) < 0.5, 0.5, np.round(rnd.gamma(2, 1, n), 1)), np.nan)
    p = pd.DataFrame({"id": range(n), "hour": np.where(np.arange(n) % 3 == 0, 1.0, np.where(np.arange(n) % 3 == 1, 2.0, np.nan)), "ws": ws, "vv": vv})
    p.loc[p["hour"] == 2.0, "vv"] = np.nan  # no calibration rows
    df = spark.createDataFrame(p)
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("hour", "vv")})
    got = {r["id"]: r["bc"] for r in gapfill.quantile_map(df, df.where("vv IS NOT NULL"), ["hour"], "ws", "vv", "bc").collect()}
    for hour, g in p.groupby("hour", dropna=False):
        cal = g.dropna(subset=["vv"])
        for r in g.itertuples():
            tau = (g["ws"] < r.ws).sum() / (len(g) - 1)
            want = None if hour == 2.0 else pytest.approx(r.ws + np.quantile(cal["vv"], tau) - np.quantile(cal["ws"], tau))
            assert got[r.id] == want
    assert len(got) == n
    ranks = quantiles.value_ranks(df, ["hour"], "ws")
    assert gapfill._runs(ranks, ["hour"], "ws", "v", 4).count() <= ranks.count() + 3 * 4


# --- the rest ---------------------------------------------------------------


def test_half_even_bins(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r[0] for r in df.select(aggregate.coarse(F.col("x"), 1)).collect()] == [0.0, 2.0, 2.0]


def test_set_difference_and_anti_join(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, 3), (2, 3)], "a int, b int")
    b = spark.createDataFrame([(1, None)], "a int, b int")
    assert rows_of(combine.set_difference(a, b), "a", "b") == [(2, 3)]
    assert rows_of(combine.rows_not_in(a, b), "a", "b") == [(2, 3), (2, 3)]


def test_gap_flag(spark):
    df = spark.createDataFrame([(None, 5.0), (1.0, 5.0), (None, None)], "obs double, pred double")
    got = rows_of(gapfill.fill(df, "obs", "pred", "gf"), "gf", "gapfill")
    assert got == sorted([(5.0, True), (1.0, False), (None, True)], key=str)


def test_rain_rules(spark):
    h = dt.timedelta(minutes=30)
    df = spark.createDataFrame([
        ("s", T0, 2.0, 1.0), ("s", T0 + h, None, 3.0),  # both gauge halves there
        ("s", T0 + 2 * h, 4.0, None), ("s", T0 + 3 * h, 2.0, 1.0)],  # one missing
        "site string, t timestamp_ntz, sat double, gauge double")
    got = rows_of(gapfill.fill_rain(df, ["site"], "t", "gauge", "sat"), "p_gpm", "p_mm_obs", "p_mm_gf")
    assert got == sorted([(1.0, 4.0, 4.0), (3.0, None, 3.0)], key=str)


def test_period_mask_and_unknown_dates(spark):
    df = spark.createDataFrame([(2011, 4, 1.0), (2011, 7, 2.0), (2012, 6, 3.0), (2017, 12, 4.0), (2018, 3, 5.0),
                                (None, None, 6.0), (None, 1, 7.0), (None, 5, 8.0), (2010, None, 9.0), (2012, None, 10.0)],
                               "year int, month int, rh28m double")
    assert [r["rh28m"] for r in clean.mask_periods(df, "rh28m").collect()] == [
        None, 2.0, None, None, 5.0, None, 7.0, None, 9.0, None]


def test_single_value_group_is_good(spark):
    df = spark.createDataFrame([(1, 9.0), (2, None)], "g int, x double")
    assert rows_of(clean.flag_outliers(df, ["g"], "x"), "bad") == [("good",), ("good",)]


def test_hourly_rules(spark):
    df = spark.createDataFrame([("s", T0 + dt.timedelta(minutes=m), float(m)) for m in (0, 10, 20, 40, 50)],
                               "site string, t timestamp_ntz, x double")

    def hours(rule):
        return {r["t"].hour: r["x"] for r in aggregate.hourly_mean(df, ["site"], "t", rule=rule).collect()}

    assert hours("nearest") == {0: 10.0, 1: 45.0}
    assert hours("on_hour") == {0: 5.0, 1: 50.0}
    assert hours("clock") == {0: 24.0}


def test_member_flag_needs_an_observation(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 1.0)], "k int, x double")
    got = rows_of(combine.member_flag(df, df.where("k < 3"), ["k"], also="x"), "k", "in_train")
    assert got == [(1, True), (2, False), (3, False)]


def test_natural_join_needs_common_names(spark):
    a, b = spark.range(1), spark.range(1).withColumnRenamed("id", "other")
    with pytest.raises(ValueError):
        combine.natural_join(a, b)


def test_decoded_names(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "t int, obs_t28m_max_72h double, pred_t28m_mean_72h double")
    got = rows_of(reshape.decoded_long(df, ["t"]), "stat", "origin", "value")
    assert got == [("max", "observation", 2.0), ("mean", "prediction", 3.0)]


def test_checks(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (2.0,)], "t double")
    with pytest.raises(checks.DataCheckError, match="warm"):
        checks.require(df, {"warm": checks.warm("t")})
    assert checks.require(df.where("t IS NULL OR t > 0"), {"warm": checks.warm("t")}).count() == 2
    with pytest.raises(checks.DataCheckError):
        checks.require_some_finite(spark.createDataFrame([(float("inf"),), (None,)], "t double"), "t")
    checks.require_some_finite(df, "t")


def test_cell_filter_reaches_the_scan(spark, tmp_path):
    from gapweave.sources import readers, writers

    data = [("SSRD", 308.5, -1.75, 1036800, 1.0), ("SSRD", 308.75, -1.75, 1036800, 2.0), ("STRD", 308.5, -1.75, 1036801, 3.0)]
    df = spark.createDataFrame(data, "variable string, lon double, lat double, time_hours int, value double")
    writers.write_grid(df, str(tmp_path / "g"))
    cell = grids.select_cell(readers.read_grid(spark, str(tmp_path / "g"), F.col("variable") == "SSRD"))
    got = cell.collect()
    assert [(r["lon"], r["time_local"]) for r in got] == [(-51.5, dt.datetime(1900, 1, 1) + dt.timedelta(hours=1036800 - 3))]
    plan = cell._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(lon,308.4)" in plan and "PartitionFilters: [isnotnull(variable" in plan


def test_daily_values_meet_hours_of_a_null_site(spark):
    hours = spark.createDataFrame([(None, 1, 5.0), ("a", 1, 6.0), ("b", 2, 7.0)], "site string, day int, x double")
    days = spark.createDataFrame([(None, 1, 0.5), ("a", 1, 0.6)], "site string, day int, rain double")
    got = combine.daily_onto_hourly(hours, days, ["site", "day"])
    assert got.columns == ["site", "day", "x", "rain"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(None, 1, 5.0, 0.5), ("a", 1, 6.0, 0.6)], key=str)
