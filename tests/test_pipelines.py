"""Files in, products out: readers, plans, writers on small hand-made files."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gapweave.operators import models
from gapweave.plans import daily, filling, frame, hourly, jobs, merged, station
from gapweave.sources import layouts, readers, writers

T0 = dt.datetime(2017, 3, 1)


def put(folder, name, header, rows):
    folder.mkdir(exist_ok=True)
    lines = [",".join(header)] + [",".join("" if v is None else str(v) for v in r) for r in rows]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder / name)


# --- station logs -----------------------------------------------------------


def test_oldest_log(spark, tmp_path):
    path = put(tmp_path, "a.csv", list(layouts.LOG_2001), [["2011-04-05 07:30:00", 25.5, 90, 100, 0.4], ["", "x", "NaN", 1, None]])
    got = readers.read_station_log(spark, path, "2001").orderBy(F.col("date").asc_nulls_last()).collect()
    assert (got[0]["date"], got[0]["t28m"], got[0]["precip"], got[0]["month"]) == (dt.datetime(2011, 4, 5, 7, 30), 25.5, 0.8, 4)
    assert (got[1]["date"], got[1]["t28m"], got[1]["rh28m"], got[1]["precip"]) == (None, None, None, None)


@pytest.mark.parametrize("kind", ["2016", "2017", "2018", "2019", "2021"])
def test_yearly_logs_by_header_name(spark, tmp_path, kind):
    names = layouts.LOGS[kind].names
    header = list(reversed(names))  # the order of columns does not matter
    values = {old: i + 0.5 for i, old in enumerate(names)}
    good = {**values, "Dia": 30, "Mês": 11, "Ano": 18, "Hora": "7:30"}
    bad = {**good, "Mês": 2, "Ano": 2018, "Hora": "07:30:05"}
    path = put(tmp_path, f"{kind}.csv", header, [[r[h] for h in header] for r in (good, bad)])
    got = readers.read_station_log(spark, path, kind).orderBy(F.col("date").asc_nulls_last()).collect()
    assert [r["date"] for r in got] == [dt.datetime(2018, 11, 30, 7, 30), None]
    factors = layouts.LOGS[kind].factors
    for old, new in names.items():
        if old not in layouts.CALENDAR:
            assert got[0][new] == pytest.approx(values[old] * factors.get(new, 1.0))
    assert got[0]["t2m"] != got[0]["t28m"]  # the 2 m sensor has its own column


def test_harmonised_record_and_outliers(spark, tmp_path):
    rows = [[(dt.datetime(2011, m, 1) + dt.timedelta(days=d, hours=7)).isoformat(" "), 25 + (d % 3), 90, 100, 0.1]
            for m in (4, 8) for d in range(25)]
    rows.append(["2011-08-26 07:00:00", 90, 91, 100, 0.1])
    a = readers.read_station_log(spark, put(tmp_path, "a.csv", list(layouts.LOG_2001), rows), "2001")
    names = list(layouts.LOG_2019)
    b = readers.read_station_log(spark, put(tmp_path, "b.csv", names, [[1, 5, 19, "10:00"] + [20.0] * (len(names) - 4)]), "2019")
    record = station.harmonise([a, b], "south")
    assert record.columns == ["site", "date", "year", "month", "day", "hour", *layouts.STATION_COLUMNS]
    assert record.where("year = 2019").select("vv", "t16m").first() == (None, 20.0)
    out = station.remove_outliers(record)
    assert out.count() == 52
    bad = out.where("bad = 'bad'").collect()
    assert [(r["date"], r["t28m"]) for r in bad] == [(dt.datetime(2011, 8, 26, 7), None)]
    assert out.where("month = 4 AND rh28m IS NOT NULL").count() == 0
    assert out.where("month = 8 AND rh28m IS NULL").count() == 0


def test_recent_log_steps_before_hours(spark, tmp_path):
    names = list(layouts.LOG_2021)
    t = names.index("Tar_28m (°C)")

    def row(day, clock, temp):
        r = [day, 2, 21, clock] + [1.0] * (len(names) - 4)
        r[t] = temp
        return r

    path = put(tmp_path, "c.csv", names, [row(1, "7:00", 20.0), row(1, "7:20", 22.0), row(1, "07:40:00", 25.0), row(30, "8:00", 1.0)])
    got = station.hourly_recent(readers.read_station_log(spark, path, "2021"), "south").orderBy("date").collect()
    assert [(r["date"].hour, r["t28m"], r["t_l1"], r["delta_t28"]) for r in got] == [(7, 21.0, 20.0, 1.0), (8, 25.0, 22.0, 3.0)]
    assert (got[0]["year"], got[0]["hour"]) == (2021, 7)


# --- covariates and model frame ---------------------------------------------

HOURS = 24 * 8


@pytest.fixture()
def inputs(spark, tmp_path):
    """Two reanalysis files and one to ignore, rain with one missing half hour, daily rain, an hourly station."""
    header = ["system:index", "site", "date", "temperature_2m", "dewpoint_temperature_2m", "surface_pressure",
              "surface_solar_radiation_downwards", "surface_thermal_radiation_downwards", "total_evaporation_hourly",
              "u_component_of_wind_10m", "v_component_of_wind_10m", "total_precipitation", ".geo"]
    rows = []
    for h in range(HOURS):
        t = T0 + dt.timedelta(hours=h)
        for site in ("south", "north"):
            rows.append([h, site, t.isoformat(" "), 298.15 + h % 24, 293.15, 100000, 1, 1, 0, 3, 4, 0.001 * (h % 5), "g"])
    folder = tmp_path / "e5"
    put(folder, "ERA5-Land-hourly___1.csv", header, rows[: len(rows) // 2])
    put(folder, "ERA5-Land-hourly___2.csv", header, rows[len(rows) // 2:])
    put(folder, "other.csv", header, rows[:5])
    rain = [[(T0 + dt.timedelta(minutes=30 * i)).isoformat(" "), None if i == 100 else 1.0 + i % 2, "south"] for i in range(2 * HOURS)]
    gpm = put(tmp_path, "gpm.csv", ["date", "precipitationCal", "site"], rain)
    daily_rain = put(tmp_path, "chirps.csv", ["date", "precipitation", "site"],
                     [[(T0 + dt.timedelta(days=d)).date(), d + 1.0, "south"] for d in range(8)])
    record = spark.createDataFrame(
        [("south", T0 + dt.timedelta(hours=h - 3), 2017, 3, 1, 0, 20.0 + h % 24, 80.0) for h in range(HOURS) if h % 11],
        "site string, date timestamp_ntz, year int, month int, day int, hour int, t28m double, rh28m double")
    return (readers.read_reanalysis(spark, str(folder), site="south"), readers.read_satellite_rain(spark, gpm, "south"),
            readers.read_daily_rain(spark, daily_rain, "south"), record)


def test_model_frame(spark, inputs):
    e5, gpm, rain, record = inputs
    assert e5.count() == HOURS
    dat = frame.model_frame(frame.covariates(e5, gpm, rain), record)
    assert dat.count() == HOURS
    by_hour = {int((r["time_utc"] - T0).total_seconds() // 3600): r for r in dat.collect()}
    r = by_hour[30]
    assert (r["e5_t2m"], r["e5_ws"], r["g_p"]) == (pytest.approx(31.0), 5.0, 1.5)
    assert r["e5_tot_p24h_max"] == pytest.approx(4.0)
    assert r["e5_tot_p24h_sum"] == pytest.approx(sum(h % 5 for h in range(7, 31)))
    assert r["time_local"] == T0 + dt.timedelta(hours=27) and r["date"] == dt.date(2017, 3, 2) and r["hour"] == 3
    assert (r["c_p24h"], r["c_p48h"], r["c_p120h"]) == (2.0, 3.0, None)
    assert by_hour[50]["g_p"] is None and by_hour[51]["g_p3h_sum"] is None and by_hour[53]["g_p3h_sum"] == 4.5
    assert by_hour[22]["e5_tot_p24h_max"] is None and by_hour[33]["t28m"] is None
    esat = 0.6112 * math.exp(17.62 * 26.0 / (243.12 + 26.0))
    assert r["t28m"] == 26.0 and r["vpd28m"] == pytest.approx(esat * 0.2)
    assert r["e5_t2m_anom"] == pytest.approx(0.0)
    # hours before local midnight of the first of the month belong to the old month, as does their date
    assert by_hour[0]["month"] == 2 and by_hour[0]["date"] == dt.date(2017, 2, 28)


def test_daily_groups_once_at_month_edges(spark, inputs):
    e5, gpm, rain, record = inputs
    dat = frame.model_frame(frame.covariates(e5, gpm, rain), record)
    days = daily.daily(dat, ["e5_t2m", "t28m"])
    assert days.groupBy("date", "stat").count().where("count <> 1").count() == 0
    first = {r["stat"]: r for r in days.where("date = '2017-03-01'").collect()}
    assert (first["min"]["e5_t2m"], first["max"]["e5_t2m"]) == (pytest.approx(25.0), pytest.approx(48.0))
    assert set(first) == {"min", "mean", "max"}
    assert daily.complete_days(dat, "e5_t2m").select("date").distinct().count() == 7
    assert daily.complete_days(dat, "t28m").count() == 0


def test_satellite_rain_by_record_id(spark, tmp_path):
    paths = [put(tmp_path, f"g{i}.csv", ["system:index", "precipitationCal", "grid_cell"],
                 [["20150102033000_x", 1.5, "n"], [f"2015010204{i}000_x", 2.5, "n"], ["20150102033000_x", 9.0, "s"]]) for i in (0, 3)]
    got = readers.read_satellite_rain_by_id(spark, paths, "n").orderBy("time_utc").collect()
    assert [(r["time_utc"], r["precip"]) for r in got] == [
        (dt.datetime(2015, 1, 2, 3, 30), 1.5), (dt.datetime(2015, 1, 2, 4, 0), 2.5), (dt.datetime(2015, 1, 2, 4, 30), 2.5)]


def test_variables_from_files(spark, tmp_path):
    for v in ("SSRD", "STRD"):
        put(tmp_path / "arc", f"401905.{v}.e5.csv", ["value"], [[1.0]])
    got = readers.variables_in(readers.read_csv(spark, str(tmp_path / "arc")))
    assert sorted(r[0] for r in got.collect()) == ["SSRD", "STRD"]


# --- products ---------------------------------------------------------------


def filled(spark, name, obs, pred):
    return spark.createDataFrame([("s", T0, obs, pred, obs if obs is not None else pred)],
                                 f"site string, date timestamp_ntz, {name} double, {name}_pred double, {name}_gf double")


def merged_inputs(spark, temp=25.0):
    key = "site string, date timestamp_ntz"
    one = lambda cols, *v: spark.createDataFrame([("s", T0, *v)], f"{key}, {cols}")
    return dict(
        rain=one("p_mm_obs double, p_gpm double, p_mm_gf double", None, 1.0, 1.0),
        temperature=filled(spark, "t28m", temp, 20.0).withColumn("gapfill", F.lit(False)),
        humidity=filled(spark, "rh28m", None, 80.0).withColumn("gapfill", F.lit(True)),
        radiation=one("shortwave_obs double, shortwave_pred double", None, -4.0),
        wind=one("ws double, ws_bc double", 2.0, 1.5), pressure=one("sp double", 101325.0), thermal=one("strd double", 3600.0))


def test_merged_product(spark):
    r = merged.merge(**merged_inputs(spark)).first()
    es = 6.112 * math.exp(17.67 * 25 / (25 + 243.5))
    assert r["specific_humidity_gf"] == pytest.approx(0.622 * 0.8 * es / (1013.25 - 0.378 * 0.8 * es))
    assert (r["shortwave_pred"], r["shortwave_gf"], r["longwave"], r["windspeed_bc"], r["rh28m_obs"]) == (0.0, 0.0, 1.0, 1.5, None)


def test_merged_product_stops_on_frost(spark):
    with pytest.raises(Exception, match="t28m_gf >= 0 does not hold"):
        merged.merge(**merged_inputs(spark, temp=-1.0)).collect()


def test_jobs_from_files_to_the_merged_product(spark, tmp_path):
    day = dt.date(2024, 1, 1)
    hours = [T0 + dt.timedelta(hours=h) for h in range(24 * 40)]
    at = lambda *name: str(tmp_path.joinpath(*name))
    half = [("s", t + dt.timedelta(minutes=m), None if t.hour == 3 else 0.5, 2.0) for t in hours for m in (0, 30)]
    spark.createDataFrame(half, "site string, date timestamp_ntz, precip double, g_p double").write.parquet(at("half"))
    jobs.rain_product(spark, at("half"), at("rain"), run_date=day)
    rows = [("s", t, t.hour, t.month, None if i % 9 == 0 else 20.0 + t.hour, 80.0 - t.hour / 2, None if i < 12 else float(t.hour),
             3.0 + t.hour / 10, None if i % 5 else 4.0 + t.hour / 10) for i, t in enumerate(hours)]
    frame = spark.createDataFrame(rows, "site string, date timestamp_ntz, hour int, month int, t28m double, rh28m double, e5 double, ws double, vv double")
    frame.write.parquet(at("frame"))
    for target, folder in (("t28m", "temp"), ("rh28m", "hum")):
        jobs.smooth_product(spark, at("frame"), target, {"e5": F.col("e5")}, at(folder), run_date=day)
    jobs.wind_product(spark, at("frame"), at("wind"), run_date=day)
    frame.select("site", "date", F.lit(100.0).alias("shortwave_obs"), F.lit(-1.0).alias("shortwave_pred")).write.parquet(at("light"))
    frame.select("site", "date", F.lit(101325.0).alias("sp")).write.parquet(at("pressure"))
    frame.select("site", "date", F.lit(3600.0).alias("strd")).write.parquet(at("thermal"))
    paths = dict(rain=at("rain"), temperature=at("temp"), humidity=at("hum"), radiation=at("light"), wind=at("wind"),
                 pressure=at("pressure"), thermal=at("thermal"))
    jobs.merged_product(spark, paths, at("out"), run_date=day, check=False)
    out = readers.read_table(spark, at("out", "parquet"))
    assert out.count() == len(hours) == readers.read_csv(spark, at("out", "csv")).count()
    # the first covariates are missing, so is the prediction of a gap there, and nothing else
    assert out.where("t28m_gf IS NULL").count() == 2 and out.where("t28m_pred IS NULL").count() == 12
    assert out.where("p_mm_gf IS NULL OR windspeed_bc IS NULL OR shortwave_gf <> 100").count() == 0


def test_cell_product_job(spark, tmp_path):
    rows = [(v, lon, -1.75, 8760 * 80 + h, float(h)) for v in ("t", "u") for lon in (308.5, 309.5) for h in range(5)]
    grid = spark.createDataFrame(rows, "variable string, lon double, lat double, time_hours long, value double")
    writers.write_grid(grid, str(tmp_path / "grid"))
    jobs.cell_product(spark, str(tmp_path / "grid"), str(tmp_path / "cell"), variables=["t"], run_date=dt.date(2024, 1, 1))
    out = readers.read_table(spark, str(tmp_path / "cell")).collect()
    assert len(out) == 5 and {r["variable"] for r in out} == {"t"} and {r["lon"] for r in out} == {-51.5}


def test_files_with_other_column_orders_and_columns(spark, tmp_path):
    put(tmp_path / "in", "a.csv", ["x", "y"], [[1, 2], [3, 4]])
    put(tmp_path / "in", "b.csv", ["y", "x"], [[20, 10]])
    put(tmp_path / "in", "c.csv", ["z", "x"], [[9, 100]])
    got = {(r["x"], r["y"], r["z"]) for r in readers.read_csv(spark, str(tmp_path / "in")).collect()}
    assert got == {("1", "2", None), ("3", "4", None), ("10", "20", None), ("100", None, "9")}


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    folder = tmp_path / "with space 100%"
    for i in range(40):
        put(folder, f"f{i}.csv", ["x", "y"] if i % 2 else ["y", "x"], [[1, 2]] * 50)
    (folder / "empty.csv").write_text("")
    (folder / "blank.csv").write_text("\n \n")
    (folder / "late.csv").write_text("\nx,z\n5,6\n")
    (folder / "bare.csv").write_text("x,y\n")
    lines = readers._first_lines(spark, [str(folder)], None)
    assert len(lines) == 42 and {r["line"] for r in lines} == {"x,y", "y,x", "x,z"}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        df = readers.read_csv(spark, str(folder))
        jobs = len(tracker.getJobIdsForGroup("headers"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 1 + 3 + 1  # lines, one file of each kind, listing
    got = {(r["x"], r["y"], r["z"]): r["count"] for r in df.groupBy("x", "y", "z").count().collect()}
    assert got == {("1", "2", None): 1000, ("2", "1", None): 1000, ("5", None, "6"): 1}
    with pytest.raises(FileNotFoundError):
        readers.read_csv(spark, str(folder), name_pattern="*.txt")


def test_run_date_partitions_survive_reruns(spark, tmp_path):
    path = str(tmp_path / "out")
    for day, n in ((1, 5), (2, 7), (1, 3)):
        writers.write_parquet(spark.range(n), path, run_date=dt.date(2024, 1, day))
    got = {r["run_date"]: r["count"] for r in readers.read_table(spark, path).groupBy("run_date").count().collect()}
    assert got == {dt.date(2024, 1, 1): 3, dt.date(2024, 1, 2): 7}
    writers.write_csv(spark.range(3), str(tmp_path / "csv"), run_date=dt.date(2024, 1, 1))
    assert readers.read_csv(spark, str(tmp_path / "csv")).count() == 3


def test_scan_reads_only_named_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_parquet(spark.range(3).withColumns({"sp": F.lit(1.0), "other": F.lit("x")}), path, stamp=False)
    plan = readers.read_table(spark, path, ["id", "sp"])._jdf.queryExecution().executedPlan().toString()
    assert "other" not in plan


# --- models -----------------------------------------------------------------


@pytest.fixture(scope="module")
def learnable(spark):
    """Target follows one covariate and the hour; one covariate is noise with gaps; five years of months."""
    h = F.col("id")
    noise = (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("u")
    df = spark.range(1_500).select("id", F.expr("timestamp_ntz'2001-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id * 29 as int))").alias("time_local"), noise)
    df = df.withColumns({"site": F.lit("s"), "time_utc": F.col("time_local"), "date": F.to_date("time_local"),
                         "year": F.year("time_local"), "month": F.month("time_local"), "hour": F.hour("time_local"),
                         "e5_t2m": 20 + 5 * F.sin(h / 7), "g_p": F.when(h % 9 != 0, F.col("u"))})
    df = df.withColumn("t28m", F.when(h % 10 != 0, 2 + 0.8 * F.col("e5_t2m") + F.col("hour") / 24 + (F.col("u") - 0.5) / 10))
    df = df.withColumn("rh28m", F.when(h % 4 != 0, 100 - F.col("e5_t2m"))).drop("u")
    return df.repartition(4).persist()


def test_boosted_pipeline(spark, learnable):
    split = hourly.split_frame(learnable).persist()
    fitted = hourly.fit_targets(split, ["t28m", "rh28m"], depths=(2, 4), trees=8, folds=2)
    out = hourly.predict(learnable, fitted)
    assert out.columns == ["site", "time_utc", "time_local", "date", "year", "month", "hour", "t28m", "rh28m", "pred_t28m", "pred_rh28m"]
    assert out.count() == 1_500 and out.where("pred_t28m IS NULL").count() == 0
    skill = hourly.test_skill(split, fitted, "t28m").first()
    spread = split.where("part = 'test' AND t28m IS NOT NULL").agg(F.stddev("t28m")).first()[0]
    assert skill["rmse"] < 0.5 * spread and skill["r2"] > 0.7
    board = fitted["t28m"].leaderboard(spark).collect()
    assert len(board) == 2 and board[0]["rmse"] <= board[1]["rmse"]
    weights = {r["covariate"]: r["importance"] for r in fitted["t28m"].importance(spark).collect()}
    assert sum(weights.values()) == pytest.approx(1.0) and max(weights, key=weights.get) == "e5_t2m"


def test_target_rules(spark):
    df = spark.createDataFrame([(None,), (0.0,), (50.0,), (100.0,)], "rh28m double")
    assert [r[0] for r in models.usable(df, "rh28m", "train").collect()] == [0.0, 50.0]
    assert [r[0] for r in models.usable(df, "rh28m", "test").collect()] == [50.0, 100.0]


def test_scoring_keeps_types_and_rows(spark, learnable):
    train = models.usable(learnable, "t28m", "train")
    model = models.fit_general(train, "t28m", ["e5_t2m", "month"])
    gappy = learnable.withColumn("e5_t2m", F.when(F.col("hour") > 2, F.col("e5_t2m")))
    out = models.score(model, gappy, "pred", ["e5_t2m", "month"])
    assert out.select(*gappy.columns).schema == gappy.schema and out.count() == gappy.count()
    assert out.where("(pred IS NULL) <> (e5_t2m IS NULL)").count() == 0
    half = models.fit_general(models.usable(gappy, "t28m", "train"), "t28m", ["e5_t2m", "month"])
    assert models.score(half, learnable, "pred", ["e5_t2m", "month"]).where("pred IS NULL").count() == 0


def test_search_is_the_same_for_any_partitioning(spark, learnable):
    train = models.usable(learnable, "t28m", "train")
    boards = [models.search_linear(train.repartition(n), "t28m", ["e5_t2m", "g_p"], penalties=(0.0, 0.1), mixes=(0.0,)).scores
              for n in (2, 5)]
    assert [name for name, _ in boards[0]] == [name for name, _ in boards[1]]
    assert [e for _, e in boards[0]] == pytest.approx([e for _, e in boards[1]], rel=1e-9)


def test_smooth_models(spark, learnable):
    train = models.usable(learnable, "t28m", "train")
    hour, warm = models.cyclic("hour", 24), models.spline("e5_t2m", models.knots(train, "e5_t2m"))
    variants = {"hour": hour, "both": {**hour, **warm}}
    fitted = {n: models.fit_general(models.with_terms(train, v), "t28m", list(v), ridge=1e-8) for n, v in variants.items()}
    board = models.rank_by_aic(spark, fitted).collect()
    assert [r["model"] for r in board] == ["both", "hour"] and board[0]["delta"] == 0.0
    scored = models.score(fitted["both"], models.with_terms(learnable, variants["both"]), "pred", list(variants["both"]))
    error = scored.where("t28m IS NOT NULL").agg(F.sqrt(F.avg(F.pow(F.col("pred") - F.col("t28m"), 2)))).first()[0]
    assert error < 0.15
    assert len(models.tensor(hour, warm)) == len(hour) + len(warm) + len(hour) * len(warm)


def test_linear_forest_and_gamma(spark, learnable):
    train = models.usable(learnable, "t28m", "train")
    found = models.search_linear(train, "t28m", ["e5_t2m", "g_p", "hour"], penalties=(0.0, 5.0), mixes=(0.0,), folds=2)
    assert found.leaderboard(spark).first()["params"] == "elasticNetParam=0.0, regParam=0.0"
    plain = models.fit_linear(train, "t28m", ["e5_t2m", "hour"]).stages[-1]
    assert list(plain.coefficients) == pytest.approx([0.8, 1 / 24], abs=5e-3)
    forest = models.fit_forest(train, "t28m", ["e5_t2m", "g_p"], trees=5, depth=4)
    weights = models.importance(spark, forest, ["e5_t2m", "g_p"]).collect()
    assert weights[0]["covariate"] == "e5_t2m" and sum(r["importance"] for r in weights) == pytest.approx(1.0)
    gamma = models.fit_general(train, "t28m", ["e5_t2m"], family="gamma", link="log")
    assert gamma.stages[-1].summary.aic < 1e6


def test_daily_pipeline(spark, learnable):
    days = learnable.select("site", F.trunc("date", "month").alias("date"), "t28m", "e5_t2m", "g_p")
    per_day = days.groupBy("date").agg(F.count("t28m").alias("n")).groupBy("n").count().orderBy(F.desc("count")).first()["n"]
    out, found, held = daily.run(days, hours=per_day, values=["t28m", "e5_t2m", "g_p"], depths=(3,), trees=5, folds=2)
    assert out.columns == ["site", "date", "stat", "pred_t28m", "t28m"]
    assert out.count() == 3 * days.select("date").distinct().count()
    means = {r["stat"]: r["m"] for r in out.groupBy("stat").agg(F.avg("pred_t28m").alias("m")).collect()}
    assert means["min"] < means["mean"] < means["max"]


def test_smooth_fill_and_its_test_rows(spark, learnable):
    terms = {**filling.calendar_terms(), **models.spline("e5_t2m", models.knots(learnable, "e5_t2m"))}
    out = filling.smooth_fill(learnable, "t28m", terms, ["site", "time_utc"])
    assert out.count() == 1_500 and out.where("gapfill").count() == 150
    assert out.where("t28m_gf IS NULL OR (NOT gapfill AND t28m_gf <> t28m)").count() == 0
    model, test = filling.smooth_model(learnable, "t28m", terms, ["site", "time_utc"])
    assert 330 < test.count() < 480
    error = models.score(model, test, "pred", list(terms)).agg(F.sqrt(F.avg(F.pow(F.col("pred") - F.col("t28m"), 2)))).first()[0]
    assert error < 0.3


def test_corrected_wind_per_site_and_hour(spark):
    rows = [(s, T0 + dt.timedelta(hours=h), h % 2, 1.0 + (h * 7 % 11), (2.0 + (h * 7 % 11)) if h % 3 else None)
            for s in ("a", "b") for h in range(60)]
    df = spark.createDataFrame(rows, "site string, date timestamp_ntz, hour int, ws double, vv double")
    got = filling.corrected_wind(df)
    assert got.columns == ["site", "date", "ws", "ws_bc"] and got.count() == 120
    # the observed wind is the modelled one plus 1, at every quantile
    assert all(r["ws_bc"] == pytest.approx(r["ws"] + 1.0) for r in got.collect())


def test_jobs_from_files_to_products(spark, tmp_path):
    """Forty days over two months, two logs, three covariate files, hourly and daily product."""
    t0, n = dt.datetime(2021, 1, 12), 24 * 40
    hours = [t0 + dt.timedelta(hours=h) for h in range(n)]
    old = [[(t - dt.timedelta(hours=3)).isoformat(" "), 20 + t.hour / 4 + t.day / 20, 80 + t.hour / 3, t.hour, 0.1] for t in hours[: n // 2]]
    names = list(layouts.LOG_2021)
    new = []
    for t in hours[n // 2:]:
        local = t - dt.timedelta(hours=3)
        r = {k: 1.0 for k in names}
        r |= {"Dia": local.day, "Mês": local.month, "Ano": 21, "Hora": f"{local.hour}:00", "Tar_28m (°C)": 20 + t.hour / 4 + t.day / 20, "RH_28m (%)": 80}
        new.append([r[k] for k in names])
    header = list(layouts.REANALYSIS)
    e5 = [["s", t.isoformat(" "), 293.15 + t.hour / 4, 290.15, 1e5, 1, 1, 0, 3, 4, 0.001] for t in hours]
    put(tmp_path / "e5", "ERA5-Land-hourly___1.csv", header, e5)
    gpm = put(tmp_path, "gpm.csv", ["date", "precipitationCal", "site"],
              [[(t + dt.timedelta(minutes=m)).isoformat(" "), 1.0, "s"] for t in hours for m in (0, 30)])
    rain = put(tmp_path, "rain.csv", ["date", "precipitation", "site"], [[(t0 + dt.timedelta(days=d)).date(), 1.0, "s"] for d in range(40)])
    day = dt.date(2024, 1, 1)
    jobs.clean_station(spark, {"2001": put(tmp_path, "old.csv", list(layouts.LOG_2001), old)}, "s", str(tmp_path / "record"), day)
    jobs.clean_recent(spark, put(tmp_path, "new.csv", names, new), "s", str(tmp_path / "recent"), day)
    dat = jobs.build_frame(spark, "s", reanalysis=str(tmp_path / "e5"), satellite=gpm, daily_rain=rain,
                           record=str(tmp_path / "record"), recent=str(tmp_path / "recent")).persist()
    assert dat.count() == n and dat.where("t28m IS NULL").count() == 0
    search = dict(depths=(3,), trees=5, folds=2)
    skill = jobs.hourly_product(dat, str(tmp_path / "hourly"), ["t28m", "vpd28m"], run_date=day, **search)
    assert set(skill) == {"t28m", "vpd28m"} and skill["t28m"].first()["n"] > 0
    back = readers.read_table(spark, str(tmp_path / "hourly" / "parquet"))
    assert back.count() == n and {"pred_t28m", "pred_vpd28m", "run_date"} <= set(back.columns)
    learned = jobs.daily_product(dat, str(tmp_path / "daily"), run_date=day, steps=(0.1,), **search)
    assert learned["leaderboard"].count() == 1 and learned["importance"].count() > 3 and learned["skill"].count() == 1
    assert readers.read_csv(spark, str(tmp_path / "daily")).count() == 3 * dat.select("date").distinct().count()
