"""Clock, moisture, null and naming rules on hand-made rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gapweave.functions import clock, moisture, naming, nullrules


def ts(text):
    return dt.datetime.fromisoformat(text)


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("v")).first()["v"]


def stamp(spark, column, text):
    return one(spark, column(F.col("t").cast("timestamp_ntz")), t=text)


def test_month_edge_stays_in_one_local_day(spark):
    local = stamp(spark, clock.to_local, "2012-02-01 02:00:00")
    assert local == ts("2012-01-31 23:00:00")
    assert stamp(spark, lambda t: F.month(clock.to_local(t)), "2012-02-01 02:00:00") == 1


def test_offset_is_fixed_in_summer_time_years(spark):
    assert stamp(spark, clock.to_local, "1987-12-01 12:00:00") == ts("1987-12-01 09:00:00")


@pytest.mark.parametrize("zone", ["UTC", "America/Belem", "Europe/Berlin"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        t = "2021-03-28 02:30:00"  # does not exist on Berlin clocks
        assert stamp(spark, lambda c: clock.floor_time(c, 60), t) == ts("2021-03-28 02:00:00")
        assert stamp(spark, lambda c: clock.round_time(c, 60), t) == ts("2021-03-28 03:00:00")
        assert stamp(spark, clock.epoch_seconds, t) == int(dt.datetime(2021, 3, 28, 2, 30, tzinfo=dt.timezone.utc).timestamp())
        assert one(spark, clock.from_clock_text(F.lit("2021-03-28").cast("date"), F.col("c")), c="2:30") == ts("2021-03-28 02:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("text,want", [("00:30:00", "01:00"), ("00:29:59", "00:00"), ("23:45:00", None)])
def test_rounding_to_hours_sends_ties_up(spark, text, want):
    got = stamp(spark, lambda t: clock.round_time(t, 60), f"2020-01-01 {text}")
    assert got == (ts(f"2020-01-01 {want}") if want else ts("2020-01-02 00:00"))


@pytest.mark.parametrize("text,want", [("00:15:00", "00:30"), ("00:14:59", "00:00"), ("00:45:00", "01:00")])
def test_rounding_to_half_hours(spark, text, want):
    assert stamp(spark, lambda t: clock.round_time(t, 30), f"2020-01-01 {text}") == ts(f"2020-01-01 {want}")


def test_impossible_date_is_null(spark):
    built = clock.from_parts(*[F.lit(v) for v in (2022, 2, 30, 0)])
    assert one(spark, built) is None
    assert one(spark, clock.date_from_parts(F.lit(2022), F.lit(2), F.lit(30))) is None


@pytest.mark.parametrize("text,want", [("7:30", "07:30:00"), ("07:30:05", "07:30:05"), ("23:59", "23:59:00"), ("x", None)])
def test_clock_spellings(spark, text, want):
    got = one(spark, clock.from_clock_text(F.lit("2021-05-02").cast("date"), F.col("c")), c=text)
    assert got == (ts(f"2021-05-02 {want}") if want else None)


@pytest.mark.parametrize("year", [16, 2016])
def test_two_digit_years(spark, year):
    assert one(spark, clock.full_year(F.col("y")), y=year) == 2016


def test_decimal_year(spark):
    assert stamp(spark, clock.decimal_year, "2019-01-01 00:00:00") == 2019.0
    assert stamp(spark, clock.decimal_year, "2020-07-02 00:00:00") == pytest.approx(2020.5, abs=1e-12)


def test_archive_hours_with_fractional_lead(spark):
    got = one(spark, clock.from_grid_hours(F.col("h"), F.col("lead")), h=1036800, lead=1.5)
    assert got == dt.datetime(1900, 1, 1) + dt.timedelta(hours=1036801.5)


def test_record_id_prefix(spark):
    assert one(spark, clock.from_stamp_prefix(F.col("id")), id="20150102033000_0001") == ts("2015-01-02 03:30:00")


def test_elapsed(spark):
    a, b = (F.lit(v).cast("timestamp_ntz") for v in ("2018-12-31 20:00:00", "2000-05-31 21:00:00"))
    assert one(spark, clock.elapsed_seconds(b, a)) == (ts("2000-05-31 21:00:00") - ts("2018-12-31 20:00:00")).total_seconds()


def test_moisture(spark):
    assert one(spark, moisture.saturation_pressure(F.col("t")), t=0.0) == pytest.approx(0.6112)
    assert one(spark, moisture.deficit_from_humidity(F.col("t"), F.col("r")), t=20.0, r=100.0) == pytest.approx(0.0)
    es = 6.112 * math.exp(17.67 * 25 / (25 + 243.5))
    want = 0.622 * 0.8 * es / (1013.25 - 0.378 * 0.8 * es)
    assert one(spark, moisture.specific_humidity(F.col("r"), F.col("t")), r=0.8, t=25.0) == pytest.approx(want)
    assert one(spark, moisture.conductance_curve(F.col("p")), p=-0.1) == pytest.approx(0.5)
    assert one(spark, moisture.conductance_curve(F.col("p")), p=-1.1) == pytest.approx(0.5 - 0.5 * (-1.0 / -1.2))


def test_clamp_keeps_nulls(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (2.0,)], "x double").select(moisture.not_negative(F.col("x")))
    assert [r[0] for r in df.collect()] == [0.0, None, 2.0]


def test_null_rules(spark):
    df = spark.createDataFrame([("part", 1.0), ("part", None), ("none", None), ("one", 3.0)], "g string, x double")
    x = F.col("x")
    rows = {r["g"]: r for r in df.groupBy("g").agg(
        F.avg(x).alias("mean"), nullrules.strict_mean(x).alias("smean"), nullrules.lenient_sum(x).alias("sum"),
        nullrules.strict_sum(x).alias("ssum"), F.stddev_samp(x).alias("sd"), F.min(x).alias("lo")).collect()}
    assert (rows["part"]["mean"], rows["part"]["smean"], rows["part"]["sum"], rows["part"]["ssum"]) == (1.0, None, 1.0, None)
    assert (rows["none"]["mean"], rows["none"]["lo"], rows["none"]["sum"], rows["none"]["ssum"]) == (None, None, 0.0, None)
    assert rows["one"]["sd"] is None


def test_nan_becomes_null(spark):
    df = nullrules.nan_to_null(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "`a b` double, k int"))
    assert [r[0] for r in df.orderBy("k").collect()] == [None, 2.0]


def test_unknown_condition_stays_unknown(spark):
    df = spark.createDataFrame([(None,), (True,), (False,)], "c boolean")
    got = [r[0] for r in df.select(nullrules.choose(F.col("c"), F.lit("y"), F.lit("n"))).collect()]
    assert got == [None, "y", "n"]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "site int, T2M int, WS int")
    assert naming.prefix(naming.lower_names(df), "e5_", ("site",)).columns == ["site", "e5_t2m", "e5_ws"]
    assert naming.covariates(["e5_a", "t28m", "g_p", "c_p48h", "hour"]) == ["e5_a", "g_p", "c_p48h", "month", "hour"]
    assert naming.compare_names(["a", "b"], ["b", "c"]) == {"both": ["b"], "left_only": ["a"], "right_only": ["c"]}
    assert naming.starting_with(["obs_x", "pred_x", "y"], "obs_", "pred_") == ["obs_x", "pred_x"]


def test_variable_in_file_name(spark):
    assert one(spark, naming.variable_of(F.col("f")), f="401905.SSRD.e5.oper.nc") == "SSRD"
    assert one(spark, naming.variable_of(F.col("f")), f="nodots") is None
