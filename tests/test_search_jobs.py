"""Boosted searches launch jobs by the thousand: what each of them carries, and how many go side by side."""

import threading

import pytest
from pyspark.sql import functions as F

from gapweave.operators import models
from gapweave.plans import hourly


class Stop(Exception):
    pass


def rows(spark, n=400):
    days = spark.range(n).select((F.col("id") % 7).cast("double").alias("e5_t2m"), (1 + F.col("id") % 12).cast("int").alias("month"),
                                 F.lit(2001).alias("year"), F.sqrt("id").alias("t28m"))
    return days.repartition(5, "e5_t2m").groupBy("e5_t2m", "month", "year", "t28m").agg(F.count("*").alias("n"))


def lineage(df):
    return df.rdd.toDebugString().decode()


def test_kept_rows_drop_their_plan_and_keep_their_order(spark):
    models.use_checkpoints(spark)
    with models.kept(rows(spark), ["e5_t2m"], "t28m") as plain, models.kept(rows(spark), ["e5_t2m"], "t28m", cut=True) as cut:
        assert cut.collect() == plain.collect() and cut.rdd.getNumPartitions() == 1
        assert "Shuffle" in lineage(plain) and "Shuffle" not in lineage(cut)


def test_boosted_candidates_go_side_by_side_without_the_plan(spark, monkeypatch):
    seen = []

    class Record:
        def __init__(self, *, parallelism, estimatorParamMaps, **_):
            seen.append((parallelism, len(estimatorParamMaps)))

        def fit(self, data):
            seen.append(lineage(data))
            raise Stop

    monkeypatch.setattr(models, "CrossValidator", Record)
    with pytest.raises(Stop):
        models.search_boosted(rows(spark), "t28m", ["e5_t2m"], depths=(3, 4, 5, 6, 7), steps=(0.05, 0.1))
    assert seen[0] == (10, 10) and "Shuffle" not in seen[1]


def test_all_targets_are_searched_at_once(spark, monkeypatch):
    meet = threading.Barrier(6, timeout=20)
    monkeypatch.setattr(models, "search_boosted", lambda train, target, inputs: (meet.wait(), target)[1])
    split = rows(spark, 20).withColumns({"part": F.lit("train"), **{t: F.col("t28m") for t in hourly.layouts.TARGETS if t != "t28m"}})
    assert hourly.fit_targets(split) == {t: t for t in hourly.layouts.TARGETS}
