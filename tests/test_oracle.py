"""Every catalogue query with SQL gives the rows that SQL gives; the others give rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare
from gapweave.plans import catalog

SMALL = "/root/testdata/sf0.001"
MODELS = {"boosted_search", "hourly_product", "hourly_skill", "daily_product"}


@pytest.mark.parametrize("name", sorted(set(catalog.load()) - MODELS))
def test_query_agrees(spark, name):
    assert compare(spark, name, SMALL) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_a_stable_schema(spark):
    df = entry(spark)
    assert df.columns == ["site", "time", "hour", "t28m", "e5_t2m", "bad", "t28m_pred", "t28m_gf", "gapfill"]
    assert df.count() > 0
