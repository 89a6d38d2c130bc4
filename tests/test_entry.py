"""Every registered query runs and, where it has SQL, gives what DuckDB gives."""

import pytest
from conftest import SMALL
from oracle import connect, difference, types

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SLOW = {"param_grid", "als_factors", "als_predict", "als_product_recs"}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    got = df.toPandas()
    assert len(got) > 0
    if name in entry.oracle_sql():
        sql = entry.oracle_sql()[name]
        assert difference(got, con.execute(sql).df()) is None
        assert types(df, con, sql) == ""


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
