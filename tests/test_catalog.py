"""Catalog queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, compare

DATA = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
# Covered end to end by the stage tests.
SLOW = {"run_train", "run_promote", "fit_segmenter", "select_k", "score_segments", "fit_churn", "score_churn",
        "save_and_load_model", "feature_importance", "importance_sort", "compare_challenger"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())
    assert len(contract.queries()) >= 120


def test_entry(spark):
    assert contract.entry(spark).count() > 100


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - SLOW))
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    rows = [tuple(r[c] for c in columns) for r in frame.collect()]
    assert rows or name in SQL
    if name in SQL:
        result = duck.execute(SQL[name])
        order = [d[0] for d in result.description]
        assert sorted(order) == columns
        assert not compare(rows, [tuple(r[order.index(c)] for c in columns) for r in result.fetchall()])
