"""Every registered query against its SQL, over the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.ORACLE))
def test_query_equals_its_sql(spark, sql, name):
    found = entry.queries()[name](spark, FOLDER)
    expected = sql.sql(entry.ORACLE[name])
    assert sorted(found.columns) == sorted(expected.columns)
    rows = _ordered([tuple(r) for r in found.collect()], found.columns)
    assert rows and rows == _ordered(expected.fetchall(), expected.columns)


def test_only_the_iterative_fits_have_no_sql():
    assert set(entry.QUERIES) - set(entry.ORACLE) == {
        "learned_forecast", "learned_forecast_users", "model_selection", "leaderboard_learned"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_learned_queries_run(spark):
    rows = entry.queries()["leaderboard_learned"](spark, FOLDER).collect()
    assert len({(r.condition, r.model) for r in rows}) == 8
    assert all(math.isfinite(r.test_rmse) for r in rows)


def test_entry(spark):
    assert entry.entry(spark).count() == 20
