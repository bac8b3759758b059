"""Every registered query against its SQL in DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from querybook.book import QUERIES
from querybook.gold_queries import ALL_TABLES
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ALL_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    result = queries()[name](spark, SF)
    columns = sorted(result.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=sort_key)
    assert name in oracle_sql()
    cursor = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert ours == sorted(theirs, key=sort_key)
    assert ours


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["gold_brand_performance", "replay_active", "merge_soft_delete", "report_price_moves"])
def test_plans_have_no_python_and_no_cross_join(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert unwanted not in plan
