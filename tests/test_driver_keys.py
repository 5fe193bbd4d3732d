import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, _plain
from driver_keys.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    ours, theirs = df.toPandas(), db.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert _plain(ours) == _plain(theirs)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
