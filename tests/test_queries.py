"""Every query beside its SQL on the smallest tables; the driver does the same on larger ones."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from check_queries import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


#: Fits at the full width take about a minute each: test_training_side fits smaller encoders, check_queries runs these.
SLOW = {"train_wide", "train_deep", "train_wide_deep", "export_and_score"}


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_equals_its_sql(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    got = [tuple(r) for r in frame.collect()]
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows_of(frame.columns, got) == rows_of(names, cursor.fetchall())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert costly not in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
