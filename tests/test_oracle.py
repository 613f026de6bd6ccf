"""Every query against its checking SQL, with a look at its plan."""

import pytest

import __spark_entry__ as entry_points
from helpers import duck_table, sample_dir, spark_table
from innledger.plans.oracle import ORACLES
from innledger.plans.registry import QUERIES

QUERY_NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERY_NAMES)
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, sample_dir("0.001"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert slow not in plan
    columns, found = spark_table(df)
    expected_columns, expected = duck_table(duck("0.001"), entry_points.oracle_sql()[name])
    assert columns == expected_columns
    assert found == expected


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["date", "occupied_rooms", "total_rooms", "occupancy_rate_pct"]
    assert df.count() > 0

