"""Every registered query against its SQL twin on the smallest tables; the others must return rows."""

import math

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    query, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is not None:
        assert compare(spark, con, SF, query, sql) is None
    else:
        rows = query(spark, SF).collect()
        assert rows and not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 24


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if not n.startswith(("stream_", "scan_"))])
def test_no_cross_join_in_the_plan(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "CartesianProduct" not in plan
