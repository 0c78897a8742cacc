"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL[name], SF_DIR) is None


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["user_id", "session_no", "session_min", "session_max"]
    assert df.limit(1).count() == 1


# Streams may run Python in their state; operators of training data have tests of their own.
NATIVE = sorted(n for n in QUERIES if not n.startswith(("stream_", "op")) and n != "pipeline")


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_plans(spark, name):
    text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Pandas", "InArrow"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
