"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

from check import connect, difference  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from coursemill.registry import all_queries as queries  # noqa: E402
from coursemill.registry import all_sql as oracle_sql  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_each_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, name):
    assert difference(queries()[name](spark, SF).toPandas(), con.execute(oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in queries() if not n.startswith(("stream", "keyed", "versioned", "sink"))))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in plan
