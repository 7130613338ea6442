"""Every catalog query against its DuckDB oracle on the smallest provided tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import duck, normalize  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from signalbox.plans import catalog  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

SF = os.environ.get("SIGNALBOX_TEST_SF", SF_SMALL)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    # Optional queries that SQL cannot express are tested where they are defined.
    assert set(catalog.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert len(catalog.queries()) >= 60


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["local_name", "late_count", "avg_delay_seconds"]
    assert 0 < df.count() <= 20


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    odf = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert normalize(sdf.toPandas()) == normalize(odf)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Window [", "SortMergeJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_plan_has_no_cross_join_window_or_python(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan]
