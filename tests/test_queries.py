"""Every registered query against its SQL form at the smallest scale, and its plan."""

import os

import pytest

import __spark_entry__ as registered
from check import compare
from sirenlog.plans.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


OWN = sorted(all_queries())
STREAMS = {"stream_project", "stream_project_keyed", "submit_publish_project", "replay_attempts"}
WITH_GENERATOR = {"summarize_incidents", "summarize_with_failures"}


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, name):
    assert compare(spark, SF_DIR, name) == ""


@pytest.mark.parametrize("name", sorted(set(OWN) - STREAMS))
def test_plan_has_no_cross_join_and_no_needless_python(spark, name):
    plan = registered.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("Python" in plan or "MapInPandas" in plan) == (name in WITH_GENERATOR)


def test_every_query_has_sql():
    assert set(OWN) <= set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns == ["id", "incidentId", "type", "message", "timestamp"] and frame.take(1)
