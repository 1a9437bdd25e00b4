"""Every registered query against its SQL, and the shape of the plans."""

import pytest

from __spark_entry__ import entry
from revtide.plans import ORACLES, QUERIES
from tests.compare import compare, database

SMALL = "/root/testdata/sf0.001"

#: Queries that start jobs of their own (files, streams) while they are built.
EAGER = {
    "generation_upsert",
    "projection_end_state",
    "projection_cursor",
    "projection_pages",
    "projection_page_faults",
    "objects_copied",
    "rows_migrated",
    "snapshot_restored",
    "snapshot_published",
    "text_stored_index",
    "text_any_stored",
    "knn_euclid_pivots",
    "key_state_stream",
    "abandoned_operations_stream",
    "search_many",
    "search_many_verdicts",
}


@pytest.fixture(scope="module")
def duck():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert name in ORACLES
    _, fault = compare(spark, duck, SMALL, name, QUERIES[name], ORACLES[name])
    assert fault is None


def test_entry_has_rows(spark):
    frame = entry(spark)
    assert frame.columns == ["id", "revision", "tombstone", "event_type", "value", "props"]
    assert frame.count() > 0


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_query_multiplies_its_inputs(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_journal_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["journal_read"](spark, SMALL))
    assert "event_type" not in plan.split("ReadSchema")[1]
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_id," in pushed and "LessThanOrEqual(event_id," in pushed


def test_search_keeps_only_the_best_rows_per_task(spark):
    for name in ("knn_dot", "text_any"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, SMALL))
