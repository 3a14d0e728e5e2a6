"""Physical-plan properties the design relies on at scale."""

import pytest

import __spark_entry__ as E
from sievery.plans.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"
BATCH_KEYS = sorted(k for k in QUERIES
                    if not k.startswith("stream") and k not in ("history_pages", "listing_pages"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_cross_or_nested_loop_joins(spark, key):
    plan = _plan(E.queries()[key](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_counts_aggregate_partially_before_the_shuffle(spark):
    plan = _plan(E.queries()["sieve_counts"](spark, SMALL))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(channel")


def test_payloads_collect_partially_and_join_after_grouping(spark):
    plan = _plan(E.queries()["post_payloads"](spark, SMALL))
    assert "partial_collect_list" in plan
    # the channel lookup sits above the grouping, on the few payload rows
    assert plan.index("HashJoin") < plan.index("ObjectHashAggregate")


def test_window_counts_aggregate_partially(spark):
    plan = _plan(E.queries()["route_windows"](spark, SMALL))
    assert "partial_count" in plan and "collect_set" not in plan
    # top-down: windows are made of routed pane counts, which are counted before
    join = plan.index("Join")
    assert plan.index("Generate explode") < join
    assert "partial_count(1)" in plan[join:plan.index("events.parquet")]


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["route_windows"](spark, SMALL))
    events_scan = [ln for ln in plan.splitlines() if "events.parquet" in ln][0]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in events_scan
