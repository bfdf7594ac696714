"""Physical-plan properties of the registered read-only queries."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF_CHECK

# Queries that only read (sink queries write while being built).
READ_ONLY = ["supplier_metrics", "customer_summary", "order_line_summary", "part_prevalence",
             "decode_status", "cast_matrix", "regex_flag", "surrogate_key", "dedup_latest",
             "drop_duplicates", "anti_join", "keyed_diff", "inline_lookup", "code_mapping",
             "value_frequency", "money_difference", "quality_checks", "split_value"]


def _plan(spark, name):
    df = entry.queries()[name](spark, SF_CHECK)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_cartesian_no_python(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in plan, f"{name}: {bad}"


def test_scans_are_pruned(spark):
    plan = _plan(spark, "supplier_metrics")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(s.count(":") <= 4 for s in schemas)   # only referenced columns


def test_filters_reach_the_scan(spark):
    plan = _plan(spark, "keyed_diff")
    assert re.search(r"PushedFilters: \[[^\]]*o_orderdate", plan)


def test_keep_latest_limits_before_its_only_shuffle(spark):
    plan = _plan(spark, "dedup_latest")
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange ") == 1
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange ")       # printed top-down: one below


def test_next_event_is_range_sliced(spark):
    plan = _plan(spark, "reorder_risk")
    assert "Scan ExistingRDD" in plan and "LeftOuter" in plan        # checkpointed slices, heads joined on


def test_quality_checks_read_line_items_twice(spark):
    assert _plan(spark, "quality_checks").count("lineitem.parquet") <= 2


def test_event_detail_joins_the_entity_once(spark):
    assert _plan(spark, "order_line_summary").count("customer.parquet") == 1


def test_anti_join_reduces_the_right_side_first(spark):
    plan = _plan(spark, "anti_join")
    assert "LeftAnti" in plan and plan.count("HashAggregate") == 2


def test_distinct_count_is_two_level(spark):
    plan = _plan(spark, "supplier_metrics")
    assert plan.count("HashAggregate") >= 4        # partial/final for both levels


def test_fan_out_join_has_no_outer_join(spark):
    # the left join is rewritten as inner + anti join, both skew-splittable by AQE
    plan = _plan(spark, "order_line_summary")
    assert "LeftOuter" not in plan and "FullOuter" not in plan
    assert "LeftAnti" in plan
