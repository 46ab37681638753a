"""The plans stay the ones we want: pruned scans, one customer exchange, no Cartesian product."""

from __future__ import annotations

import re

import pytest

from tallywatch.queries import queries

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_uses_one_customer_exchange_and_one_sort(spark):
    plan = physical(queries()["fraud_scores"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id", plan)) == 1
    assert len(re.findall(r"Sort \[customer_id", plan)) == 1
    windowed = physical(queries()["fraud_scores_windowed"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id", windowed)) == 1
    assert len(re.findall(r"Sort \[customer_id", windowed)) == 1


@pytest.mark.parametrize("name", ["dq_report", "fraud_scores", "fraud_scores_split", "dashboard_kpis", "label_eval", "dq_summary"])
def test_no_cartesian_product(spark, name):
    plan = physical(queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = physical(queries()["dq_missing_customer_id"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "user_id"}
    assert "props" not in physical(queries()["fraud_scores"](spark, SF))


def test_top_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in physical(queries()["top_flagged"](spark, SF))


def test_unique_ids_are_counted_with_a_partial_aggregate(spark):
    plan = physical(queries()["transactions_clean"](spark, SF))
    assert re.search(r"partial_count\(1\)", plan)


def test_rows_are_marked_under_a_spread_key(spark):
    """Hot ids and missing ids must not meet in one task: rows never move by the id itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(queries()["transactions_clean"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = re.search(r"SortMergeJoin \[(\S+)#\d+\], \[(\S+)#\d+\]", plan)
    assert join.group(1) == "_key"
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert moved[0] == "_key"
    assert plan.count("BroadcastHashJoin") == 1
