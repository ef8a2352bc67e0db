"""Plan checks: shuffles, pushed filters, Python in the plan, reuse."""

import re

import pytest
from pyspark.sql import functions as F

from flowops import check_state, hold_release, kv_put, number_fragments, scan_cells, to_cells
from flowops.queries import QUERIES
from flowops.session import shared_dir, spread

SF_DIR = "/root/testdata/sf0.001"

# the only ones that read documents in Python
ARROW = {"xml_rows", "xml_record"}


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("stream_", "read_files"))))
def test_no_python_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "PythonUDF" not in re.sub(r"ArrowEvalPython.*", "", plan)
    assert ("ArrowEvalPython" in plan) == (name in ARROW)


def test_state_shuffles_once(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").withColumn("action", F.lit("hold"))
    plan = plan_of(hold_release(events, "user_id", "event_type", "action", "event_id"))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    plan = plan_of(check_state(events, "user_id", "event_type", "event_id"))
    assert plan.count("Exchange hashpartitioning") == 1


def test_large_groups_are_cut(spark):
    """With a low limit the hot key is spread: no task sees more than a few parts of it."""
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"))
    out = check_state(rows.withColumn("v", F.lit("x")), "k", "v", "id", max_rows=100)
    plan = plan_of(out)
    assert "__part" in plan and re.search(r"Exchange hashpartitioning\(k#\d+, __part#\d+", plan)
    assert plan.count("Window") == 1 and "BroadcastHashJoin" in plan  # the few part totals are measured
    assert out.where("k = 'hot' and route = 'initial'").count() == 1


def test_global_numbering_has_no_single_task_over_rows(spark):
    plan = plan_of(number_fragments(spark.range(1000), [], "id"))
    # one task sees nothing but pre-aggregated totals
    assert "Window" in plan
    for below in re.findall(r"Exchange SinglePartition.*\n.*", plan):
        assert "Aggregate" in below.split("\n")[1]


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    customer = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    to_cells(customer, "customer", "c_custkey", ["c_name", "c_mktsegment"]).write.parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    plan = plan_of(scan_cells(cells, "customer", F.col("row_key").startswith("1"), names=["c_name"]))
    assert "StringStartsWith(row_key,1)" in plan and "EqualTo(table,customer)" in plan
    plan = plan_of(QUERIES["check_state_gt"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan


def test_small_changes_do_not_shuffle_the_table(spark, monkeypatch):
    plan = plan_of(QUERIES["cdc_apply"](spark, SF_DIR))
    assert "Exchange hash" not in plan and "Window" not in plan and "BroadcastHashJoin" in plan
    table = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    updates = spark.createDataFrame([("1", "x", 1)], "key string, value string, ord int")
    assert "Exchange hash" not in plan_of(kv_put(table, updates, "ord"))
    # beyond the bound nothing is broadcast by hint
    monkeypatch.setattr("flowops.session.MAX_BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = kv_put(table, updates, "ord")
        assert "SortMergeJoin" in plan_of(large) and large.count() == 1000
        assert "SortMergeJoin" in plan_of(QUERIES["cdc_apply"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_session_helpers(spark):
    assert shared_dir(spark)
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 8
    wide = spark.range(0, 100, 1, 16)
    assert spread(wide) is wide
