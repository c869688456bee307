"""Physical plans: pruning, no forced broadcasts, no Python, no cross joins."""

import glob
import os
import re

import pytest

from tidemart.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tidemart")
EAGER = {n for n in QUERIES if n.startswith("stream_")} | {
    "cdc_apply", "append_distinct", "partition_overwrite", "dynamic_partition_write",
    "snapshot_load", "incremental_load", "tsv_roundtrip", "json_lines", "dim_calendar",
    "page_path_edges", "page_paths", "frequent_page_paths"}


def plan(spark, name):
    df = QUERIES[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def test_bucketed_orders_meet_their_lines_without_an_exchange(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        text = plan(spark, "order_totals_bucketed")
    finally:
        spark.conf.set(threshold, before)
    assert "SortMergeJoin" in text and text.count("Bucketed: true") == 2
    assert "Exchange" not in text


@pytest.mark.parametrize("name", ["fact_order_line_daily", "fact_payment_line_daily"])
def test_daily_facts_look_up_few_orders(spark, name):
    """Scans of lines and orders have a day bound or stand behind a join with the day's orders."""
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    relations = [i for i, line in enumerate(text.splitlines())
                 if "Relation" in line and ("l_orderkey" in line or "o_orderkey" in line)]
    lines = text.splitlines()
    for at in relations:
        depth = [len(re.match(r"[ :|+-]*", line)[0]) for line in lines]
        above = [lines[i] for i in range(at) if depth[i] < depth[at]
                 and all(depth[j] > depth[i] for j in range(i + 1, at + 1))]
        assert any("shipdate" in x or "orderdate" in x for x in above if "Filter" in x) or any(
            "LeftSemi" in x or "Inner" in x for x in above), lines[at]


def test_horizon_scan_is_bounded_and_narrow(spark):
    text = plan(spark, "user_product_order_nd")
    scan = [line for line in text.splitlines() if "FileScan" in line and "l_orderkey" in line][0]
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan
    assert "l_suppkey" not in scan and "l_linestatus" not in scan


def test_rank_is_cut_before_the_shuffle(spark):
    for name in ("cart_top3_by_category", "favorite_top3_by_brand", "search_top10"):
        assert re.search(r"WindowGroupLimit.*Partial", plan(spark, name))


def test_log_is_parsed_once_per_read(spark):
    assert plan(spark, "fact_page_view").count("Generate inline(array(from_json") == 1


def test_library_forces_no_broadcast_and_collects_only_buckets():
    for path in glob.glob(f"{ROOT}/**/*.py", recursive=True):
        source = open(path).read()
        if f"{os.sep}checks{os.sep}" in path or f"{os.sep}llm{os.sep}" in path:
            continue
        assert "broadcast(" not in source and "crossJoin" not in source
        assert "localCheckpoint" not in source and ".rdd" not in source
        assert source.count(".collect()") <= (1 if path.endswith("changes.py") else 0)


def test_hot_join_key_is_split(spark):
    """A third of all lines belong to one order: its partition is split in the join, also when an
    aggregate on the join key follows."""
    from pyspark.sql import functions as F

    from tidemart.plans import daily, facts

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        n = F.col("id")
        hot = F.when(n % 3 == 0, 1).otherwise(n)
        amount = F.lit(1).cast("decimal(16,2)")
        lines = spark.range(0, 200_000, 1, 8).select(
            n, hot.alias("order_id"), (n % 7).alias("sku_id"),
            F.timestamp_seconds(n).alias("create_time"), F.lit(1).cast("bigint").alias("sku_num"),
            (n % 100).cast("decimal(16,2)").alias("order_price"),
            amount.alias("split_total_amount"), amount.alias("split_activity_amount"),
            amount.alias("split_coupon_amount"))
        orders = spark.range(0, 200_000, 1, 8).select(n, (n % 50).alias("user_id"))
        df = daily.user_order(facts.order_line_measures(lines, orders, "user_id"))
        rows = df.collect()
        assert sum(r.order_num_1d for r in rows) == 200_000
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
