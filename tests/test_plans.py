"""Physical plans: what is broadcast, shuffled, pruned and split."""

import re

import pytest
from pyspark.sql import functions as F

from tapeloom.operators.order_state import _with_prefixes
from tapeloom.operators.touched import keys_of, split_by_keys
from tapeloom.plans.gold import fills_per_order, order_analytics_gold
from tapeloom.plans.silver import executions_silver, orders_silver
from tapeloom.sources import layout as store
from tapeloom.sources.dimensions import dimension
from tapeloom.workload.queries import Desk, queries
from tests.helpers import FILL, ORDER, table

DIRECTORY = "/root/testdata/sf0.001"
STREAMS = {n for n in queries() if n.startswith("stream_")} | {"order_summary_file"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_of(df)


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", sorted(set(queries()) - STREAMS - {"market_snapshot_json"}))
def test_no_python_and_no_product(spark, name):
    plan = plan_of(queries()[name](spark, DIRECTORY))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval",
                     "BatchEvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in plan


def hot_fills(spark, n=30_000):
    """A third of all fills belongs to one order."""
    i = F.col("id")
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("x"), i).alias("exec_id"),
        F.when(i % 3 == 0, "O0").otherwise(F.concat(F.lit("O"), i % 3000)).alias("order_id"),
        F.lit(10).alias("fill_qty"), F.lit(10.5).alias("fill_price"),
        F.lit("IEX").alias("venue"), F.lit("2024-01-02 10:00:00").cast("timestamp").alias("exec_time"),
    )


def many_orders(spark, n=3000):
    return spark.range(n).select(
        F.concat(F.lit("O"), "id").alias("order_id"), F.lit("T1").alias("trader_id"),
        F.lit("SPY").alias("etf_ticker"), F.lit("BUY").alias("direction"), F.lit(100).alias("qty"),
        F.lit("LIMIT").alias("order_type"), F.lit(10.0).alias("price_limit"),
        F.lit("PENDING").alias("status"),
        F.lit("2024-01-02 09:00:00").cast("timestamp").alias("created_at"),
        F.lit("VWAP").alias("strategy"), F.lit(10.0).alias("arrival_price"),
    )


def test_a_hot_order_is_split_in_the_join(spark, small_partitions):
    silver = executions_silver(hot_fills(spark), many_orders(spark))
    assert "SortMergeJoin(skew=true)" in final_plan(silver)
    assert silver.count() == 30_000


def test_a_hot_order_is_split_below_the_aggregate(spark, small_partitions):
    silver = executions_silver(hot_fills(spark), many_orders(spark))
    per_order = fills_per_order(silver)
    assert "SortMergeJoin(skew=true)" in final_plan(per_order)
    assert per_order.where("order_id = 'O0'").first().fill_count == 10_000


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, tmp_path):
    raw = table(spark, "raw_orders", [dict(order_id="a")], **ORDER)
    place = store.Layout(str(tmp_path))
    store.write_table(dimension(spark, "etf_reference"), place, "etf_reference")
    funds = store.read_table(spark, place, "etf_reference")
    assert "BroadcastHashJoin" in plan_of(orders_silver(raw, funds))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "BroadcastHashJoin" not in plan_of(orders_silver(raw, funds))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fills_are_aggregated_before_the_join(spark):
    raw = many_orders(spark)
    plan = plan_of(order_analytics_gold(
        orders_silver(raw, dimension(spark, "etf_reference")), executions_silver(hot_fills(spark), raw)))
    # Both sides of both joins by order_id, and nothing more.
    assert plan.count("Exchange hashpartitioning(order_id") == 3


def test_a_window_over_actions_never_spans_an_order(spark):
    acts = table(spark, "actions", [dict(action_id=1, order_id="a", action_type="CANCEL")])
    windows = re.findall(r"windowspecdefinition\(([^)]*)", plan_of(_with_prefixes(acts)))
    over_slices = [w for w in windows if "order_id#" in w]
    assert over_slices and all("slice#" in w.split("ASC")[0] for w in over_slices)
    assert all("action_id#" in w.split("ASC")[0] for w in windows if w not in over_slices)  # repeats of one id


def test_ticks_are_combined_before_any_shuffle_by_ticker(spark):
    plan = plan_of(Desk(spark, DIRECTORY).snapshot)
    for exchange in re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\).*?\n(.*?)\n", plan):
        assert "Aggregate" in exchange and "partial_" in exchange
    assert "Window" not in plan


def test_scans_are_pruned(spark, tmp_path):
    place = store.Layout(str(tmp_path))
    fills = executions_silver(table(spark, "raw_executions", [dict(exec_id="x")], **FILL),
                              table(spark, "raw_orders", [dict(order_id="O1")], **ORDER))
    store.write_table(fills, place, "executions_silver", mode="overwrite")
    plan = plan_of(fills_per_order(store.read_table(spark, place, "executions_silver")))
    (columns,) = re.findall(r"FileScan parquet \[(.*?)\]", plan)
    assert [c.split("#")[0] for c in columns.split(",") if "batch" not in c] == [
        "order_id", "fill_qty", "fill_price", "fill_notional", "exec_time", "slippage_bps"]


def test_stored_history_reads_the_folders_of_its_window(spark):
    plan = plan_of(queries()["price_history_stored"](spark, DIRECTORY))
    assert re.search(r"PartitionFilters: \[[^\]]*event_time_day", plan)


def test_stored_silver_reads_the_folders_of_the_day(spark):
    plan = plan_of(queries()["price_history_day_stored"](spark, DIRECTORY))
    assert re.search(r"PartitionFilters: \[[^\]]*event_time_day", plan)


def test_the_audit_of_an_order_reads_one_bucket(spark):
    # Spark prunes the files of the other buckets either way, but shows it only where it reads by bucket.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = plan_of(queries()["audit_of_order"](spark, DIRECTORY))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 16" in plan


def test_top_k_does_not_sort_everything(spark):
    plan = plan_of(queries()["order_blotter"](spark, DIRECTORY))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("name", [
    "slippage_by_etf", "fill_by_type", "orders_over_time", "dashboard_counters", "kpi_row",
    "slippage_by_trader", "notional_by_trader", "fill_vs_notional", "orders_by_status",
])
def test_aggregates_do_not_sort_the_listing_below(spark, name):
    plan = plan_of(queries()[name](spark, DIRECTORY))
    assert plan.count("rangepartitioning") == (1 if name == "orders_by_status" else 0)


def test_a_micro_batch_does_not_shuffle_the_large_table(spark, tmp_path):
    place = store.Layout(str(tmp_path))
    store.write_table(many_orders(spark), place, "raw_orders")
    orders = store.read_table(spark, place, "raw_orders")
    spark.createDataFrame([("O1",), ("O1",), ("O7",), ("none",), (None,)], "order_id string").write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    split = split_by_keys(orders, keys_of(batch))
    for part in split:
        plan = final_plan(part)
        assert "BroadcastHashJoin" in plan
        scan = plan[: plan.index("FileScan")]
        assert "Exchange hashpartitioning" not in scan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = split_by_keys(orders, keys_of(batch))
        assert "SortMergeJoin" in plan_of(split.touched) and "SortMergeJoin" in plan_of(split.rest)
        assert sorted(r.order_id for r in split.touched.collect()) == ["O1", "O7"]
        assert split.rest.count() == 2998
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["latest_raw_tick", "blotter_enriched", "live_orders_merge"])
def test_tables_are_not_sorted_to_be_aggregated(spark, name):
    """The only sort aggregate is that of the ticks at the latest time of their ticker."""
    plan = plan_of(queries()[name](spark, DIRECTORY))
    assert plan.count("SortAggregate") == (2 if name == "latest_raw_tick" else 0)
