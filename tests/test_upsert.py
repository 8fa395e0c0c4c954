import pytest
from pyspark.errors import PySparkException

from tapeloom.operators.upsert import (
    as_live_orders,
    live_order_fallback,
    live_order_source,
    merge_upsert,
    parse_live_order_rows,
    sync_live_orders,
)
from tapeloom.schemas import TABLES
from tests.helpers import LIVE, ORDER, by, table, ts

NOW = "2024-01-05 00:00:00"


def test_merge(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, name string, x double")
    source = spark.createDataFrame([(2, "B", None), (3, "C", None)], "id int, name string, x double")
    merged = by(merge_upsert(target, source, ["id"], ["x"]), "id")
    assert {k: (r.name, r.x) for k, r in merged.items()} == {
        1: ("a", 1.0), 2: ("b", None), 3: ("C", None)}
    defaulted = by(merge_upsert(target, source, ["id"], ["name"], {"x": 9.0}), "id")
    assert {k: (r.name, r.x) for k, r in defaulted.items()} == {
        1: ("a", 1.0), 2: ("B", 2.0), 3: ("C", 9.0)}
    assert merge_upsert(target, source, ["id"], ["x"]).columns == target.columns


def test_merge_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1.0)], "id int, name string, x double")
    source = spark.createDataFrame([(1, "z", 5.0), (2, "b", 2.0)], "id int, name string, x double")
    once = merge_upsert(target, source, ["id"], ["x"])
    twice = merge_upsert(once, source, ["id"], ["x"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_merge_rejects_a_repeated_key(spark):
    target = spark.createDataFrame([(1, 1.0)], "id int, x double")
    source = spark.createDataFrame([(2, 1.0), (2, 2.0)], "id int, x double")
    with pytest.raises(PySparkException, match="repeats key"):
        merge_upsert(target, source, ["id"], ["x"]).collect()


def test_sync_keeps_what_the_trader_adjusted(spark):
    live = table(spark, "live_orders", [
        dict(order_id="touched", status="CANCELLED", qty=7, price_limit=3.0, notional_value=21.0,
             assigned_hedge_id="5"),
        dict(order_id="gone"),
    ], **LIVE)
    orders = table(spark, "orders_silver", [dict(order_id="touched"), dict(order_id="new")], **ORDER)
    gold = table(spark, "order_analytics_gold", [
        dict(order_id="touched", filled_qty=40, fill_rate=0.4, avg_slippage_bps=1.5, avg_fill_price=10.0)])
    rows = by(sync_live_orders(live, live_order_source(orders, gold), NOW), "order_id")
    touched, new, gone = rows["touched"], rows["new"], rows["gone"]
    assert (touched.status, touched.filled_qty, touched.fill_rate) == ("PENDING", 40, 0.4)
    assert (touched.qty, touched.price_limit, touched.notional_value) == (7, 3.0, 21.0)
    assert touched.assigned_hedge_id == "5" and touched.last_updated == ts(NOW)
    assert (new.filled_qty, new.fill_rate, new.avg_slippage_bps) == (0, 0.0, 0.0)
    assert new.assigned_hedge_id is None and new.last_updated == ts(NOW)
    assert gone.last_updated == LIVE["last_updated"]


def test_fallback_and_first_table(spark):
    raw = table(spark, "raw_orders", [dict(order_id="a", qty=3), dict(order_id="b", price_limit=None)], **ORDER)
    live = as_live_orders(live_order_fallback(raw), NOW)
    assert live.columns == TABLES["live_orders"].columns
    rows = by(live, "order_id")
    assert rows["a"].notional_value == 30.0 and rows["b"].notional_value is None
    assert rows["a"].etf_name is None and rows["a"].fill_rate == 0.0


def test_text_rows_are_typed(spark):
    text = spark.createDataFrame(
        [("a", "12", "", "2024-01-02 03:04:05", None), ("b", "x", "1.5", None, "0.25")],
        "order_id string, qty string, price_limit string, created_at string, fill_rate string",
    )
    rows = by(parse_live_order_rows(text), "order_id")
    assert (rows["a"].qty, rows["a"].price_limit, rows["a"].fill_rate) == (12, None, 0.0)
    assert rows["a"].created_at == ts("2024-01-02 03:04:05")
    assert (rows["b"].qty, rows["b"].price_limit, rows["b"].fill_rate) == (0, 1.5, 0.25)
