import pytest

from tapeloom.operators.quality import TICK_RULES, expect_or_drop, expectation_metrics
from tapeloom.plans.silver import (
    enriched_ticks,
    executions_silver,
    market_data_silver,
    orders_silver,
    unique_ticks,
)
from tapeloom.sources.dimensions import dimension
from tests.helpers import FILL, ORDER, TICK, by, table, ts

NOON = "2024-01-02 12:00:00"


def ticks(spark, *rows):
    return table(spark, "raw_market_data", rows, **TICK)


def test_tick_metrics(spark):
    row = market_data_silver(ticks(spark, dict(event_id="a", vwap=99.0))).first()
    assert row.mid_price == 100.0
    assert row.spread_bps == 200.0
    assert row.relative_volume == 0.5
    assert row.price_move_pct == 1.0101


def test_duplicate_ticks_keep_the_smallest_id(spark):
    kept = unique_ticks(ticks(
        spark, dict(event_id="b", bid=1.0), dict(event_id="a", bid=2.0), dict(event_id="c", bid=3.0),
        dict(event_id="d", event_time=ts("2024-01-02 10:00:01")),
    ))
    assert sorted((r.event_id, r.bid) for r in kept.collect()) == [("a", 2.0), ("d", 99.0)]


def test_a_bad_survivor_takes_its_good_twin_with_it(spark):
    rows = ticks(spark, dict(event_id="a", last_price=0.0), dict(event_id="b"))
    assert market_data_silver(rows).count() == 0


@pytest.mark.parametrize("bad", [
    dict(ticker=None), dict(last_price=0.0), dict(last_price=-1.0), dict(last_price=None),
    dict(ask=98.0), dict(ask=None), dict(bid=None),
])
def test_bad_ticks_are_dropped(spark, bad):
    assert market_data_silver(ticks(spark, dict(event_id="a", **bad))).count() == 0


def test_divisors_and_unknown_tickers(spark):
    rows = by(enriched_ticks(ticks(
        spark, dict(event_id="zero", last_price=0.0, vwap=0.0),
        dict(event_id="unknown", ticker="ZZZ"), dict(event_id="none", ticker=None),
    )), "event_id")
    assert rows["zero"].spread_bps is None and rows["zero"].price_move_pct is None
    assert rows["unknown"].relative_volume is None
    assert rows["none"].relative_volume is None


def test_orders(spark):
    raw = table(spark, "raw_orders", [
        dict(order_id="known", price_limit=10.125),
        dict(order_id="unknown", etf_ticker="ZZZ", price_limit=None),
        dict(order_id="no ticker", etf_ticker=None),
        dict(order_id=None), dict(order_id="zero", qty=0), dict(order_id="missing", qty=None),
        dict(order_id="negative", qty=-5),
    ], **ORDER)
    rows = by(orders_silver(raw, dimension(spark, "etf_reference"), NOON), "order_id")
    assert set(rows) == {"known", "unknown", "no ticker"}
    known, unknown = rows["known"], rows["unknown"]
    assert known.etf_name == "SPDR S&P 500 ETF Trust" and known.aum_bn == 530.2
    assert known.notional_value == 1012.5
    assert known.time_in_market_sec == 3 * 3600
    assert unknown.etf_name is None and unknown.sector is None
    assert unknown.notional_value is None


def test_order_age_defaults_to_now(spark):
    raw = table(spark, "raw_orders", [dict(order_id="a")], **ORDER)
    assert orders_silver(raw, dimension(spark, "etf_reference")).first().time_in_market_sec > 10**7


def test_executions(spark):
    orders = table(spark, "raw_orders", [
        dict(order_id="O1"), dict(order_id="O2", arrival_price=None),
        dict(order_id="O3", arrival_price=0.0), dict(order_id="S", direction="SELL"),
    ], **ORDER)
    fills = table(spark, "raw_executions", [
        dict(exec_id="up", fill_price=10.01), dict(exec_id="down", fill_price=9.99),
        dict(exec_id="no arrival", order_id="O2"), dict(exec_id="zero arrival", order_id="O3"),
        dict(exec_id="orphan", order_id="none"), dict(exec_id="null order", order_id=None),
        dict(exec_id="sell", order_id="S", fill_price=10.01),
        dict(exec_id=None), dict(exec_id="empty", fill_qty=0), dict(exec_id="none", fill_qty=None),
    ], **FILL)
    rows = by(executions_silver(fills, orders), "exec_id")
    assert {k: r.slippage_bps for k, r in rows.items()} == {
        "up": 10.0, "down": -10.0, "no arrival": 0.0, "zero arrival": 0.0, "orphan": 0.0,
        "null order": 0.0, "sell": 10.0,
    }
    assert rows["up"].fill_notional == 100.1 and rows["up"].qty == 100
    assert rows["orphan"].etf_ticker is None and rows["orphan"].qty is None
    signed = by(executions_silver(fills, orders, signed=True), "exec_id")
    assert signed["sell"].slippage_bps == -10.0 and signed["up"].slippage_bps == 10.0


def test_duplicate_orders_fan_out(spark):
    orders = table(spark, "raw_orders", [dict(order_id="O1"), dict(order_id="O1")], **ORDER)
    fills = table(spark, "raw_executions", [dict(exec_id="x")], **FILL)
    assert executions_silver(fills, orders).count() == 2


def test_empty_inputs(spark):
    orders = table(spark, "raw_orders", [])
    assert orders_silver(orders, dimension(spark, "etf_reference")).count() == 0
    assert executions_silver(table(spark, "raw_executions", []), orders).count() == 0
    assert market_data_silver(table(spark, "raw_market_data", [])).count() == 0


def test_expectation_metrics_agree_with_the_filter(spark):
    rows = enriched_ticks(ticks(
        spark, dict(event_id="ok"), dict(event_id="a", ticker=None),
        dict(event_id="b", ticker="QQQ", last_price=None),
        dict(event_id="c", ticker="IVV", last_price=0.0, ask=1.0),
    ))
    metrics = by(expectation_metrics(rows, TICK_RULES), "rule")
    assert {k: (m.passed, m.failed) for k, m in metrics.items()} == {
        "valid_ticker": (3, 1), "valid_price": (2, 2), "valid_spread": (3, 1),
    }
    assert {m.kept for m in metrics.values()} == {expect_or_drop(rows, TICK_RULES).count()} == {1}
