import random
from datetime import timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeloom.plans.gold import (
    market_snapshot_gold,
    order_analytics_gold,
    trading_performance_gold,
)
from tapeloom.plans.silver import executions_silver, market_data_silver, orders_silver
from tapeloom.sources.dimensions import dimension
from tests.helpers import FILL, ORDER, TICK, by, table, ts

NOW = "2024-01-02 23:00:00"


def analytics(spark, orders, fills):
    raw = table(spark, "raw_orders", orders, **ORDER)
    execs = table(spark, "raw_executions", fills, **FILL)
    return order_analytics_gold(
        orders_silver(raw, dimension(spark, "etf_reference"), NOW), executions_silver(execs, raw)
    )


def test_order_analytics(spark):
    rows = by(analytics(
        spark,
        [dict(order_id="O1"), dict(order_id="bare"), dict(order_id="free", price_limit=None),
         dict(order_id="nolimit", price_limit=0.0)],
        [dict(exec_id="a", fill_qty=30, fill_price=10.01, exec_time=ts("2024-01-02 09:30:00")),
         dict(exec_id="b", fill_qty=90, fill_price=10.02, exec_time=ts("2024-01-02 09:10:00")),
         dict(exec_id="c", order_id="free"), dict(exec_id="d", order_id="nolimit"),
         dict(exec_id="e", order_id="stranger")],
    ), "order_id")
    assert set(rows) == {"O1", "bare", "free", "nolimit"}
    o = rows["O1"]
    assert (o.filled_qty, o.remaining_qty, o.fill_rate, o.fill_count) == (120, -20, 1.2, 2)
    assert o.avg_slippage_bps == 15.0
    assert o.total_fill_notional == 1202.1
    assert o.estimated_completion_pct == 120.0
    assert o.vwap_vs_limit == 15.0
    assert (o.first_fill_time, o.last_fill_time) == (
        ts("2024-01-02 09:10:00"), ts("2024-01-02 09:30:00"))
    bare = rows["bare"]
    assert (bare.filled_qty, bare.fill_rate, bare.fill_count) == (0, 0.0, None)
    assert bare.avg_slippage_bps == 0.0 and bare.vwap_vs_limit is None
    assert rows["free"].vwap_vs_limit is None and rows["nolimit"].vwap_vs_limit is None


def test_mean_slippage_rounds_ties_away_from_zero(spark):
    def mean(*prices):
        fills = [dict(exec_id=str(i), fill_price=p) for i, p in enumerate(prices)]
        return analytics(spark, [dict(order_id="O1", arrival_price=100.0)], fills).first().avg_slippage_bps

    assert mean(100.0001, 100.0002) == 0.02       # (0.01 + 0.02) / 2
    assert mean(99.9999, 99.9998) == -0.02
    zero = mean(99.9999, 100.0, 100.0)            # -0.01 / 3
    assert zero == 0.0 and str(zero) == "0.0"


def test_invariants_on_random_fills(spark):
    rng = random.Random(7)
    orders = [dict(order_id=f"O{i}", qty=rng.choice([100, 250])) for i in range(40)]
    fills = [
        dict(exec_id=str(i), order_id=f"O{rng.randrange(45)}", fill_qty=rng.randrange(0, 50),
             fill_price=rng.randrange(900, 1100) / 100)
        for i in range(300)
    ]
    rows = analytics(spark, orders, fills).collect()
    assert len(rows) == 40
    for r in rows:
        assert r.filled_qty + r.remaining_qty == r.qty and r.fill_rate >= 0
        assert r.filled_qty == sum(f["fill_qty"] for f in fills if f["order_id"] == r.order_id)


def snapshot(spark, *rows):
    silver = market_data_silver(table(spark, "raw_market_data", rows, **TICK))
    return by(market_snapshot_gold(silver, NOW), "ticker")


def test_snapshot(spark):
    rows = snapshot(
        spark,
        dict(event_id="1", event_time=ts("2024-01-01 15:00:00"), last_price=300.0, cum_volume=9_999),
        dict(event_id="2", event_time=ts("2024-01-02 09:00:00"), last_price=100.0, cum_volume=10),
        dict(event_id="3", event_time=ts("2024-01-02 10:00:00"), last_price=90.0, cum_volume=20),
        dict(event_id="4", event_time=ts("2024-01-02 11:00:00"), last_price=105.0, cum_volume=30),
        dict(event_id="5", ticker="QQQ", event_time=ts("2024-01-01 10:00:00")),
    )
    spy, qqq = rows["SPY"], rows["QQQ"]
    assert (spy.last_price, spy.open_price, spy.intraday_low, spy.intraday_high) == (105, 100, 90, 105)
    assert spy.total_volume == 30 and spy.price_change_pct == 5.0
    assert qqq.last_price == 100.0 and qqq.price_change_pct == 0.0
    assert (qqq.open_price, qqq.intraday_low, qqq.intraday_high, qqq.total_volume) == (None,) * 4


def test_snapshot_over_several_sources(spark):
    rows = snapshot(
        spark,
        dict(event_id="1", source="a", event_time=ts("2024-01-02 09:00:00"), last_price=100.0),
        dict(event_id="2", source="b", event_time=ts("2024-01-02 08:00:00"), last_price=80.0),
        dict(event_id="3", source="b", event_time=ts("2024-01-02 10:00:00"), last_price=120.0),
    )
    spy = rows["SPY"]
    assert (spy.source, spy.last_price, spy.open_price, spy.price_change_pct) == ("b", 120, 80, 50.0)


def test_snapshot_equals_its_ranking_form(spark):
    rng = random.Random(3)
    start = ts("2024-01-01 20:00:00")
    rows = [
        dict(event_id=f"{i:05d}", ticker=rng.choice(["SPY", "QQQ", "XLF"]), source=rng.choice("ab"),
             event_time=start + timedelta(minutes=rng.randrange(1200)),
             last_price=float(rng.randrange(80, 120)), cum_volume=rng.randrange(10_000))
        for i in range(600)
    ]
    silver = market_data_silver(table(spark, "raw_market_data", rows, **TICK))
    newest = Window.partitionBy("ticker").orderBy(F.desc("event_time"))
    latest = silver.withColumn("rn", F.row_number().over(newest)).where("rn = 1")
    today = silver.where("event_time >= TIMESTAMP '2024-01-02 00:00:00'").groupBy("ticker").agg(
        F.min("last_price").alias("low"), F.max("last_price").alias("high"),
        F.min_by("last_price", "event_time").alias("open"), F.max("cum_volume").alias("total"),
    )
    expected = {
        r.ticker: (r.event_time, r.last_price, r.source, r.volume, r.low, r.high, r.open, r.total)
        for r in latest.join(today, "ticker", "left").collect()
    }
    actual = {
        r.ticker: (r.event_time, r.last_price, r.source, r.volume, r.intraday_low, r.intraday_high,
                   r.open_price, r.total_volume)
        for r in market_snapshot_gold(silver, NOW).collect()
    }
    assert actual == expected


def test_trading_performance(spark):
    base = dict(trader_id="T1", created_at=ts("2024-01-02 10:00:00"), avg_slippage_bps=1.0,
                notional_value=100.0)
    gold = table(spark, "order_analytics_gold", [
        dict(order_id="a", status="FILLED", etf_ticker="SPY", fill_rate=1.0, total_fill_notional=90.5),
        dict(order_id="b", status="PENDING", etf_ticker="SPY", fill_rate=0.3333),
        dict(order_id="c", status="PARTIAL", etf_ticker="QQQ", fill_rate=0.5, notional_value=None),
        dict(order_id="d", status="CANCELLED", etf_ticker=None, fill_rate=0.0,
             created_at=ts("2024-01-03 00:00:00"), avg_slippage_bps=None),
    ], **base)
    rows = by(trading_performance_gold(gold), "trade_date")
    first, second = rows[ts("2024-01-02").date()], rows[ts("2024-01-03").date()]
    assert (first.total_orders, first.filled_orders, first.active_orders) == (3, 1, 2)
    assert first.fill_rate_pct == 33.33 and first.participation_rate == 61.11
    assert first.total_notional_usd == 200.0 and first.total_filled_notional_usd == 90.5
    assert first.unique_etfs_traded == 2
    assert second.avg_slippage_bps == 0.0 and second.unique_etfs_traded == 0
    assert second.total_filled_notional_usd is None
