import pytest
from pyspark.sql import functions as F

from tapeloom.functions.columns import half_up, half_up_value
from tapeloom.operators.hedging import hedge_suggestions
from tapeloom.plans import kpis, read_models
from tapeloom.sources.dimensions import dimension
from tests.helpers import LIVE, ORDER, TICK, by, table, ts

GOLD = dict(trader_id="T1", etf_ticker="SPY", strategy="VWAP", status="PENDING", order_type="LIMIT",
            qty=100, filled_qty=50, fill_rate=0.5, avg_slippage_bps=2.0, notional_value=1000.0,
            created_at=ts("2024-01-02 09:00:00"))


def gold(spark, *rows):
    return table(spark, "order_analytics_gold", rows, **GOLD)


def live(spark, *rows):
    return table(spark, "live_orders", rows, **LIVE)


def test_active_orders_without_analytics_show_zeros(spark):
    orders = table(spark, "orders_silver", [
        dict(order_id="a"), dict(order_id="b", created_at=ts("2024-01-03 09:00:00"))], **ORDER)
    rows = read_models.active_orders(orders, gold(spark, dict(order_id="a"))).collect()
    assert [r.order_id for r in rows] == ["b", "a"]
    assert (rows[0].filled_qty, rows[0].fill_rate_pct, rows[0].avg_slippage_bps) == (0, 0.0, 0.0)
    assert (rows[1].filled_qty, rows[1].fill_rate_pct) == (50, 50.0)


def test_blotter_filters_and_order(spark):
    orders = live(
        spark, dict(order_id="b"), dict(order_id="a"), dict(order_id="q", etf_ticker="QQQ"),
        dict(order_id="n", created_at=ts("2024-01-09 00:00:00")), dict(order_id="f", status="FILLED"))
    ids = lambda *args, **kw: [r.order_id for r in read_models.order_blotter(orders, *args, **kw).collect()]
    assert ids() == ["n", "a", "b", "f", "q"]
    assert ids("PENDING,PARTIAL", "SPY") == ["n", "a", "b"]
    assert ids(["FILLED"]) == ["f"]
    assert ids("", None, 2) == ["n", "a"]
    assert ids("nothing") == []
    assert len(ids(limit=None)) == 5


def test_search(spark):
    df = table(spark, "orders_silver", [
        dict(order_id="ORD-1", strategy=None), dict(order_id="x", etf_ticker="sPyX", strategy="IS"),
        dict(order_id="y", etf_ticker="QQQ", trader_id="T-spy", strategy="IS"),
        dict(order_id="z", etf_ticker=None, trader_id=None, strategy=None)], **ORDER)
    ids = lambda term: sorted(r.order_id for r in read_models.search_orders(df, term).collect())
    assert ids("SPY") == ["ORD-1", "x", "y"]
    assert ids("ord-") == ["ORD-1"]
    assert len(ids("")) == len(ids(None)) == 4
    assert ids("%") == [] and ids("'") == []


def test_sort_puts_missing_values_last_both_ways(spark):
    df = table(spark, "orders_silver", [
        dict(order_id="1", strategy="b"), dict(order_id="2", strategy="A"),
        dict(order_id="3", strategy=None), dict(order_id="4", strategy="C")], **ORDER)
    ids = lambda *args: [r.order_id for r in read_models.sort_orders(df, *args).collect()]
    assert ids("strategy", "asc") == ["2", "1", "4", "3"]
    assert ids("strategy", "desc") == ["4", "1", "2", "3"]
    assert ids("qty", "asc") == ["1", "2", "3", "4"]
    with pytest.raises(ValueError):
        ids("qty", "up")


def test_status_tabs(spark):
    orders = live(spark, dict(order_id="a"), dict(order_id="b", status="FILLED"),
                  dict(order_id="c", status="FILLED"), dict(order_id="d", status="ODD"))
    counts = {r.status: r.orders for r in kpis.status_counts(orders).collect()}
    assert counts == {"ALL": 4, "PENDING": 1, "PARTIAL": 0, "FILLED": 2, "CANCELLED": 0}
    assert [r.status for r in kpis.orders_by_status(orders).collect()] == ["FILLED", "ODD", "PENDING"]
    assert read_models.status_tab(orders).count() == 4
    assert read_models.status_tab(orders, "FILLED").count() == 2
    assert read_models.actionable_orders(orders).count() == 2
    assert read_models.open_orders(orders).count() == 1


def test_enriched_blotter(spark):
    orders = live(
        spark, dict(order_id="both", filled_qty=1), dict(order_id="own", filled_qty=25),
        dict(order_id="over"), dict(order_id="zero", qty=0, filled_qty=5), dict(order_id="none"))
    analytics = gold(
        spark, dict(order_id="both", avg_slippage_bps=-1.5),
        dict(order_id="over", fill_rate=1.5, avg_slippage_bps=3.5),
        dict(order_id="over", fill_rate=1.25, created_at=ts("2020-01-01 00:00:00"), avg_slippage_bps=0.0))
    rows = by(read_models.blotter_enriched(orders, analytics), "order_id")
    assert {k: (r.fill_pct, r.fill_bar_pct, r.slippage_band) for k, r in rows.items()} == {
        "both": (50.0, 50.0, "good"), "own": (25.0, 25.0, "none"),
        "over": (125.0, 100.0, "neutral"), "zero": (0.0, 0.0, "none"), "none": (0.0, 0.0, "none")}


def test_price_history(spark):
    ticks = table(spark, "raw_market_data", [
        dict(event_id=f"{h:02d}", event_time=ts(f"2024-01-02 {h:02d}:00:00"), last_price=100.0 + h)
        for h in range(10)
    ] + [dict(event_id="q", ticker="QQQ")], **TICK)
    now = "2024-01-02 12:00:00"
    prices = lambda **kw: [r.last_price - 100 for r in read_models.price_history(ticks, now, **kw).collect()]
    assert prices() == [4, 5, 6, 7, 8, 9]
    assert prices(hours=3) == [9]
    assert prices(limit=2) == [4, 5]
    assert prices(limit=2, latest=True) == [8, 9]
    assert prices(limit=None, latest=True) == prices(limit=None) == [4, 5, 6, 7, 8, 9]
    assert prices(ticker="'; --") == []
    day = read_models.price_history_day(ticks, "2024-01-03 05:30:00").collect()
    assert [(r.ticker, r.event_time.hour) for r in day] == [
        ("QQQ", 10), ("SPY", 6), ("SPY", 7), ("SPY", 8), ("SPY", 9)]
    bounds = kpis.price_bounds(read_models.price_history(ticks, now)).first()
    assert (bounds.min_price, bounds.max_price) == (104 * 0.9995, 109 * 1.0005)


def test_price_bounds_ignore_zero_prices(spark):
    ticks = table(spark, "raw_market_data", [dict(event_id="a", last_price=0.0), dict(event_id="b")], **TICK)
    assert kpis.price_bounds(ticks).first().min_price == 100 * 0.9995
    assert kpis.price_bounds(ticks.where("false")).first().min_price is None


def test_latest_raw_tick_settles_ties_by_id(spark):
    ticks = table(spark, "raw_market_data", [
        dict(event_id="a", bid=1.0), dict(event_id="c", bid=3.0), dict(event_id="b", bid=2.0),
        dict(event_id="z", event_time=ts("2020-01-01 00:00:00"))], **TICK)
    row = read_models.latest_raw_tick(ticks).first()
    assert (row.bid, row.total_volume) == (3.0, 1_000)


def test_market_ticker(spark):
    snap = table(spark, "market_snapshot_gold", [
        dict(ticker="A", price_change_pct=-0.5), dict(ticker="B", price_change_pct=None),
        dict(ticker="C", price_change_pct=float("nan"))])
    rows = by(read_models.market_ticker(snap), "ticker")
    assert {k: (r.change_pct, r.is_up) for k, r in rows.items()} == {
        "A": (-0.5, False), "B": (0.0, True), "C": (0.0, True)}


def test_trader_listing_keeps_unknown_traders(spark):
    days = table(spark, "trading_performance_gold", [
        dict(trader_id="T001", trade_date=ts("2024-01-01").date(), total_notional_usd=1.0),
        dict(trader_id="T???", trade_date=ts("2024-01-01").date(), total_notional_usd=2.0),
        dict(trader_id="T002", trade_date=ts("2024-01-02").date(), total_notional_usd=0.0)])
    rows = read_models.trader_listing(days, dimension(spark, "traders")).collect()
    assert [(r.trader_id, r.trader_name, r.desk) for r in rows] == [
        ("T002", "Maria Santos", "Index Arb"), ("T???", None, None),
        ("T001", "Alex Chen", "ETF Execution")]
    assert [r.trader_id for r in read_models.performance_feed(days).collect()] == ["T002", "T001", "T???"]


def test_hedge_listing(spark):
    rows = read_models.hedge_listing(dimension(spark, "hedge_instruments")).collect()
    assert [(r.type, r.underlying) for r in rows] == sorted((r.type, r.underlying) for r in rows)
    assert len(rows) == 8 and rows[0].instrument_id == "NQ_JUN26"


def test_scatter_points(spark):
    rows = gold(
        spark, dict(order_id="a", fill_rate=0.12345, avg_slippage_bps=-0.25, strategy=""),
        dict(order_id="b", fill_rate=None), dict(order_id="c", strategy=None))
    points = read_models.fill_vs_slippage(rows).collect()
    assert [(p.order_id, p.x, p.y, p.strategy) for p in points] == [
        ("a", 12.3, -0.2, "UNKNOWN"), ("c", 50.0, 2.0, "UNKNOWN")]
    assert read_models.fill_vs_slippage(rows, 1).count() == 1


def test_half_up_on_negative_ties(spark):
    df = spark.createDataFrame([(-25, 100), (25, 100), (-35, 100), (0, 3), (1, 0)], "n bigint, d bigint")
    assert [r.r for r in df.select(half_up(F.col("n"), F.col("d"), 1).alias("r")).collect()] == [
        -0.2, 0.3, -0.3, 0.0, None]
    values = spark.createDataFrame([(-0.25,), (0.25,)], "x double")
    assert [r.r for r in values.select(half_up_value(F.col("x")).alias("r")).collect()] == [-0.2, 0.3]


def test_kpis(spark):
    orders = live(spark, dict(order_id="a"), dict(order_id="b", status="PARTIAL"),
                  dict(order_id="c", status="FILLED", created_at=ts("2024-01-05 00:00:00")))
    analytics = gold(
        spark, dict(order_id="a", avg_slippage_bps=-0.5, fill_rate=0.25),
        dict(order_id="b", avg_slippage_bps=None, fill_rate=None),
        dict(order_id="c", avg_slippage_bps=20.0, fill_rate=1.0, created_at=ts("2024-01-05 00:00:00")))
    row = kpis.kpi_row(orders, analytics).first()
    assert (row.active_count, row.fill_rate, row.avg_slippage, row.participation_rate) == (2, 33.3, 6.5, 41.7)
    assert (row.slippage_grade, row.slippage_side) == ("bad", "vs arrival")
    top = kpis.kpi_row(orders, analytics, limit=(1, 1)).first()
    assert (top.active_count, top.fill_rate, top.avg_slippage) == (0, 100.0, 20.0)
    none = kpis.kpi_row(orders.where("false"), analytics.where("false")).first()
    assert (none.active_count, none.fill_rate, none.avg_slippage, none.participation_rate) == (0, 0.0, 0.0, 0.0)


def test_by_strategy(spark):
    rows = kpis.by_strategy(gold(
        spark, dict(order_id="a", strategy=None, fill_rate=1.0), dict(order_id="b", strategy=""),
        dict(order_id="c", fill_rate=0.1, avg_slippage_bps=-0.25))).collect()
    assert [(r.strategy, r.total, r.fill_rate, r.avg_slippage) for r in rows] == [
        ("UNKNOWN", 2, 75.0, 2.0), ("VWAP", 1, 10.0, -0.2)]


def test_charts(spark):
    analytics = gold(spark, dict(order_id="a"), dict(order_id="b", etf_ticker="QQQ", avg_slippage_bps=1.0),
                     dict(order_id="c", avg_slippage_bps=None, order_type="MKT", fill_rate=None))
    listing = read_models.execution_listing(analytics)
    assert {r.etf_ticker: r.avg_slippage_bps for r in kpis.slippage_by_etf(listing).collect()} == {
        "SPY": 2.0, "QQQ": 1.0}
    assert {r.order_type: r.avg_fill_rate_pct for r in kpis.fill_by_type(listing).collect()} == {
        "LIMIT": 50.0, "MKT": None}
    active = table(spark, "orders_silver", [
        dict(order_id="a"), dict(order_id="b", created_at=ts("2024-01-02 09:30:00")),
        dict(order_id="c", strategy=None)], **ORDER)
    assert sorted(r.orders for r in kpis.orders_over_time(active).collect()) == [1, 1, 1]
    assert sorted(r.orders for r in kpis.orders_over_time(active, "hour").collect()) == [1, 2]


def test_counters(spark):
    analytics = gold(spark, dict(order_id="a"), dict(order_id="b", status="FILLED", fill_rate=1.0))
    orders = table(spark, "orders_silver", [dict(order_id="a", notional_value=2.5e6)], **ORDER)
    row = kpis.dashboard_counters(
        read_models.active_orders(orders, analytics), read_models.execution_listing(analytics)).first()
    assert row.asDict() == dict(
        active_orders=1, total_notional_musd=2.5, avg_fill_rate_pct=75.0, avg_slippage_bps=2.0,
        filled_notional_usd=2000.0, total_orders=2)


def test_hedge_suggestions(spark):
    orders = live(
        spark, dict(order_id="a", qty=1000, price_limit=10.0),
        dict(order_id="b", qty=1000, price_limit=None, direction="SELL"),
        dict(order_id="c", qty=None), dict(order_id="z", etf_ticker="ZZZ"))
    rows = {(r.order_id, r.instrument_id): r for r in hedge_suggestions(
        orders, dimension(spark, "hedge_instruments")).collect()}
    assert len(rows) == 15
    future, option = rows["a", "ES_MAR26"], rows["a", "SPY_P510_MAR26"]
    assert (future.hedge_direction, future.suggested_qty, future.hedge_ratio_pct) == ("SELL", 20, 100)
    assert future.delta_offset == 1000.0
    assert (option.suggested_qty, option.hedge_ratio_pct, option.delta_offset) == (23, 230, 1035.0)
    assert rows["b", "ES_MAR26"].suggested_qty == 1 and rows["b", "ES_MAR26"].hedge_direction == "BUY"
    assert rows["c", "SPY_P510_MAR26"].suggested_qty == 1
    assert rows["c", "SPY_P510_MAR26"].hedge_ratio_pct == 10_000
    only_options = hedge_suggestions(orders, dimension(spark, "hedge_instruments"), "OPTIONS")
    assert {r.hedge_type for r in only_options.collect()} == {"OPTIONS"}


def test_hedge_defaults(spark):
    orders = live(spark, dict(order_id="a", qty=1000, price_limit=10.0))
    instruments = table(spark, "hedge_instruments", [
        dict(instrument_id="f", type="FUTURES", underlying="SPY"),
        dict(instrument_id="o", type="OPTIONS", underlying="SPY", delta=0.0)])
    rows = by(hedge_suggestions(orders, instruments), "instrument_id")
    assert (rows["f"].suggested_qty, rows["f"].hedge_ratio_pct, rows["f"].delta_offset) == (20, 2, None)
    assert (rows["o"].suggested_qty, rows["o"].delta_offset) == (34, 0.0)
