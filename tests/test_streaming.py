import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tapeloom.operators.order_state import apply_order_actions
from tapeloom.plans import refresh
from tapeloom.plans.gold import market_snapshot_gold, order_analytics_gold, trading_performance_gold
from tapeloom.plans.silver import executions_silver, market_data_silver, orders_silver
from tapeloom.session import tune
from tapeloom.sources import layout as store
from tapeloom.sources.dimensions import dimension
from tapeloom.streaming.jobs import ONCE, apply_batch, start_actions, start_gold, start_silver
from tests.helpers import FILL, LIVE, ORDER, TICK, table, ts

NOW = "2024-01-02 23:00:00"


@pytest.fixture
def place(spark, tmp_path):
    where = store.Layout(str(tmp_path / "desk"))
    store.write_table(dimension(spark, "etf_reference"), where, "etf_reference")
    return where


def silver(spark, place, name, **kw):
    query = start_silver(spark, place, name, ONCE, as_of=NOW, **kw)
    query.awaitTermination()
    assert query.exception() is None
    return query


def refreshed(spark, place):
    for query in start_gold(spark, place, ONCE, as_of=NOW):
        query.awaitTermination()
        assert query.exception() is None


def same(left, right):
    columns = left.columns
    assert columns == right.columns
    key = lambda r: tuple(map(repr, r))
    assert sorted(left.collect(), key=key) == sorted(right.select(columns).collect(), key=key)


def tick_rows(n=300, seed=5):
    rng = random.Random(seed)
    start = ts("2024-01-01 22:00:00")
    return [
        dict(event_id=f"{i:04d}", ticker=rng.choice(["SPY", "QQQ", None]),
             event_time=start + timedelta(minutes=i // 3), last_price=float(rng.randrange(0, 5)),
             cum_volume=i)
        for i in range(n)
    ]


def append_ticks(spark, place, rows):
    # NULL tickers reach bronze only past the producer's schema.
    store.write_table(table(spark, "raw_market_data", rows, **TICK).coalesce(1), place, "raw_market_data")


def test_streamed_ticks_equal_the_batch(spark, place):
    rows = [r for r in tick_rows()]
    seen = set()
    unique = [r for r in rows if (k := (r["ticker"], r["event_time"])) not in seen and not seen.add(k)]
    # Duplicates repeat the same values, so that it does not matter which one is kept.
    twins = [{**r, "event_id": r["event_id"]} for r in unique[::4]]
    for part in range(0, len(unique), 60):
        append_ticks(spark, place, unique[part:part + 60] + [
            t for t in twins if t in unique[part:part + 60]])
        silver(spark, place, "market_data_silver")
    bronze = store.read_table(spark, place, "raw_market_data")
    assert bronze.count() > len(unique)
    same(store.read_table(spark, place, "market_data_silver"), market_data_silver(bronze))


def test_ticks_behind_the_watermark_are_dropped(spark, place):
    at = lambda text, i: dict(event_id=i, event_time=ts(f"2024-01-02 {text}"))
    append_ticks(spark, place, [at("10:00:00", "a")])
    silver(spark, place, "market_data_silver")
    append_ticks(spark, place, [at("10:10:00", "b")])
    silver(spark, place, "market_data_silver")
    append_ticks(spark, place, [at("10:07:59", "late"), at("10:08:01", "in time"), at("10:10:00", "again")])
    query = silver(spark, place, "market_data_silver")
    kept = store.read_table(spark, place, "market_data_silver")
    assert sorted(r.event_id for r in kept.collect()) == ["a", "b", "in time"]
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_orders_fills_and_gold(spark, place):
    rng = random.Random(11)
    orders = [dict(order_id=f"O{i}", qty=rng.choice([0, 100, 200]), price_limit=rng.choice([None, 10.0]))
              for i in range(30)]
    fills = [dict(exec_id=str(i), order_id=f"O{rng.randrange(33)}", fill_qty=rng.randrange(0, 40),
                  fill_price=rng.randrange(36, 44) / 4) for i in range(120)]
    store.write_table(table(spark, "raw_orders", orders, **ORDER), place, "raw_orders")
    for part in (fills[:50], fills[50:51], fills[51:]):
        store.write_table(table(spark, "raw_executions", part, **FILL), place, "raw_executions")
        append_ticks(spark, place, [dict(
            event_id=part[0]["exec_id"], last_price=float(len(part)),
            event_time=ts("2024-01-02 10:00:00") + timedelta(minutes=int(part[0]["exec_id"])))])
        for name in ("orders_silver", "executions_silver", "market_data_silver"):
            silver(spark, place, name)
        refreshed(spark, place)
    raw_orders = store.read_table(spark, place, "raw_orders")
    o = orders_silver(raw_orders, dimension(spark, "etf_reference"), NOW)
    x = executions_silver(store.read_table(spark, place, "raw_executions"), raw_orders)
    gold = order_analytics_gold(o, x)
    same(store.read_table(spark, place, "order_analytics_gold"), gold)
    same(store.read_table(spark, place, "trading_performance_gold"), trading_performance_gold(gold))
    ticks = market_data_silver(store.read_table(spark, place, "raw_market_data"))
    same(store.read_table(spark, place, "market_snapshot_gold"), market_snapshot_gold(ticks, NOW))
    assert len(store.versions(spark, place, "order_analytics_gold")) == 3


def test_incremental_snapshot_equals_the_full_one(spark, place):
    tick = lambda i, when, **kw: dict(event_id=i, event_time=ts(when), **kw)
    first = [tick("1", "2024-01-01 10:00:00", ticker="OLD"), tick("2", "2024-01-01 11:00:00"),
             tick("3", "2024-01-02 09:00:00", last_price=90.0)]
    second = [tick("4", "2024-01-01 23:00:00", ticker="OLD", last_price=7.0),
              tick("5", "2024-01-02 12:00:00", last_price=95.0), tick("6", "2024-01-01 05:00:00", ticker="NEW")]
    full = lambda rows: market_data_silver(table(spark, "raw_market_data", rows, **TICK))
    store.write_batch(full(first), place, "market_data_silver", 0)
    refresh.refresh_market_snapshot(spark, place, as_of="2024-01-01 23:00:00")
    store.write_batch(full(second), place, "market_data_silver", 1)
    refresh.refresh_market_snapshot(spark, place, full(second), NOW)
    same(store.read_table(spark, place, "market_snapshot_gold"), market_snapshot_gold(full(first + second), NOW))


def test_a_fill_before_its_order_heals_on_rebuild(spark, place):
    store.write_table(table(spark, "raw_orders", [dict(order_id="other")], **ORDER), place, "raw_orders")
    store.write_table(table(spark, "raw_executions", [dict(exec_id="x", fill_price=11.0)], **FILL), place, "raw_executions")
    append_ticks(spark, place, [dict(event_id="t")])
    silver(spark, place, "executions_silver")
    early = store.read_table(spark, place, "executions_silver").first()
    assert early.etf_ticker is None and early.slippage_bps == 0.0
    store.write_table(table(spark, "raw_orders", [dict(order_id="O1")], **ORDER), place, "raw_orders")
    # The static side is read anew: a later fill of the new order is enriched.
    store.write_table(table(spark, "raw_executions", [dict(exec_id="y", fill_price=11.0)], **FILL), place, "raw_executions")
    silver(spark, place, "executions_silver")
    rows = {r.exec_id: r.slippage_bps for r in store.read_table(spark, place, "executions_silver").collect()}
    assert rows == {"x": 0.0, "y": 1000.0}
    refresh.rebuild_silver(spark, place, NOW)
    rows = {r.exec_id: r.slippage_bps for r in store.read_table(spark, place, "executions_silver").collect()}
    assert rows == {"x": 1000.0, "y": 1000.0}


def action_rows(n=200):
    rng = random.Random(2)
    kinds = ["ADJUST_SIZE"] * 5 + ["ADJUST_PRICE"] * 5 + ["HEDGE"] * 3 + ["CANCEL", "EXECUTE"]
    return [
        dict(action_id=i, action_type=rng.choice(kinds), order_id=f"O{rng.randrange(22)}",
             qty=rng.choice([0, 100, 200]), price_limit=rng.choice([0.0, 9.5, 11.25]), trader_id="T1",
             instrument_id="ES", direction="SELL", hedge_type="FUTURES",
             ts=ts("2024-01-02 10:00:00") + timedelta(minutes=7 * i))
        for i in range(n)
    ]


def start_book(spark, place):
    live = table(spark, "live_orders", [dict(order_id=f"O{i}") for i in range(20)], **LIVE)
    prices = table(spark, "market_snapshot_gold", [dict(ticker="SPY", last_price=10.25)])
    store.write_version(live, place, "live_orders")
    store.write_version(prices, place, "market_snapshot_gold")
    return live, prices


def test_actions_in_several_batches_equal_one_batch(spark, place):
    live, prices = start_book(spark, place)
    rows = action_rows()
    for part in (rows[:80], rows[80:130], rows[130:]):
        store.write_table(table(spark, "actions", part), place, "actions")
        query = start_actions(spark, place, ONCE)
        query.awaitTermination()
        assert query.exception() is None
    whole = apply_order_actions(live, table(spark, "actions", rows), prices)
    same(store.read_table(spark, place, "live_orders"), whole.live_orders)
    same(store.read_table(spark, place, "hedge_requests"), whole.hedge_requests)
    same(store.read_table(spark, place, "rejected_actions"), whole.rejected)
    same(store.read_table(spark, place, "order_actions"), whole.audit)
    assert store.versions(spark, place, "live_orders") == [1, 2, 3]


def test_a_retried_batch_of_actions_changes_nothing(spark, place):
    start_book(spark, place)
    acts = table(spark, "actions", action_rows(60))
    apply_batch(spark, place, acts, 0)
    tables = ("live_orders", "order_actions", "rejected_actions", "hedge_requests")
    before = {t: sorted(map(str, store.read_table(spark, place, t).collect())) for t in tables}
    apply_batch(spark, place, acts, 0)
    after = {t: sorted(map(str, store.read_table(spark, place, t).collect())) for t in tables}
    assert before == after and store.versions(spark, place, "live_orders") == [0, 1]


def test_unknown_stream(spark, place):
    with pytest.raises(ValueError):
        start_silver(spark, place, "order_analytics_gold")
    with pytest.raises(ValueError):
        store.read_stream(spark, place, "live_orders")


def test_state_stores_do_not_count_their_rows(spark):
    """A count takes a lookup before each write of a row into the state."""
    assert tune(spark, streaming=True).conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"


def test_state_stores_share_a_bound(spark):
    """Without one, each store of an executor fills write buffers of its own."""
    conf = tune(spark, streaming=True).conf
    assert conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "false") == "true"
    assert int(conf.get("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "500")) <= 256
