"""Bucket tables, gold by batch, fills matched in state, live orders with one writer."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tapeloom.operators.order_state import apply_order_actions
from tapeloom.plans import incremental
from tapeloom.plans.gold import order_analytics_gold, trading_performance_gold
from tapeloom.plans.silver import executions_silver, orders_silver
from tapeloom.sources import layout as store
from tapeloom.sources.buckets import BucketTable
from tapeloom.sources.dimensions import dimension
from tapeloom.streaming import matching
from tapeloom.streaming.incremental import start_matched_executions, start_order_gold
from tapeloom.streaming.jobs import ONCE
from tapeloom.streaming.live import apply_live_batch, live_table, read_live_orders, start_live_orders
from tests.helpers import FILL, LIVE, ORDER, table, ts

NOW = "2024-01-02 23:00:00"


@pytest.fixture
def place(tmp_path):
    return store.Layout(str(tmp_path / "desk"))


def rows(df):
    return sorted(map(repr, df.collect()))


def folders(spark, buckets):
    return {(bucket, n) for bucket, numbers in buckets.batches(spark).items() for n in numbers}


def silver_tables(spark, n_orders=40, n_fills=200, seed=3):
    rng = random.Random(seed)
    orders = [
        dict(order_id=f"O{i}", qty=rng.choice([100, 200]), price_limit=rng.choice([None, 0.0, 10.0]), trader_id=f"T{i % 3}",
             etf_ticker=rng.choice(["SPY", "QQQ", None]), status=rng.choice(["FILLED", "PENDING", "CANCELLED"]),
             created_at=ts("2024-01-01 09:00:00") + timedelta(days=i % 2))
        for i in range(n_orders)
    ]
    fills = [
        dict(exec_id=str(i), order_id=f"O{rng.randrange(n_orders + 5)}", fill_qty=rng.randrange(1, 40), fill_price=rng.choice([None, 9.25, 10.5]))
        for i in range(n_fills)
    ]
    raw = table(spark, "raw_orders", orders, **ORDER)
    o = orders_silver(raw, dimension(spark, "etf_reference"), NOW)
    return o, executions_silver(table(spark, "raw_executions", fills, **FILL), raw)


def test_gold_by_batch_equals_the_whole(spark, place):
    orders, fills = silver_tables(spark)
    part = lambda df, key, k: df.where(F.pmod(F.xxhash64(key), F.lit(3)) == k)
    batches = [
        (None, part(fills, "exec_id", 0)), (part(orders, "order_id", 0), None), (part(orders, "order_id", 1), part(fills, "exec_id", 1)),
        (None, part(fills, "exec_id", 2)), (part(orders, "order_id", 2), None),
    ]
    for number, batch in enumerate(batches):
        incremental.apply_changes(spark, place, incremental.changes_of(*batch), number, 4)
    gold = order_analytics_gold(orders, fills)
    assert rows(incremental.read_order_analytics(spark, place)) == rows(gold)
    assert rows(incremental.read_trading_performance(spark, place)) == rows(trading_performance_gold(gold))


def test_a_batch_on_one_order_reads_and_writes_one_bucket(spark, place):
    orders, fills = silver_tables(spark)
    incremental.apply_changes(spark, place, incremental.changes_of(orders, fills), 0, 8)
    tables = [t(place, 8) for t in (incremental.order_sums, incremental.trader_day_sums, incremental.trader_day_rows)]
    before = [folders(spark, t) for t in tables]
    one = table(spark, "executions_silver", [dict(exec_id="new", order_id="O7", fill_qty=5, fill_price=10.0, fill_notional=50.0, slippage_bps=1.5)])
    incremental.apply_changes(spark, place, incremental.changes_of(executions=one), 1, 8)
    for t, known in zip(tables, before, strict=True):
        (added,) = folders(spark, t) - known
        assert added[1] == 1
    (bucket,) = tables[0].touched(one)
    files = tables[0].read(spark, [bucket], 1).inputFiles()
    assert files and all(f"bucket={bucket}/batch=0" in f for f in files)
    gold = order_analytics_gold(orders, fills.unionByName(one))
    assert rows(incremental.read_order_analytics(spark, place)) == rows(gold)
    assert rows(incremental.read_trading_performance(spark, place)) == rows(trading_performance_gold(gold))
    assert rows(incremental.order_progress(spark, place, ["O7"], 8)) == rows(gold.where("order_id = 'O7'"))


def test_traders_days_that_stay_as_they_are_are_not_written(spark, place):
    """An order that arrives again as it was: its bucket is written, and what it takes off and adds cancels out."""
    orders, fills = silver_tables(spark)
    incremental.apply_changes(spark, place, incremental.changes_of(orders, fills), 0, 8)
    before = rows(incremental.read_trading_performance(spark, place))
    incremental.apply_changes(spark, place, incremental.changes_of(orders.where("order_id = 'O7'")), 1, 8)
    assert {n for _, n in folders(spark, incremental.trader_day_rows(place, 8))} == {0}
    assert rows(incremental.read_trading_performance(spark, place)) == before


def test_a_batch_of_gold_joins_nothing(spark, place, monkeypatch):
    """The sums of touched buckets are compared as they are read, without a shuffle of their rows for a join."""
    plans, write = [], BucketTable.write
    monkeypatch.setattr(BucketTable, "write", lambda t, df, batch: (plans.append(df._jdf.queryExecution().toString()), write(t, df, batch))[1])
    orders, fills = (spark.createDataFrame(df.collect(), df.schema) for df in silver_tables(spark))
    incremental.apply_changes(spark, place, incremental.changes_of(orders, fills), 0, 4)
    incremental.apply_changes(spark, place, incremental.changes_of(executions=fills), 1, 4)
    assert len(plans) == 6 and not any("Join" in p for p in plans)


@pytest.mark.parametrize("spread", [False, True])
def test_a_large_bucket_is_written_by_several_tasks(spark, place, monkeypatch, spread):
    t = BucketTable(place, "t", ("k",), "k string, v string", 1)
    df = spark.range(0, 40000, 1, 8).selectExpr("CAST(id AS STRING) AS k", "sha2(CAST(id AS STRING), 256) AS v")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        t.write(t.spread(df, [0]) if spread else df, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(t.read(spark).inputFiles()) > 1 and rows(t.read(spark)) == rows(df)


def test_a_retried_batch_adds_nothing(spark, place):
    orders, fills = silver_tables(spark)
    early, late = fills.where("exec_id % 2 = 0"), fills.where("exec_id % 2 = 1")
    incremental.apply_changes(spark, place, incremental.changes_of(orders, early), 0, 4)
    for _ in range(2):
        incremental.apply_changes(spark, place, incremental.changes_of(executions=late), 1, 4)
    gold = order_analytics_gold(orders, fills)
    assert rows(incremental.read_order_analytics(spark, place)) == rows(gold)
    assert rows(incremental.read_trading_performance(spark, place)) == rows(trading_performance_gold(gold))
    with pytest.raises(RuntimeError, match="another query"):
        incremental.apply_changes(spark, place, incremental.changes_of(executions=late), 0, 4)


def test_old_folders_go(spark, place):
    t = BucketTable(place, "t", ("k",), "k string, v int", 1)
    for batch in range(5):
        t.write(spark.createDataFrame([("a", batch)], "k string, v int"), batch)
    t.drop_old(spark, keep=2)
    assert folders(spark, t) == {(0, 3), (0, 4)}
    assert t.read(spark).collect() == [("a", 4)] and t.read(spark, [0], 4).collect() == [("a", 3)]
    assert t.read(spark, [0], 0).collect() == []


def test_an_empty_batch_changes_nothing(spark, place):
    orders, fills = silver_tables(spark, 3, 3)
    incremental.apply_changes(spark, place, incremental.changes_of(orders.limit(0), fills.limit(0)), 0)
    assert incremental.read_order_analytics(spark, place).count() == 0
    assert incremental.read_trading_performance(spark, place).count() == 0


def test_streamed_fills_wait_for_their_orders(spark, place):
    def arrive(name, *rows_, **common):
        store.write_table(table(spark, name, list(rows_), **common), place, name)

    def run():
        query = start_matched_executions(spark, place, ONCE, within="10 days")
        query.awaitTermination()
        assert query.exception() is None
        return {r.exec_id: r.slippage_bps for r in store.read_table(spark, place, "executions_silver").collect()}

    arrive("raw_executions", dict(exec_id="early", fill_price=11.0), dict(exec_id="lost", order_id="none"), **FILL)
    assert run_or_empty(spark, place, run) == {}
    arrive("raw_orders", dict(order_id="O1"), **ORDER)
    assert run() == {"early": 1000.0}
    arrive("raw_executions", dict(exec_id="next", fill_price=10.0), **FILL)
    assert run() == {"early": 1000.0, "next": 0.0}
    later = ts("2024-03-01 00:00:00")
    arrive("raw_executions", dict(exec_id="close", exec_time=later, order_id="awaited"), **FILL)
    arrive("raw_orders", dict(order_id="close", created_at=later), **ORDER)
    assert run() == {"early": 1000.0, "next": 0.0, "lost": 0.0}


def test_waiting_fills_take_no_state_store(spark, place):
    """A state store looked every waiting fill up again in each batch."""
    store.write_table(table(spark, "raw_executions", [dict(exec_id="early")], **FILL), place, "raw_executions")
    query = start_matched_executions(spark, place, ONCE, within="10 days")
    query.awaitTermination()
    assert query.exception() is None and query.recentProgress and not any(p.stateOperators for p in query.recentProgress)


def test_matching_in_batches_equals_one_join(spark, place, monkeypatch):
    """Fills and orders in any order, an order that comes twice, late rows, merged and dropped parts, retried batches."""
    monkeypatch.setattr(matching, "FAN", 2)
    rng, start = random.Random(7), ts("2024-01-01 00:00:00")
    day = lambda n: start + timedelta(days=n)
    names = {"fills": "raw_executions", "orders": "raw_orders"}
    frame = lambda side, rows_: table(spark, names[side], rows_, **(FILL if side == "fills" else ORDER))
    taken = {"fills": [], "orders": []}
    for batch in range(9):
        fills = [dict(exec_id=f"{batch}-{i}", order_id=f"O{rng.randrange(12)}", exec_time=day(4 * batch + rng.randrange(4))) for i in range(8)]
        orders = [dict(order_id=f"O{rng.randrange(10)}", created_at=day(4 * batch + rng.randrange(4)), arrival_price=10.0 + batch) for _ in range(4)]
        now = {"fills": fills if batch % 3 != 1 else [], "orders": orders if batch % 3 != 2 else []}
        if batch == 8:
            now = {"fills": [dict(exec_id="last", order_id="none", exec_time=day(400))], "orders": [dict(order_id="last", created_at=day(400))]}
        for side in taken:
            taken[side] += now[side]
        if batch == 7:
            late = {"fills": [dict(exec_id="late", order_id="O1", exec_time=day(1))], "orders": [dict(order_id="O2", created_at=day(1), arrival_price=1.0)]}
            now = {side: now[side] + late[side] for side in now}
        for _ in range(2 if batch in (4, 8) else 1):  # the second time is a retry
            matching.match_batch(spark, place, *(frame(side, now[side]) for side in ("fills", "orders")), batch, "10 days", "5 days")
        parts = matching.manifest_before(spark, place, batch + 1).parts
        assert all(len({p.level for p in ps}) == len(ps) or ps[-1].level == 0 for ps in parts.values())
    expected = []
    for f in taken["fills"][:-1]:
        of = [o for o in taken["orders"] if o["order_id"] == f["order_id"] and abs(o["created_at"] - f["exec_time"]) <= timedelta(days=10)]
        expected += [(f["exec_id"], o["arrival_price"]) for o in of] or [(f["exec_id"], None)]
    got = [(r.exec_id, r.arrival_price) for r in store.read_table(spark, place, "executions_silver").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert len({e for e, _ in expected}) < len(expected) and any(a is None for _, a in expected)
    assert {side: [p.first for p in ps] for side, ps in parts.items()} == {"fills": [8], "orders": [8]}
    with pytest.raises(RuntimeError, match="another query"):
        matching.match_batch(spark, place, frame("fills", []), frame("orders", []), 3, "10 days", "5 days")


def run_or_empty(spark, place, run):
    """No folder of silver is there before the first row."""
    try:
        return run()
    except Exception as e:
        assert "PATH_NOT_FOUND" in str(e)
        return {}


def action_rows(n=80):
    rng = random.Random(4)
    kinds = ["ADJUST_SIZE"] * 4 + ["ADJUST_PRICE"] * 3 + ["HEDGE", "CANCEL", "EXECUTE"]
    return [
        dict(action_id=i, action_type=rng.choice(kinds), order_id=f"O{rng.randrange(12)}", qty=rng.choice([0, 100, 300]),
             price_limit=rng.choice([0.0, 11.25]), trader_id="T1", instrument_id="ES", direction="SELL", hedge_type="FUTURES",
             ts=ts("2024-01-02 10:00:00") + timedelta(minutes=i))
        for i in range(n)
    ]


def book(spark, place):
    prices = table(spark, "market_snapshot_gold", [dict(ticker="SPY", last_price=10.25)])
    store.write_version(prices, place, "market_snapshot_gold")
    return table(spark, "live_orders", [dict(order_id=f"O{i}") for i in range(10)], **LIVE), prices


def test_a_sync_keeps_what_actions_accepted(spark, place):
    live, _ = book(spark, place)
    none, no_action = live.limit(0), table(spark, "actions", [])
    size = table(spark, "actions", [dict(action_id=1, order_id="O1", action_type="ADJUST_SIZE", qty=777, trader_id="T1", ts=ts("2024-01-02 10:00:00"))])
    apply_live_batch(spark, place, live, no_action, 0, 4)
    # The sync was made before the action, and is applied together with it or after it.
    apply_live_batch(spark, place, live, size, 1, 4)
    newer = live.withColumns({"status": F.lit("PARTIAL"), "last_updated": F.to_timestamp(F.lit(NOW))})
    apply_live_batch(spark, place, newer, no_action, 2, 4)
    state = {r.order_id: (r.qty, r.status) for r in read_live_orders(spark, place).collect()}
    assert state["O1"] == (777, "PARTIAL") and state["O2"] == (100, "PARTIAL") and len(state) == 10
    assert store.read_table(spark, place, "order_actions").count() == 1
    before = rows(read_live_orders(spark, place))
    apply_live_batch(spark, place, newer, no_action, 2, 4)
    assert rows(read_live_orders(spark, place)) == before
    apply_live_batch(spark, place, none, no_action, 3, 4)
    assert rows(read_live_orders(spark, place)) == before


def test_refused_updates_are_stored(spark, place):
    live, _ = book(spark, place)
    bad = live.withColumn("direction", F.when(F.col("order_id") != "O3", F.col("direction")).otherwise("HOLD"))
    apply_live_batch(spark, place, bad, table(spark, "actions", []), 0, 4)
    assert read_live_orders(spark, place).count() == 9
    (refused,) = spark.read.parquet(place.path("refused_updates")).collect()
    assert refused.order_id == "O3" and "direction" in refused.reason


def test_one_action_touches_one_bucket(spark, place):
    live, _ = book(spark, place)
    apply_live_batch(spark, place, live, table(spark, "actions", []), 0, 8)
    t = live_table(place, 8)
    known = folders(spark, t)
    act = table(spark, "actions", [dict(action_id=1, order_id="O1", action_type="CANCEL", trader_id="T1", ts=ts("2024-01-02 10:00:00"))])
    apply_live_batch(spark, place, live.limit(0), act, 1, 8)
    ((bucket, batch),) = folders(spark, t) - known
    assert batch == 1 and [bucket] == t.touched(act)


def test_streamed_redeliveries_count_once(spark, place):
    live, prices = book(spark, place)
    acts = action_rows()
    store.write_table(live, place, "live_order_updates")
    for part in (acts[:30], acts[30:60], acts[60:] + acts[5:25:3]):
        store.write_table(table(spark, "actions", part), place, "actions")
        query = start_live_orders(spark, place, ONCE, buckets=4)
        query.awaitTermination()
        assert query.exception() is None
    whole = apply_order_actions(live, table(spark, "actions", acts), prices)
    assert rows(read_live_orders(spark, place)) == rows(whole.live_orders)
    assert rows(store.read_table(spark, place, "order_actions")) == rows(whole.audit)
    assert rows(store.read_table(spark, place, "hedge_requests")) == rows(whole.hedge_requests)


def test_streamed_gold_follows_silver(spark, place):
    orders, fills = silver_tables(spark, 10, 30)
    for number, part in enumerate((fills.where("exec_id % 2 = 0"), fills.where("exec_id % 2 = 1"))):
        store.write_batch(part, place, "executions_silver", number)
        store.write_batch(orders.where(F.pmod(F.xxhash64("order_id"), F.lit(2)) == number), place, "orders_silver", number)
        query = start_order_gold(spark, place, ONCE, buckets=2)
        query.awaitTermination()
        assert query.exception() is None
    assert rows(incremental.read_order_analytics(spark, place)) == rows(order_analytics_gold(orders, fills))
