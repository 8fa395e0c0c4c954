import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tapeloom.operators.order_state import (
    REJECTIONS,
    _with_slices,
    adjustment_preview,
    apply_order_actions,
    audit_trail,
    judge_actions,
)
from tests.helpers import LIVE, by, table, ts

START = ts("2024-01-02 10:00:00")


def prices(spark, **known):
    return table(spark, "market_snapshot_gold", [
        dict(ticker=t, last_price=p) for t, p in known.items()
    ])


def run(spark, orders, actions, known=None):
    live = table(spark, "live_orders", orders, **LIVE)
    timed = [
        dict(action_id=i, ts=START + timedelta(minutes=i), order_id="O1", **a) if "ts" not in a
        else dict(action_id=i, order_id="O1", **a)
        for i, a in enumerate(actions)
    ]
    acts = table(spark, "actions", timed)
    return apply_order_actions(live, acts, prices(spark, **(known or {"SPY": 11.0})))


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def reasons(state):
    return {r.action_id: (r.reason, r.code) for r in state.rejected.collect()}


def values(state):
    return {
        r.action_id: (r.action_type, json.loads(r.old_value), json.loads(r.new_value))
        for r in state.audit.collect()
    }


def test_cancel(spark):
    state = run(spark, [dict(order_id="O1")], [
        dict(action_type="CANCEL", trader_id="T9"), dict(action_type="CANCEL"),
    ])
    order = only(state.live_orders)
    assert order.status == "CANCELLED" and order.last_updated == START
    assert values(state) == {0: ("CANCEL", {"status": "PENDING"}, {"status": "CANCELLED"})}
    assert only(state.audit).trader_id == "T9"
    assert reasons(state) == {1: ("CLOSED", 400)}
    assert only(state.rejected).trader_id == "T001"


def test_execute_at_market(spark):
    state = run(spark, [dict(order_id="O1", filled_qty=5, qty=70)], [
        dict(action_type="EXECUTE"), dict(action_type="EXECUTE"), dict(action_type="CANCEL"),
    ])
    order = only(state.live_orders)
    assert (order.status, order.filled_qty, order.fill_rate) == ("FILLED", 70, 1.0)
    assert (order.avg_fill_price, order.avg_slippage_bps) == (11.0, 1000.0)
    assert order.notional_value == 1000.0
    assert values(state) == {0: (
        "EXECUTE", {"status": "PENDING", "filled_qty": 5},
        {"status": "FILLED", "fill_price": 11.0, "slippage_bps": 1000.0},
    )}
    assert reasons(state) == {1: ("CLOSED", 400), 2: ("CLOSED", 400)}


def test_a_cancelled_order_can_be_executed(spark):
    state = run(spark, [dict(order_id="O1", status="CANCELLED")], [dict(action_type="EXECUTE")])
    assert only(state.live_orders).status == "FILLED"
    assert values(state)[0][1]["status"] == "CANCELLED"


def test_without_market_price_the_adjusted_limit_fills(spark):
    state = run(spark, [dict(order_id="O1", etf_ticker="ZZZ")], [
        dict(action_type="ADJUST_PRICE", price_limit=12.0),
        dict(action_type="CANCEL"),
        dict(action_type="ADJUST_PRICE", price_limit=20.0),
        dict(action_type="EXECUTE"),
    ])
    order = only(state.live_orders)
    assert (order.avg_fill_price, order.avg_slippage_bps) == (12.0, 2000.0)
    assert order.price_limit == 12.0
    assert reasons(state) == {2: ("CLOSED", 400)}


def test_without_any_price_an_execute_waits_for_one(spark):
    unpriced = dict(order_id="O1", etf_ticker="ZZZ", price_limit=None)
    actions = [
        dict(action_type="EXECUTE"),
        dict(action_type="ADJUST_PRICE", price_limit=9.0),
        dict(action_type="EXECUTE"),
    ]
    state = run(spark, [unpriced], actions)
    assert reasons(state) == {0: ("NO_PRICE", 500)}
    assert only(state.live_orders).avg_fill_price == 9.0
    # Without an arrival price there is nothing to compare, and no price is needed.
    state = run(spark, [{**unpriced, "arrival_price": None}], actions[:1])
    order = only(state.live_orders)
    assert order.status == "FILLED" and order.avg_fill_price is None
    assert order.avg_slippage_bps == 0.0


def test_size_and_price(spark):
    state = run(spark, [dict(order_id="O1")], [
        dict(action_type="ADJUST_SIZE", qty=200),
        dict(action_type="ADJUST_PRICE", price_limit=11.0),
        dict(action_type="ADJUST_SIZE", qty=0), dict(action_type="ADJUST_SIZE", qty=None),
        dict(action_type="ADJUST_PRICE", price_limit=-1.0),
        dict(action_type="ADJUST_SIZE", qty=300),
    ])
    order = only(state.live_orders)
    assert (order.qty, order.price_limit, order.notional_value) == (300, 11.0, 3300.0)
    assert values(state) == {
        0: ("ADJUST_SIZE", {"qty": 100}, {"qty": 200}),
        1: ("ADJUST_PRICE", {"price_limit": 10.0}, {"price_limit": 11.0}),
        5: ("ADJUST_SIZE", {"qty": 200}, {"qty": 300}),
    }
    assert reasons(state) == {i: ("BAD_VALUE", 400) for i in (2, 3, 4)}


def test_zero_limit_is_shown_as_missing(spark):
    state = run(spark, [dict(order_id="O1", price_limit=0.0)], [
        dict(action_type="ADJUST_PRICE", price_limit=3.0)])
    assert values(state)[0][1] == {"price_limit": None}


def test_hedges(spark):
    hedge = dict(action_type="HEDGE", instrument_id="ES", direction="SELL", hedge_type="FUTURES", qty=2)
    state = run(spark, [dict(order_id="O1", status="FILLED")], [hedge, {**hedge, "qty": 3}])
    assert only(state.live_orders).assigned_hedge_id == "1"
    assert values(state) == {
        0: ("HEDGE", {"assigned_hedge_id": None}, {"hedge_id": 0, "instrument_id": "ES", "qty": 2}),
        1: ("HEDGE", {"assigned_hedge_id": "0"}, {"hedge_id": 1, "instrument_id": "ES", "qty": 3}),
    }
    requests = by(state.hedge_requests, "hedge_id")
    assert requests[1].asDict() == dict(
        hedge_id=1, parent_order_id="O1", instrument_id="ES", direction="SELL", qty=3,
        hedge_type="FUTURES", status="PENDING", created_at=START + timedelta(minutes=1))


def test_order_of_checks(spark):
    live = table(spark, "live_orders", [dict(order_id="O1", status="FILLED")], **LIVE)
    acts = table(spark, "actions", [
        dict(action_id=1, order_id="none", action_type="ADJUST_SIZE", qty=-1),
        dict(action_id=2, order_id="none", action_type="ADJUST_SIZE", qty=1),
        dict(action_id=3, order_id="O1", action_type="ADJUST_SIZE", qty=-1),
        dict(action_id=4, order_id="O1", action_type="SHRED"),
        dict(action_id=5, order_id=None, action_type="CANCEL"),
        dict(action_id=6, order_id="O1", action_type=None),
    ], ts=START)
    state = apply_order_actions(live, acts, prices(spark, SPY=1.0))
    assert {k: r for k, (r, _) in reasons(state).items()} == {
        1: "BAD_VALUE", 2: "UNKNOWN_ORDER", 3: "BAD_VALUE", 4: "UNKNOWN_ACTION",
        5: "UNKNOWN_ORDER", 6: "UNKNOWN_ACTION",
    }
    assert set(r for r, _ in reasons(state).values()) <= set(REJECTIONS)


def test_actions_without_time_happen_now(spark):
    live = table(spark, "live_orders", [dict(order_id="O1")], **LIVE)
    acts = table(spark, "actions", [dict(action_id=1, order_id="O1", action_type="CANCEL")])
    state = apply_order_actions(live, acts, prices(spark, SPY=1.0))
    assert only(state.live_orders).last_updated > START


def replay(orders, actions, market):
    """The same actions one by one."""
    live = {o["order_id"]: {**LIVE, "assigned_hedge_id": None, "avg_fill_price": None, **o}
            for o in orders}
    verdicts, before = {}, {}
    for a in sorted(actions, key=lambda a: (a["ts"], a["action_id"])):
        i, kind, o = a["action_id"], a["action_type"], live.get(a["order_id"])
        size_ok, price_ok = (a.get("qty") or 0) > 0, (a.get("price_limit") or 0) > 0
        if (kind == "ADJUST_SIZE" and not size_ok) or (kind == "ADJUST_PRICE" and not price_ok):
            verdicts[i] = "BAD_VALUE"
            continue
        if kind == "HEDGE" and a["qty"] is None:
            verdicts[i] = "BAD_HEDGE"
            continue
        if o is None:
            verdicts[i] = "UNKNOWN_ORDER"
            continue
        before[i] = (
            o["status"],
            o["qty"] if kind == "ADJUST_SIZE" else None,
            o["price_limit"] if kind in ("ADJUST_PRICE", "EXECUTE") else None,
            o["assigned_hedge_id"] if kind == "HEDGE" else None,
        )
        closed = o["status"] in ("FILLED", "CANCELLED")
        if kind == "EXECUTE":
            if o["status"] == "FILLED":
                verdicts[i] = "CLOSED"
                continue
            price = market.get(o["etf_ticker"], o["price_limit"])
            slippage = 0.0
            if o["arrival_price"] and o["arrival_price"] > 0:
                if price is None:
                    verdicts[i] = "NO_PRICE"
                    continue
                slippage = round((price - o["arrival_price"]) / o["arrival_price"] * 10000, 2)
            o.update(status="FILLED", filled_qty=o["qty"], avg_fill_price=price,
                     avg_slippage_bps=slippage, fill_rate=1.0)
        elif kind == "HEDGE":
            o.update(assigned_hedge_id=str(i))
        elif closed:
            verdicts[i] = "CLOSED"
            continue
        elif kind == "CANCEL":
            o.update(status="CANCELLED")
        elif kind == "ADJUST_SIZE":
            o.update(qty=a["qty"], notional_value=a["qty"] * (o["price_limit"] or 0))
        else:
            o.update(price_limit=a["price_limit"], notional_value=(o["qty"] or 0) * a["price_limit"])
        o["last_updated"] = a["ts"]
        verdicts[i] = "OK"
    return live, verdicts, before


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_sequential_replay(spark, seed):
    rng = random.Random(seed)
    market = {"SPY": 10.25, "QQQ": 12.5}
    orders = [
        dict(order_id=f"O{i}", etf_ticker=rng.choice(["SPY", "QQQ", "ZZZ"]),
             status=rng.choices(["PENDING", "PARTIAL", "CANCELLED", "FILLED"], [6, 3, 1, 1])[0],
             price_limit=rng.choice([None, 0.0, 8.5, 10.0]), arrival_price=rng.choice([None, 0.0, 8.0]))
        for i in range(60)
    ]
    # One order holds a third of the actions, and several share one instant.
    kinds = ["ADJUST_SIZE"] * 6 + ["ADJUST_PRICE"] * 6 + ["HEDGE"] * 3 + ["CANCEL", "EXECUTE"]
    actions = []
    for i in range(900):
        hot = i % 3 == 0
        kind = rng.choice(kinds[:15] if hot and i < 700 else kinds)
        actions.append(dict(
            action_id=i, action_type=kind, order_id="O0" if hot else f"O{rng.randrange(62)}",
            qty=rng.choice([None, -100, 0, 100, 200, 300]), price_limit=rng.choice([None, 0.0, 9.5, 11.25]),
            trader_id="T1", instrument_id="ES", direction="SELL", hedge_type="FUTURES",
            ts=START + timedelta(seconds=rng.randrange(60) * 3600 * (1 if i % 2 else 2)),
        ))
    orders[0].update(status="PENDING")
    live, verdicts, before = replay(orders, actions, market)

    frame = table(spark, "live_orders", orders, **LIVE)
    acts = table(spark, "actions", actions).repartition(5, F.rand(seed))
    judged = judge_actions(frame, acts, prices(spark, **market)).collect()
    assert {r.action_id: r.verdict for r in judged} == verdicts
    assert set(verdicts.values()) >= {"OK", "CLOSED", "BAD_VALUE", "UNKNOWN_ORDER"}
    for r in judged:
        if r.verdict == "OK":
            assert (r.status_before, r.qty_before, r.price_before, r.hedge_before) == before[r.action_id]

    state = apply_order_actions(frame, acts, prices(spark, **market))
    for r in state.live_orders.collect():
        assert {k: r[k] for k in live[r.order_id]} == live[r.order_id]
    assert state.audit.count() + state.rejected.count() == len(actions)


def test_audit_trail_and_preview(spark):
    state = run(spark, [dict(order_id="O1", qty=80), dict(order_id="O2")], [
        dict(action_type="ADJUST_SIZE", qty=100), dict(action_type="CANCEL"),
        dict(action_type="HEDGE", instrument_id="ES", direction="SELL", qty=3, hedge_type="FUTURES")])
    wanted = spark.createDataFrame([("O1",), ("O1",), ("gone",)], "order_id string")
    assert [r.action_id for r in audit_trail(state.audit, wanted).collect()] == [0, 1, 2]

    live = table(spark, "live_orders", [
        dict(order_id="O1", qty=80), dict(order_id="O2", qty=None, price_limit=None)], **LIVE)
    acts = table(spark, "actions", [
        dict(action_id=1, order_id="O1", action_type="ADJUST_SIZE", qty=100),
        dict(action_id=2, order_id="O1", action_type="ADJUST_SIZE", qty=-1),
        dict(action_id=3, order_id="O1", action_type="ADJUST_PRICE", price_limit=2.5),
        dict(action_id=4, order_id="O2", action_type="ADJUST_SIZE", qty=3),
        dict(action_id=5, order_id="O2", action_type="ADJUST_PRICE", price_limit=2.5),
        dict(action_id=6, order_id="O1", action_type="CANCEL"),
    ], ts=START)
    rows = by(adjustment_preview(live, acts), "action_id")
    assert {k: (r.new_notional, r.qty_change_pct) for k, r in rows.items()} == {
        1: (1000.0, 25.0), 2: (None, None), 3: (200.0, None), 4: (0.0, 300.0), 5: (0.0, None),
    }


def test_a_hot_second_of_one_order_is_split(spark):
    """An order owns a third of the actions, all in one second; no slice has much more than others."""
    i = F.col("id")
    acts = spark.range(30_000).select(
        i.alias("action_id"), F.when(i % 3 == 0, "O0").otherwise(F.concat(F.lit("O"), i % 3000)).alias("order_id"),
        F.when(i % 3 == 0, F.lit(START)).otherwise(F.lit(START) + F.make_dt_interval(mins=(i % 500).cast("int"))).alias("ts"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would make one slice of so few
    sizes = [r["count"] for r in _with_slices(acts).groupBy("order_id", "slice").count().where("order_id = 'O0'").collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 10_000 and max(sizes) < 30_000 / 8 * 1.5 and len(sizes) > 2


def test_an_action_delivered_twice_counts_once(spark):
    live = table(spark, "live_orders", [dict(order_id="O1")], **LIVE)
    once = dict(action_id=1, order_id="O1", action_type="EXECUTE", ts=START)
    other = dict(action_id=1, order_id="O1", action_type="CANCEL", ts=START + timedelta(minutes=1))
    state = apply_order_actions(live, table(spark, "actions", [once, once, other]), prices(spark, SPY=11.0))
    assert [r.action_type for r in state.audit.collect()] == ["EXECUTE"]
    assert reasons(state) == {1: ("REPEATED_ID", 409)}
    assert only(state.live_orders).status == "FILLED"


def test_a_hedge_names_all_it_needs(spark):
    whole = dict(action_type="HEDGE", instrument_id="ES", direction="SELL", qty=3, hedge_type="FUTURES")
    partial = [{k: v for k, v in whole.items() if k != gone} for gone in ("instrument_id", "direction", "qty", "hedge_type")]
    state = run(spark, [dict(order_id="O1")], [whole, *partial])
    assert reasons(state) == {i: ("BAD_HEDGE", 422) for i in range(1, 5)}
    assert [r.hedge_id for r in state.hedge_requests.collect()] == [0]
    assert only(state.live_orders).assigned_hedge_id == "0"
