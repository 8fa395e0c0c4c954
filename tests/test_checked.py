"""Streams that count what they drop; stops, restarts and replays."""

import glob
import os
from datetime import timedelta

import pytest

from tapeloom.operators.quality import ORDER_RULES, expectation_metrics
from tapeloom.plans.silver import enriched_orders, orders_silver
from tapeloom.sources import layout as store
from tapeloom.sources.dimensions import dimension
from tapeloom.streaming.checked import append_late_rows, read_late_rows, read_metrics, start_counted_silver
from tapeloom.streaming.jobs import ONCE
from tests.helpers import ORDER, TICK, table, ts

NOW = "2024-01-02 23:00:00"


@pytest.fixture
def place(spark, tmp_path):
    where = store.Layout(str(tmp_path / "desk"))
    store.write_table(dimension(spark, "etf_reference"), where, "etf_reference")
    return where


def stream(spark, place, name, **kw):
    query = start_counted_silver(spark, place, name, ONCE, as_of=NOW, **kw)
    query.awaitTermination()
    assert query.exception() is None
    return query


def rows(df):
    return sorted(map(repr, df.collect()))


def test_metrics_are_those_of_the_batches(spark, place):
    parts = [[dict(order_id="a"), dict(order_id=None), dict(order_id="b", qty=0)], [dict(order_id="c")]]
    for part in parts:
        store.write_table(table(spark, "raw_orders", part, **ORDER).coalesce(1), place, "raw_orders")
        stream(spark, place, "orders_silver")
    found = read_metrics(spark, place, "orders_silver")
    for number, part in enumerate(parts):
        whole = enriched_orders(table(spark, "raw_orders", part, **ORDER), dimension(spark, "etf_reference"), NOW)
        expected = expectation_metrics(whole, ORDER_RULES)
        assert rows(found.where(f"batch = {number}").select(expected.columns)) == rows(expected)
    raw = store.read_table(spark, place, "raw_orders")
    assert rows(store.read_table(spark, place, "orders_silver")) == rows(orders_silver(raw, dimension(spark, "etf_reference"), NOW))


def test_a_batch_written_but_not_committed_is_replaced(spark, place):
    for key in ("a", "b"):
        store.write_table(table(spark, "raw_orders", [dict(order_id=key)], **ORDER).coalesce(1), place, "raw_orders")
    stream(spark, place, "orders_silver", max_files=1)
    before = rows(store.read_table(spark, place, "orders_silver")), rows(read_metrics(spark, place, "orders_silver"))
    assert len(before[0]) == 2
    newest = max(glob.glob(f"{place.checkpoint('orders_silver')}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for path in (newest, f"{os.path.dirname(newest)}/.{os.path.basename(newest)}.crc"):
        if os.path.exists(path):
            os.remove(path)
    stream(spark, place, "orders_silver", max_files=1)
    assert before == (rows(store.read_table(spark, place, "orders_silver")), rows(read_metrics(spark, place, "orders_silver")))


def test_late_ticks_are_counted(spark, place):
    first = ts("2024-01-02 10:00:00")
    for minutes in ([0], [30], [1, 2, 31]):
        ticks = [dict(event_id=str(m), event_time=first + timedelta(minutes=m)) for m in minutes]
        store.write_table(table(spark, "raw_market_data", ticks, **TICK).coalesce(1), place, "raw_market_data")
        append_late_rows(place, stream(spark, place, "market_data_silver"))
    assert sum(r.late_rows for r in read_late_rows(spark, place).collect()) == 2
    assert store.read_table(spark, place, "market_data_silver").count() == 3
    assert sum(r.total for r in read_metrics(spark, place, "market_data_silver").where("rule = 'valid_price'").collect()) == 3
