"""Streams over the bronze tables and the order actions.

Every sink is idempotent: a micro-batch owns one folder, which a retry replaces, and a
new version of the live orders is derived from the version that the batch first saw. The
jobs delete all but the newest versions of what they write.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tapeloom.functions.columns import Moment
from tapeloom.operators.order_state import judge_actions, order_state
from tapeloom.operators.touched import keys_of, split_by_keys
from tapeloom.plans.refresh import (
    current_prices,
    refresh_market_snapshot,
    refresh_order_analytics,
    refresh_trading_performance,
)
from tapeloom.plans.silver import executions_silver, market_data_silver, orders_silver
from tapeloom.session import tune
from tapeloom.sources.layout import (
    Layout,
    _folder,
    drop_old_versions,
    exists,
    read_stream,
    read_table,
    versions,
    write_batch,
    write_version,
)

Trigger = dict[str, object]

ONCE: Trigger = {"availableNow": True}


def _source(spark: SparkSession, layout: Layout, name: str, max_files: int | None = None) -> DataFrame:
    """A stream over a table that may still be empty."""
    where, fs = _folder(spark, layout.path(name))
    fs.mkdirs(where)
    return read_stream(spark, layout, name, max_files)


def _each_batch(
    stream: DataFrame, layout: Layout, query: str, trigger: Trigger,
    handle: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    return (
        stream.writeStream.queryName(query)
        .option("checkpointLocation", layout.checkpoint(query))
        .trigger(**trigger)
        .foreachBatch(handle)
        .start()
    )


def start_silver(
    spark: SparkSession,
    layout: Layout,
    name: str,
    trigger: Trigger = ONCE,
    max_files: int | None = None,
    as_of: Moment = None,
) -> StreamingQuery:
    """Stream one bronze table into its silver table.

    The static side of a join is read anew for every micro-batch, so rows appended
    to it since the start are seen. A fill that precedes its order keeps NULL
    attributes and a slippage of 0 until silver is rebuilt.
    """
    tune(spark, streaming=True)
    if name == "market_data_silver":
        def handle(batch: DataFrame, batch_id: int) -> None:
            write_batch(batch, layout, name, batch_id)

        ticks = market_data_silver(_source(spark, layout, "raw_market_data", max_files))
        return _each_batch(ticks, layout, name, trigger, handle)
    if name == "orders_silver":
        def handle(batch: DataFrame, batch_id: int) -> None:
            funds = read_table(batch.sparkSession, layout, "etf_reference")
            write_batch(orders_silver(batch, funds, as_of), layout, name, batch_id)

        return _each_batch(_source(spark, layout, "raw_orders", max_files), layout, name, trigger, handle)
    if name == "executions_silver":
        def handle(batch: DataFrame, batch_id: int) -> None:
            orders = read_table(batch.sparkSession, layout, "raw_orders")
            parents = split_by_keys(orders, keys_of(batch)).touched
            write_batch(executions_silver(batch, parents), layout, name, batch_id)

        return _each_batch(
            _source(spark, layout, "raw_executions", max_files), layout, name, trigger, handle
        )
    raise ValueError(f"{name} is not a silver table")


def start_gold(
    spark: SparkSession, layout: Layout, trigger: Trigger = ONCE, as_of: Moment = None
) -> list[StreamingQuery]:
    """Refresh the gold tables whenever silver grows."""
    tune(spark, streaming=True)
    touched = _source(spark, layout, "orders_silver").select("order_id").unionByName(
        _source(spark, layout, "executions_silver").select("order_id")
    )

    def orders_changed(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        refresh_order_analytics(session, layout, batch)
        refresh_trading_performance(session, layout)
        for name in ("order_analytics_gold", "trading_performance_gold"):
            drop_old_versions(session, layout, name)

    def ticks_changed(batch: DataFrame, batch_id: int) -> None:
        refresh_market_snapshot(batch.sparkSession, layout, batch, as_of)
        drop_old_versions(batch.sparkSession, layout, "market_snapshot_gold")

    return [
        _each_batch(touched, layout, "order_gold", trigger, orders_changed),
        _each_batch(
            _source(spark, layout, "market_data_silver"), layout, "market_gold", trigger, ticks_changed
        ),
    ]


def apply_batch(
    spark: SparkSession, layout: Layout, actions: DataFrame, batch_id: int, query: str = ""
) -> None:
    """Apply one batch of actions to the stored live orders.

    Verdicts are stored first, in a folder that names the query, the batch and the version
    they were judged against. A retry finds that folder and goes on from the same version;
    a query with a new checkpoint is another one. The new version is refused if some other
    writer made it. Orders without actions are copied without a shuffle.
    """
    batch_id += zlib.crc32(query.encode()) << 31 if query else 0
    judged_at = f"{layout.path('judged_actions')}/batch={batch_id}"
    base = next(
        (v for v in versions(spark, layout, "live_orders")
         if exists(spark, f"{judged_at}/base={v}/_SUCCESS")),
        None,
    )
    if base is None:
        base = versions(spark, layout, "live_orders")[-1]
        live = read_table(spark, layout, "live_orders", version=base)
        touched = split_by_keys(live, keys_of(actions)).touched
        verdicts = judge_actions(touched, actions, current_prices(spark, layout))
        verdicts.write.mode("overwrite").parquet(f"{judged_at}/base={base}")
    live = read_table(spark, layout, "live_orders", version=base)
    judged = spark.read.parquet(f"{judged_at}/base={base}")
    touched, rest = split_by_keys(live, keys_of(judged))
    after = order_state(touched, judged)
    write_batch(after.audit, layout, "order_actions", batch_id)
    write_batch(after.rejected, layout, "rejected_actions", batch_id)
    write_batch(after.hedge_requests, layout, "hedge_requests", batch_id)
    after_all = rest.unionByName(after.live_orders)
    write_version(after_all, layout, "live_orders", base + 1, writer=f"{query}/{batch_id}")


def start_actions(
    spark: SparkSession,
    layout: Layout,
    trigger: Trigger = ONCE,
    max_files: int | None = None,
) -> StreamingQuery:
    """Apply trader actions as they arrive; a live order table must exist.

    The stream is the only writer of that table while it runs.
    """
    tune(spark, streaming=True)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        metadata = session.read.text(f"{layout.checkpoint('order_actions')}/metadata").first()[0]
        apply_batch(session, layout, batch, batch_id, json.loads(metadata)["id"])
        drop_old_versions(session, layout, "live_orders")

    return _each_batch(
        _source(spark, layout, "actions", max_files), layout, "order_actions", trigger, handle
    )
