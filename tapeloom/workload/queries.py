"""Every registered query as a function of a session and a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators import hedging, order_state, quality, upsert
from tapeloom.plans import gold, incremental, kpis, read_models, silver
from tapeloom.plans.refresh import current_prices
from tapeloom.schemas import TABLES
from tapeloom.session import scratch_dir, tune
from tapeloom.sources import snapshots
from tapeloom.sources.desk_views import MARKET_AS_OF, ORDERS_AS_OF, VIEWS, spark_view
from tapeloom.sources.layout import (
    Layout,
    read_stream,
    read_table,
    run_sql,
    save_bucketed,
    table_row_counts,
    write_batch,
    write_table,
    write_version,
)
from tapeloom.streaming import checked
from tapeloom.streaming.incremental import start_matched_executions, start_order_gold
from tapeloom.streaming.live import read_live_orders, start_live_orders
from tapeloom.streaming.jobs import ONCE, start_actions, start_gold, start_silver

# The state before the sync of `live_orders_merge`: orders created until then.
LAST_SYNC = "1999-01-01 00:00:00"
# Between the two arrivals of actions in `stream_order_actions`.
MIDWAY = "2024-01-15 00:00:00"
# Fills until then arrive before the orders in `stream_early_fills`; the closing rows are far behind all others.
FILLS_MIDWAY = "1998-06-01 00:00:00"
FEW_BUCKETS = 8  # each batch of these streams touches all of them
CLOSING = "2031-01-01 00:00:00"


class Desk:
    """The desk's tables over one folder of test data, each built when first used."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = tune(spark)
        self.directory = directory

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        self.__dict__[name] = spark_view(self.spark, self.directory, name)
        return self.__dict__[name]

    @cached_property
    def market(self) -> DataFrame:
        return silver.market_data_silver(self.raw_market_data)

    @cached_property
    def orders(self) -> DataFrame:
        return silver.orders_silver(self.raw_orders, self.etf_reference, ORDERS_AS_OF)

    @cached_property
    def executions(self) -> DataFrame:
        return silver.executions_silver(self.raw_executions, self.raw_orders)

    @cached_property
    def analytics(self) -> DataFrame:
        return gold.order_analytics_gold(self.orders, self.executions)

    @cached_property
    def snapshot(self) -> DataFrame:
        return gold.market_snapshot_gold(self.market, MARKET_AS_OF)

    @cached_property
    def performance(self) -> DataFrame:
        return gold.trading_performance_gold(self.analytics)

    @cached_property
    def active(self) -> DataFrame:
        return read_models.order_progress(self.orders, self.analytics)

    @cached_property
    def listing(self) -> DataFrame:
        return read_models.execution_rows(self.analytics)

    @cached_property
    def trader_days(self) -> DataFrame:
        return read_models.trader_days(self.performance, self.traders)

    @cached_property
    def live(self) -> DataFrame:
        source = upsert.live_order_source(self.orders, self.analytics)
        return upsert.as_live_orders(source, ORDERS_AS_OF)

    @cached_property
    def after_actions(self) -> order_state.OrderState:
        return order_state.apply_order_actions(self.live, self.actions, self.snapshot)


def _expectation_metrics(d: Desk) -> DataFrame:
    checked = {
        "market_data_silver": (silver.enriched_ticks(d.raw_market_data), quality.TICK_RULES),
        "orders_silver": (
            silver.enriched_orders(d.raw_orders, d.etf_reference, ORDERS_AS_OF), quality.ORDER_RULES,
        ),
        "executions_silver": (
            silver.enriched_executions(d.raw_executions, d.raw_orders), quality.EXECUTION_RULES,
        ),
    }
    return _stacked({
        name: quality.expectation_metrics(df, rules) for name, (df, rules) in checked.items()
    })


def _constraint_violations(d: Desk) -> DataFrame:
    """All constraints that the tables declare, also those of required columns."""
    rows = {
        "live_orders": upsert.as_live_orders(upsert.live_order_fallback(d.raw_orders), ORDERS_AS_OF),
        "raw_market_data": d.raw_market_data,
        "raw_orders": d.raw_orders,
    }
    return _stacked({
        name: quality.constraint_violations(df, TABLES[name].keys, TABLES[name].required, TABLES[name].domains)
        for name, df in rows.items()
    })


def _stacked(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        df = df.withColumn("table_name", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


def _order_summary(d: Desk) -> DataFrame:
    summary = snapshots.order_summary(d.raw_orders, d.raw_executions, ORDERS_AS_OF)
    return summary.select("generated_at", "total_orders", "total_executions", "status_counts.*")


def _live_orders_merge(d: Desk) -> DataFrame:
    before = d.raw_orders.where(F.col("created_at") < LAST_SYNC)
    live = upsert.as_live_orders(upsert.live_order_fallback(before), LAST_SYNC)
    source = upsert.live_order_source(d.orders, d.analytics)
    return upsert.sync_live_orders(live, source, ORDERS_AS_OF)


def _actions_audit(d: Desk) -> DataFrame:
    return _opened(d.after_actions.audit)


def _opened(audit: DataFrame) -> DataFrame:
    """Audit rows with the fields of their JSON values."""
    old = F.from_json(
        "old_value", "status string, filled_qty bigint, qty int, price_limit double, "
        "assigned_hedge_id string")
    new = F.from_json(
        "new_value", "status string, fill_price double, slippage_bps double, qty int, "
        "price_limit double, hedge_id bigint, instrument_id string")
    rows = audit.withColumns({"old": old, "new": new})
    return rows.select(
        "action_id", "order_id", "action_type", "trader_id", "ts",
        *[F.col(f"old.{f}").alias(f"old_{f}")
          for f in ("status", "filled_qty", "qty", "price_limit", "assigned_hedge_id")],
        *[F.col(f"new.{f}").alias(f"new_{f}")
          for f in ("status", "fill_price", "slippage_bps", "qty", "price_limit", "hedge_id",
                    "instrument_id")],
    )


def _audit_by_order(d: Desk) -> DataFrame:
    """The audit trail of all orders that were pending before the actions."""
    pending = read_models.status_tab(d.live, "PENDING")
    trail = order_state.audit_trail(d.after_actions.audit, pending)
    return _opened(trail)


def _price_history(d: Desk) -> DataFrame:
    return read_models.price_history(d.raw_market_data, MARKET_AS_OF, "SPY", hours=8)


def _market_snapshot_json(d: Desk) -> DataFrame:
    path = f"{scratch_dir(d.spark, 'snapshot')}/latest"
    snapshots.market_snapshot_json(d.snapshot, path, MARKET_AS_OF)
    return snapshots.read_market_snapshot_json(d.spark, path)


def _stream_market_dedupe(d: Desk) -> DataFrame:
    """Keys kept by streaming de-duplication; which duplicate survives is left open."""
    layout = Layout(scratch_dir(d.spark, "ticks"))
    write_table(d.raw_market_data, layout, "raw_market_data")
    ticks = read_stream(d.spark, layout, "raw_market_data")
    keys = silver.unique_ticks(ticks).select(*silver.TICK_KEY)
    kept = layout.path("unique_ticks")
    (
        keys.writeStream.format("parquet")
        .option("path", kept)
        .option("checkpointLocation", layout.checkpoint("unique_ticks"))
        .trigger(**ONCE)
        .start()
        .awaitTermination()
    )
    return d.spark.read.parquet(kept)


# Ticks that reach `stream_market_*` after their time has passed the watermark.
LATE = f"event_time < TIMESTAMP '{MIDWAY}' AND CAST(substr(event_id, 5) AS BIGINT) % 50 = 0"


def _streamed_ticks(d: Desk) -> Layout:
    """Ticks in three arrivals: the older, the newer with copies of some, and late ones, which are dropped."""
    layout = Layout(scratch_dir(d.spark, "ticks"))
    ticks = silver.unique_ticks(d.raw_market_data).select(*TABLES["raw_market_data"].columns)
    late, older = F.coalesce(F.expr(LATE), F.lit(False)), F.col("event_time") < MIDWAY
    newer = ticks.where(~older)
    copies = newer.where(F.expr("CAST(substr(event_id, 5) AS BIGINT) % 7 = 0"))
    for arrival in (ticks.where(older & ~late), newer.unionByName(copies), ticks.where(late)):
        write_table(arrival, layout, "raw_market_data")
        start_silver(d.spark, layout, "market_data_silver", ONCE).awaitTermination()
    return layout


def _stream_market_silver(d: Desk) -> DataFrame:
    return read_table(d.spark, _streamed_ticks(d), "market_data_silver")


def _stream_market_snapshot(d: Desk) -> DataFrame:
    layout = _streamed_ticks(d)
    for query in start_gold(d.spark, layout, ONCE, as_of=MARKET_AS_OF):
        query.awaitTermination()
    return read_table(d.spark, layout, "market_snapshot_gold")


def _price_history_stored(d: Desk) -> DataFrame:
    """The price chart from stored ticks, of which only the folders of its window are read."""
    layout = Layout(scratch_dir(d.spark, "stored-ticks"))
    write_table(d.raw_market_data, layout, "raw_market_data")
    return read_models.stored_price_history(d.spark, layout, MARKET_AS_OF, "SPY", hours=8)


def _price_history_day_stored(d: Desk) -> DataFrame:
    """The day's chart from stored silver."""
    layout = Layout(scratch_dir(d.spark, "stored-silver"))
    write_table(d.market, layout, "market_data_silver", mode="overwrite")
    return read_models.stored_price_history_day(d.spark, layout, MARKET_AS_OF)


def _audit_of_order(d: Desk) -> DataFrame:
    """The audit trail of one order from rows stored by order."""
    layout = Layout(scratch_dir(d.spark, "audit"))
    stored = save_bucketed(d.after_actions.audit, layout, "order_actions", buckets=16)
    return _opened(order_state.audit_of_order(stored, "ORD-7"))


def _prices_from_bronze(d: Desk) -> DataFrame:
    """Current prices where there is no snapshot yet."""
    layout = Layout(scratch_dir(d.spark, "bronze"))
    write_table(d.raw_market_data, layout, "raw_market_data")
    return current_prices(d.spark, layout)


def _order_summary_file(d: Desk) -> DataFrame:
    path = f"{scratch_dir(d.spark, 'summary')}/latest"
    summary = snapshots.order_summary(d.raw_orders, d.raw_executions, ORDERS_AS_OF)
    snapshots.order_summary_json(summary, path)
    return d.spark.read.schema(summary.schema).json(path).select(
        "generated_at", "total_orders", "total_executions", "status_counts.*")


def _live_orders_parsed(d: Desk) -> DataFrame:
    """Live orders that arrive as text, some with sizes that are no numbers and without status."""
    text = d.live.select(*[F.col(c).cast("string").alias(c) for c in d.live.columns])
    odd = F.col("qty").cast("int") % 700 == 0
    text = text.withColumns({"qty": F.when(odd, "n/a").otherwise(F.col("qty")), "status": F.when(~odd, F.col("status"))})
    return upsert.as_live_orders(upsert.parse_live_order_rows(text), ORDERS_AS_OF)


def _live_orders_rejected(d: Desk) -> DataFrame:
    """What the live table refuses of orders some of which have a bad side, no trader or a second version."""
    size = F.col("qty")
    orders = d.raw_orders.withColumns({
        "direction": F.when(size % 500 == 0, "HOLD").otherwise(F.col("direction")),
        "trader_id": F.when(size % 700 != 0, F.col("trader_id")),
    })
    again = orders.where(size % 300 == 0).withColumn("qty", size + 1)
    rows = upsert.as_live_orders(upsert.live_order_fallback(orders.unionByName(again)), ORDERS_AS_OF)
    return upsert.accepted_live_orders(rows).rejected.select("order_id", "reason")


def _hedge_rejected(d: Desk) -> DataFrame:
    """Actions refused for what they lack, of actions some of which have no instrument or no size."""
    actions = d.actions.withColumns({
        "instrument_id": F.when(F.col("action_id") % 5 != 0, F.col("instrument_id")),
        "qty": F.when(F.col("action_id") % 6 != 0, F.col("qty")),
    })
    state = order_state.apply_order_actions(d.live, actions, d.snapshot)
    return state.rejected.where("reason = 'BAD_HEDGE'")


def _orders_by_statement(d: Desk) -> DataFrame:
    return run_sql(
        d.spark, "SELECT order_id, trader_id, qty FROM {orders} WHERE status = :status AND qty > :least",
        {"status": "PENDING", "least": 5000}, orders=d.raw_orders,
    )


def _stream_gold_refresh(d: Desk) -> DataFrame:
    """Bronze to silver to order analytics, all as streams."""
    layout = Layout(scratch_dir(d.spark, "gold"))
    write_table(d.raw_orders, layout, "raw_orders")
    write_table(d.raw_executions, layout, "raw_executions")
    full = d.etf_reference.select("*", *[
        F.lit(None).cast(t).alias(c)
        for c, t in (("benchmark", "string"), ("intraday_iv", "double"), ("base_price", "double"))
    ])
    write_table(full, layout, "etf_reference")
    for name in ("orders_silver", "executions_silver"):
        start_silver(d.spark, layout, name, ONCE, as_of=ORDERS_AS_OF).awaitTermination()
    for query in start_gold(d.spark, layout, ONCE, as_of=MARKET_AS_OF):
        query.awaitTermination()
    return read_table(d.spark, layout, "order_analytics_gold")


def _stream_order_actions(d: Desk) -> DataFrame:
    """Live orders after two arrivals of actions."""
    layout = Layout(scratch_dir(d.spark, "actions"))
    write_version(d.live, layout, "live_orders")
    write_version(d.snapshot, layout, "market_snapshot_gold")
    early = F.col("ts") < MIDWAY
    for arrival in (d.actions.where(early), d.actions.where(~early)):
        write_table(arrival, layout, "actions")
        start_actions(d.spark, layout, ONCE).awaitTermination()
    return read_table(d.spark, layout, "live_orders")


def _run(*started) -> None:
    for query in started:
        query.awaitTermination()


def _store_funds(d: Desk, layout: Layout) -> None:
    full = d.etf_reference.select("*", *[
        F.lit(None).cast(t).alias(c)
        for c, t in (("benchmark", "string"), ("intraday_iv", "double"), ("base_price", "double"))
    ])
    write_table(full, layout, "etf_reference")


def _gold_by_batch(d: Desk) -> Layout:
    """Orders and fills in five arrivals, some fills before their order; gold follows each."""
    layout = Layout(scratch_dir(d.spark, "gold-by-batch"))
    _store_funds(d, layout)
    write_table(d.raw_orders, layout, "raw_orders")
    _run(start_silver(d.spark, layout, "orders_silver", ONCE, as_of=ORDERS_AS_OF))
    write_table(d.executions, layout, "executions_silver", mode="overwrite")
    orders, executions = (read_table(d.spark, layout, n) for n in ("orders_silver", "executions_silver"))
    arrived = Layout(f"{layout.root}/arrived")
    key = F.pmod(F.xxhash64("order_id"), F.lit(3))
    share = F.pmod(F.xxhash64("exec_id"), F.lit(3))
    arrivals = (
        (None, executions.where(share == 0)),
        (orders.where(key == 0), None),
        (orders.where(key == 1), executions.where(share == 1)),
        (None, executions.where(share == 2)),
        (orders.where(key == 2), None),
    )
    for number, (more_orders, fills) in enumerate(arrivals):
        if more_orders is not None:
            write_batch(more_orders, arrived, "orders_silver", number)
        if fills is not None:
            write_batch(fills, arrived, "executions_silver", number)
        _run(start_order_gold(d.spark, arrived, ONCE, buckets=FEW_BUCKETS))
    return arrived


def _stream_gold_incremental(d: Desk) -> DataFrame:
    return incremental.read_order_analytics(d.spark, _gold_by_batch(d))


def _stream_trader_days(d: Desk) -> DataFrame:
    return incremental.read_trading_performance(d.spark, _gold_by_batch(d))


def _stream_early_fills(d: Desk) -> DataFrame:
    """Half of the fills arrive before any order. A last fill and order, far behind the others, move the
    watermark on, after which fills without an order go on too; that fill itself waits for its order."""
    layout = Layout(scratch_dir(d.spark, "early-fills"))
    early = F.col("exec_time") < FILLS_MIDWAY
    later = F.to_timestamp(F.lit(CLOSING))
    last_fill = d.raw_executions.where("fill_qty > 0").limit(1).withColumns({"exec_time": later, "order_id": F.lit("AWAITED")})
    last_order = d.raw_orders.limit(1).withColumns({"created_at": later, "order_id": F.lit("CLOSING")})
    for name, rows in (
        ("raw_executions", d.raw_executions.where(early)),
        ("raw_orders", d.raw_orders),
        ("raw_executions", d.raw_executions.where(~early)),
        ("raw_executions", last_fill),
    ):
        write_table(rows, layout, name)
        if rows is last_fill:
            write_table(last_order, layout, "raw_orders")
        _run(start_matched_executions(d.spark, layout, ONCE, within="3000 DAYS"))
    return read_table(d.spark, layout, "executions_silver")


def _order_arrivals(d: Desk) -> list[DataFrame]:
    """Orders in three arrivals by the year of their creation."""
    first, second = F.col("created_at") < "1997-01-01", F.col("created_at") < "1999-01-01"
    return [d.raw_orders.where(first), d.raw_orders.where(~first & second), d.raw_orders.where(~second)]


def _stream_expectations(d: Desk) -> DataFrame:
    """How many orders of each batch hold each expectation, counted while they are written."""
    layout = Layout(scratch_dir(d.spark, "counted"))
    _store_funds(d, layout)
    for arrival in _order_arrivals(d):
        write_table(arrival, layout, "raw_orders")
        _run(checked.start_counted_silver(d.spark, layout, "orders_silver", ONCE, as_of=ORDERS_AS_OF))
    return checked.read_metrics(d.spark, layout, "orders_silver")


def _stream_late_rows(d: Desk) -> DataFrame:
    """The number of ticks that came after the watermark."""
    layout = Layout(scratch_dir(d.spark, "late"))
    ticks = silver.unique_ticks(d.raw_market_data).select(*TABLES["raw_market_data"].columns)
    late, older = F.coalesce(F.expr(LATE), F.lit(False)), F.col("event_time") < MIDWAY
    for arrival in (ticks.where(older & ~late), ticks.where(~older), ticks.where(late)):
        write_table(arrival, layout, "raw_market_data")
        query = checked.start_counted_silver(d.spark, layout, "market_data_silver", ONCE)
        _run(query)
        checked.append_late_rows(layout, query)
    rows = checked.read_late_rows(d.spark, layout)
    return rows.groupBy("query").agg(F.sum("late_rows").alias("late_rows"))


def _stream_restarted(d: Desk) -> DataFrame:
    """Orders streamed file by file, stopped after some batches, and taken up again from the checkpoint."""
    layout = Layout(scratch_dir(d.spark, "restarted"))
    _store_funds(d, layout)
    for arrival in _order_arrivals(d):
        write_table(arrival.repartition(2), layout, "raw_orders")
    query = start_silver(d.spark, layout, "orders_silver", {"processingTime": "100 milliseconds"}, max_files=1, as_of=ORDERS_AS_OF)
    while query.isActive and not (query.lastProgress and query.lastProgress["batchId"] >= 1):
        query.awaitTermination(0.2)
    query.stop()
    _run(start_silver(d.spark, layout, "orders_silver", ONCE, max_files=1, as_of=ORDERS_AS_OF))
    return read_table(d.spark, layout, "orders_silver")


def _live_arrivals(d: Desk, *arrivals: tuple[DataFrame | None, DataFrame | None]) -> DataFrame:
    """Live orders after arrivals of syncs and actions at one stream."""
    layout = Layout(scratch_dir(d.spark, "live"))
    write_version(d.snapshot, layout, "market_snapshot_gold")
    for updates, actions in arrivals:
        if updates is not None:
            write_table(updates, layout, "live_order_updates")
        if actions is not None:
            write_table(actions, layout, "actions")
        _run(start_live_orders(d.spark, layout, ONCE, repeats="60 days", buckets=FEW_BUCKETS))
    return read_live_orders(d.spark, layout)


def _live_orders_interleaved(d: Desk) -> DataFrame:
    """A sync together with actions, more actions, and the sync again."""
    early = F.col("ts") < MIDWAY
    upstream = Layout(scratch_dir(d.spark, "upstream"))  # made once, as it is sent twice
    write_table(d.live, upstream, "live_order_updates")
    sync = read_table(d.spark, upstream, "live_order_updates")
    return _live_arrivals(d, (sync, d.actions.where(early)), (None, d.actions.where(~early)), (sync, None))


def _stream_actions_redelivered(d: Desk) -> DataFrame:
    """Actions of which some are delivered again two batches later."""
    early = F.col("ts") < MIDWAY
    again = d.actions.where(early & (F.col("action_id") % 3 == 0))
    return _live_arrivals(d, (d.live, d.actions.where(early)), (None, d.actions.where(~early)), (None, again))


_QUERIES: dict[str, Callable[[Desk], DataFrame]] = {
    "market_silver": lambda d: d.market,
    "orders_silver": lambda d: d.orders,
    "executions_silver": lambda d: d.executions,
    "order_analytics": lambda d: d.analytics,
    "market_snapshot": lambda d: d.snapshot,
    "trading_performance": lambda d: d.performance,
    "expectation_metrics": _expectation_metrics,
    "constraint_violations": _constraint_violations,
    "active_orders": lambda d: read_models.active_orders(d.orders, d.analytics),
    "market_listing": lambda d: read_models.market_listing(d.snapshot),
    "market_feed": lambda d: read_models.market_feed(d.snapshot),
    "market_ticker": lambda d: read_models.market_ticker(d.snapshot),
    "execution_listing": lambda d: read_models.execution_listing(d.analytics),
    "analytics_feed": lambda d: read_models.analytics_feed(d.analytics, limit=200),
    "trader_listing": lambda d: read_models.trader_listing(d.performance, d.traders),
    "performance_feed": lambda d: read_models.performance_feed(d.performance),
    "price_history_day": lambda d: read_models.price_history_day(d.market, MARKET_AS_OF),
    "price_history_ticker": _price_history,
    "price_history_stored": _price_history_stored,
    "price_history_day_stored": _price_history_day_stored,
    "audit_of_order": _audit_of_order,
    "prices_from_bronze": _prices_from_bronze,
    "order_summary_file": _order_summary_file,
    "live_orders_parsed": _live_orders_parsed,
    "orders_by_statement": _orders_by_statement,
    "hedge_instruments": lambda d: read_models.hedge_listing(d.instrument_catalog),
    "order_blotter": lambda d: read_models.order_blotter(d.live, "PENDING,PARTIAL", "SPY", limit=100),
    "blotter_fallback": lambda d: read_models.blotter_fallback(d.analytics, limit=100),
    "latest_raw_tick": lambda d: read_models.latest_raw_tick(d.raw_market_data),
    "order_search": lambda d: read_models.search_orders(d.orders, "vWaP"),
    "order_sort_nulls_last": lambda d: read_models.sort_orders(d.orders, "strategy", "desc"),
    "open_orders": lambda d: read_models.open_orders(d.raw_orders),
    "actionable_orders": lambda d: read_models.actionable_orders(d.orders),
    "kpi_row": lambda d: kpis.kpi_row(d.live, d.analytics),
    "dashboard_counters": lambda d: kpis.dashboard_counters(d.active, d.listing),
    "status_counts": lambda d: kpis.status_counts(d.orders),
    "orders_by_status": lambda d: kpis.orders_by_status(d.active),
    "order_summary": _order_summary,
    "by_strategy": lambda d: kpis.by_strategy(d.analytics),
    "slippage_by_etf": lambda d: kpis.slippage_by_etf(d.listing),
    "fill_by_type": lambda d: kpis.fill_by_type(d.listing),
    "orders_over_time": lambda d: kpis.orders_over_time(d.active),
    "slippage_by_trader": lambda d: kpis.slippage_by_trader(d.trader_days),
    "notional_by_trader": lambda d: kpis.notional_by_trader(d.trader_days),
    "volume_by_etf": lambda d: kpis.volume_by_etf(read_models.market_listing(d.snapshot)),
    "fill_vs_notional": lambda d: read_models.fill_vs_notional(d.analytics),
    "fill_vs_slippage": lambda d: read_models.fill_vs_slippage(d.analytics),
    "price_bounds": lambda d: kpis.price_bounds(_price_history(d)),
    "blotter_enriched": lambda d: read_models.blotter_enriched(d.live, d.analytics),
    "live_orders_fallback": lambda d: upsert.live_order_fallback(d.raw_orders),
    "live_orders_merge": _live_orders_merge,
    "actions_state": lambda d: d.after_actions.live_orders,
    "actions_audit": _actions_audit,
    "actions_rejected": lambda d: d.after_actions.rejected,
    "hedge_rejected": _hedge_rejected,
    "live_orders_rejected": _live_orders_rejected,
    "hedge_requests": lambda d: d.after_actions.hedge_requests,
    "audit_by_order": _audit_by_order,
    "adjustment_preview": lambda d: order_state.adjustment_preview(d.live, d.actions),
    "hedge_suggestions": lambda d: hedging.hedge_suggestions(
        read_models.actionable_orders(d.live), d.hedge_instruments),
    "row_counts": lambda d: table_row_counts({
        name: getattr(d, name) for name in ("raw_market_data", "raw_orders", "raw_executions", "actions")
    }),
    "market_snapshot_json": _market_snapshot_json,
    "stream_market_dedupe": _stream_market_dedupe,
    "stream_market_silver": _stream_market_silver,
    "stream_market_snapshot": _stream_market_snapshot,
    "stream_gold_refresh": _stream_gold_refresh,
    "stream_order_actions": _stream_order_actions,
    "stream_gold_incremental": _stream_gold_incremental,
    "stream_trader_days": _stream_trader_days,
    "stream_early_fills": _stream_early_fills,
    "stream_expectations": _stream_expectations,
    "stream_late_rows": _stream_late_rows,
    "stream_restarted": _stream_restarted,
    "live_orders_interleaved": _live_orders_interleaved,
    "stream_actions_redelivered": _stream_actions_redelivered,
}


def _bound(query: Callable[[Desk], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, directory: query(Desk(spark, directory))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(query) for name, query in _QUERIES.items()}
