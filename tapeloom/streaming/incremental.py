"""Streams whose cost follows the batch: fills matched with orders that come before or after them, gold by touched buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeloom.plans.incremental import apply_changes, changes_of
from tapeloom.session import tune
from tapeloom.sources.buckets import BUCKETS
from tapeloom.sources.layout import Layout
from tapeloom.streaming.jobs import ONCE, Trigger, _each_batch, _source
from tapeloom.streaming.matching import match_batch, tagged


def start_matched_executions(
    spark: SparkSession, layout: Layout, trigger: Trigger = ONCE, within: str = "30 days", late: str = "1 day",
    max_files: int | None = None,
) -> StreamingQuery:
    """Stream fills into silver; a fill that arrives before its order waits for it.

    Orders and fills that are still to be matched are kept in stored parts (`matching`), and nothing else of the
    history is read. It takes the place of `start_silver(..., "executions_silver")`.
    """
    tune(spark, streaming=True)

    def handle(batch: DataFrame, batch_id: int) -> None:
        fills, orders = (batch.where(F.col(c).isNotNull()).select(f"{c}.*") for c in ("fill", "order"))
        match_batch(batch.sparkSession, layout, fills, orders, batch_id, within, late)

    rows = tagged(_source(spark, layout, "raw_executions", max_files), _source(spark, layout, "raw_orders", max_files))
    return _each_batch(rows, layout, "matched_executions", trigger, handle)


def start_order_gold(
    spark: SparkSession, layout: Layout, trigger: Trigger = ONCE, max_files: int | None = None, buckets: int = BUCKETS
) -> StreamingQuery:
    """Keep order analytics and traders' days up to date from new silver rows alone.

    The number of buckets stays as it was at the first batch. `read_order_analytics` and `read_trading_performance` of `plans.incremental` read what it keeps.
    """
    tune(spark, streaming=True)
    changes = changes_of(
        _source(spark, layout, "orders_silver", max_files), _source(spark, layout, "executions_silver", max_files)
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        apply_changes(batch.sparkSession, layout, batch, batch_id, buckets)

    return _each_batch(changes, layout, "order_gold_by_batch", trigger, handle)
