"""Gold tables: execution quality per order, market snapshot, trader-day performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.columns import (
    Moment,
    bps_from,
    mean_of_rounded,
    moment,
    sum_of_rounded,
)
from tapeloom.schemas import OPEN_STATUSES, TABLES


def fills_per_order(executions: DataFrame) -> DataFrame:
    """Fills of each order. exec_id is never missing in silver, so it need not be read to count."""
    return executions.groupBy("order_id").agg(
        F.sum("fill_qty").alias("filled_qty"),
        F.count(F.lit(1)).alias("fill_count"),
        mean_of_rounded("slippage_bps", 2).alias("avg_slippage_bps"),
        sum_of_rounded("fill_notional", 2).alias("total_fill_notional"),
        F.avg("fill_price").alias("avg_fill_price"),
        F.min("exec_time").alias("first_fill_time"),
        F.max("exec_time").alias("last_fill_time"),
    )


def order_analytics_gold(orders: DataFrame, executions: DataFrame) -> DataFrame:
    """Execution quality of every silver order; fills are aggregated before the join.

    Orders without fills keep a NULL fill_count. fill_rate may exceed 1 and
    remaining_qty may be negative, since fills do not change the order.
    """
    qty, limit = F.col("qty"), F.col("price_limit")
    filled = F.coalesce(F.col("filled_qty"), F.lit(0))
    return (
        orders.join(fills_per_order(executions), "order_id", "left")
        .withColumns({
            "filled_qty": filled,
            "fill_rate": F.round(F.when(qty > 0, filled / qty).otherwise(0.0), 4),
            "remaining_qty": qty - filled,
            "vwap_vs_limit": F.round(bps_from(F.col("avg_fill_price"), limit), 2),
            "avg_slippage_bps": F.coalesce(F.col("avg_slippage_bps"), F.lit(0.0)),
        })
        .withColumn("estimated_completion_pct", F.round(F.col("fill_rate") * 100, 2))
        .select(*TABLES["order_analytics_gold"].columns)
    )


# Values of the latest tick that the snapshot shows. All of them are of fixed width,
# so the pass over the ticks is a hash aggregate.
_LATEST = (
    "last_price", "bid", "ask", "mid_price", "spread_bps",
    "volume", "cum_volume", "vwap", "relative_volume",
)


def market_snapshot_gold(market: DataFrame, as_of: Moment = None) -> DataFrame:
    """Latest tick per ticker with the statistics of the current day, in one pass.

    There are few tickers with very many ticks each, so nothing is ranked or
    shuffled by ticker: ticks are reduced to one row per (ticker, source) on the map
    side, then to one per ticker. (ticker, event_time) is unique in silver, so the
    latest tick needs no tie-break. Tickers without ticks today have NULL statistics
    and a change of 0.
    """
    at = F.col("event_time")
    price = F.col("last_price")
    today = at >= F.date_trunc("day", moment(as_of))
    per_source = market.groupBy("ticker", "source").agg(
        *[F.max_by(c, at).alias(c) for c in _LATEST],
        F.min(F.when(today, price)).alias("intraday_low"),
        F.max(F.when(today, price)).alias("intraday_high"),
        F.min_by(price, F.when(today & price.isNotNull(), at)).alias("open_price"),
        F.min(F.when(today & price.isNotNull(), at)).alias("opened_at"),
        F.max(F.when(today, F.col("cum_volume"))).alias("total_volume"),
        F.max(at).alias("event_time"),
    )
    change = (price - F.col("open_price")) / F.col("open_price") * 100
    opened = F.coalesce(F.col("open_price") > 0, F.lit(False))
    return (
        per_source.groupBy("ticker")
        .agg(
            F.max_by(F.struct(*_LATEST, "source"), at).alias("latest"),
            F.min("intraday_low").alias("intraday_low"),
            F.max("intraday_high").alias("intraday_high"),
            F.min_by("open_price", "opened_at").alias("open_price"),
            F.max("total_volume").alias("total_volume"),
            F.max(at).alias("event_time"),
        )
        .select("*", "latest.*")
        .withColumn("price_change_pct", F.round(F.when(opened, change).otherwise(0.0), 4))
        .select(*TABLES["market_snapshot_gold"].columns)
    )


def trading_performance_gold(analytics: DataFrame) -> DataFrame:
    """Orders, fill rates, slippage and notional per trader and day of creation."""
    status = F.col("status")
    return (
        analytics.groupBy("trader_id", F.to_date("created_at").alias("trade_date"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.count_if(status == "FILLED").alias("filled_orders"),
            F.count_if(status.isin(*OPEN_STATUSES)).alias("active_orders"),
            mean_of_rounded("fill_rate", 4).alias("avg_fill_rate"),
            F.coalesce(mean_of_rounded("avg_slippage_bps", 2), F.lit(0.0)).alias("avg_slippage_bps"),
            sum_of_rounded("notional_value", 2).alias("total_notional_usd"),
            sum_of_rounded("total_fill_notional", 2).alias("total_filled_notional_usd"),
            F.count_distinct("etf_ticker").alias("unique_etfs_traded"),
        )
        .withColumns({
            "fill_rate_pct": F.round(
                F.coalesce(
                    F.try_divide(F.col("filled_orders"), F.col("total_orders")) * 100, F.lit(0.0)
                ), 2),
            "participation_rate": F.round(F.col("avg_fill_rate") * 100, 2),
        })
        .select(*TABLES["trading_performance_gold"].columns)
    )
