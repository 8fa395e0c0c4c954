"""The datasets behind the desk's screens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.columns import (
    Moment,
    category,
    half_up_value,
    is_up,
    moment,
    number_or_zero,
    slippage_band,
)
from tapeloom.schemas import CLOSED_STATUSES, OPEN_STATUSES
from tapeloom.sources.layout import Layout, read_table

SEARCHED = ("order_id", "etf_ticker", "trader_id", "strategy")


def newest(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest orders first; order_id settles equal times."""
    ordered = df.orderBy(F.desc("created_at"), "order_id")
    return ordered if limit is None else ordered.limit(limit)


# -- orders ------------------------------------------------------------------


def order_progress(orders: DataFrame, analytics: DataFrame) -> DataFrame:
    """Every silver order with its progress; orders without analytics show zeros."""
    progress = analytics.select(
        "order_id", "filled_qty", "fill_rate", "avg_slippage_bps", "estimated_completion_pct"
    )
    return orders.join(progress, "order_id", "left").select(
        "order_id", "etf_ticker", "trader_id", "direction", "qty",
        F.coalesce("filled_qty", F.lit(0)).alias("filled_qty"),
        "price_limit", "order_type", "status", "strategy", "created_at", "notional_value",
        F.coalesce(F.col("fill_rate") * 100, F.lit(0.0)).alias("fill_rate_pct"),
        F.coalesce("avg_slippage_bps", F.lit(0.0)).alias("avg_slippage_bps"),
        F.coalesce("estimated_completion_pct", F.lit(0.0)).alias("estimated_completion_pct"),
    )


def active_orders(orders: DataFrame, analytics: DataFrame) -> DataFrame:
    return newest(order_progress(orders, analytics))


def execution_rows(analytics: DataFrame) -> DataFrame:
    """Execution quality as the charts and counters use it, in no order."""
    return analytics.select(
        "order_id", "trader_id", "etf_ticker", "direction", "qty", "filled_qty",
        (F.col("fill_rate") * 100).alias("fill_rate_pct"),
        "avg_slippage_bps", "avg_fill_price", "notional_value", "order_type", "strategy",
        "status", "created_at", "vwap_vs_limit",
    )


def execution_listing(analytics: DataFrame) -> DataFrame:
    return newest(execution_rows(analytics))


def analytics_feed(analytics: DataFrame, limit: int | None = None) -> DataFrame:
    """Analytics rows as the application loads them, newest first; `limit` is the size of a page."""
    return newest(analytics.select(
        "order_id", "trader_id", "etf_ticker", "direction", "qty", "filled_qty", "remaining_qty",
        "fill_rate", "avg_slippage_bps", "avg_fill_price", "notional_value",
        "estimated_completion_pct", "vwap_vs_limit", "order_type", "strategy", "status",
        "created_at", "first_fill_time", "last_fill_time",
    ), limit)


def order_blotter(
    orders: DataFrame,
    statuses: str | Sequence[str] | None = None,
    ticker: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Newest orders, optionally of some statuses (a list or comma separated) and one ticker."""
    if statuses:
        wanted = statuses.split(",") if isinstance(statuses, str) else list(statuses)
        orders = orders.where(F.col("status").isin(*wanted))
    if ticker:
        orders = orders.where(F.col("etf_ticker") == ticker)
    return newest(orders, limit)


def blotter_fallback(analytics: DataFrame, limit: int | None = None) -> DataFrame:
    """The blotter from gold, for when there is no live order table."""
    return newest(analytics.select(
        "order_id", "etf_ticker", "trader_id", "direction", "qty",
        F.coalesce("filled_qty", F.lit(0)).alias("filled_qty"),
        "remaining_qty", "order_type", "status", "strategy", "created_at", "notional_value",
        F.round(F.col("fill_rate") * 100, 1).alias("fill_pct"),
        F.round("avg_slippage_bps", 2).alias("avg_slippage_bps"),
    ), limit)


def blotter_enriched(orders: DataFrame, analytics: DataFrame) -> DataFrame:
    """Blotter rows with fill percentage, bar width, slippage band and whether they can be acted on.

    Of several analytics rows for one order the last of the newest-first list, that
    is the oldest, is shown; of equally old ones the smallest values. Both aggregates hash,
    and the second needs no shuffle.
    """
    values = ("fill_rate", "avg_slippage_bps")
    oldest = analytics.repartition("order_id").groupBy("order_id", "created_at").agg(
        *[F.min(v).alias(v) for v in values]
    )
    shown = oldest.groupBy("order_id").agg(
        *[F.min_by(v, "created_at").alias(f"shown_{v}") for v in values], F.lit(True).alias("has_analytics")
    )
    a = {v: F.col(f"shown_{v}") for v in values}
    own = F.when(
        (F.col("filled_qty") != 0) & (F.col("qty") != 0), F.col("filled_qty") / F.col("qty") * 100
    ).otherwise(0.0)
    return (
        orders.join(shown, "order_id", "left")
        .withColumns({
            "fill_pct": F.when(F.col("has_analytics"), a["fill_rate"] * 100).otherwise(own),
            "slippage_bps": a["avg_slippage_bps"],
        })
        .select(
            "order_id", "etf_ticker", "direction", "qty",
            F.coalesce("filled_qty", F.lit(0)).alias("filled_qty"),
            "price_limit", "strategy", "order_type", "status", "created_at",
            "fill_pct",
            F.least(F.lit(100.0), "fill_pct").alias("fill_bar_pct"),
            "slippage_bps",
            slippage_band("slippage_bps").alias("slippage_band"),
            (~F.col("status").isin(*CLOSED_STATUSES)).alias("actionable"),
        )
    )


def open_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status").isin(*OPEN_STATUSES)).select(
        "order_id", "etf_ticker", "direction", "qty", "arrival_price"
    )


def actionable_orders(orders: DataFrame) -> DataFrame:
    return orders.where(~F.col("status").isin(*CLOSED_STATUSES))


def status_tab(orders: DataFrame, status: str = "ALL") -> DataFrame:
    return orders if status == "ALL" else orders.where(F.col("status") == status)


def search_orders(df: DataFrame, term: str | None) -> DataFrame:
    """Rows whose id, ticker, trader or strategy contains the term, ignoring case."""
    if not term:
        return df
    found = F.lit(False)
    for name in SEARCHED:
        found = found | F.coalesce(F.lower(name).contains(term.lower()), F.lit(False))
    return df.where(found)


def sort_orders(df: DataFrame, column: str = "created_at", direction: str = "desc") -> DataFrame:
    """Sort by any column, strings ignoring case, missing values last either way."""
    if direction not in ("asc", "desc"):
        raise ValueError(f"direction {direction!r}")
    key: Column = F.lower(column) if dict(df.dtypes)[column] == "string" else F.col(column)
    order = key.asc_nulls_last() if direction == "asc" else key.desc_nulls_last()
    return df.orderBy(order, "order_id")


# -- market ------------------------------------------------------------------


def market_listing(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        "ticker", "last_price", "bid", "ask", "spread_bps", "total_volume", "vwap",
        "intraday_high", "intraday_low", "price_change_pct", "relative_volume", "event_time",
    ).orderBy("ticker")


def market_feed(snapshot: DataFrame) -> DataFrame:
    """The snapshot as the application loads it."""
    return snapshot.select(
        "ticker", "last_price", "bid", "ask", "mid_price", "spread_bps", "volume",
        "total_volume", "vwap", "intraday_high", "intraday_low", "open_price",
        "price_change_pct", "relative_volume", "event_time",
    ).orderBy("ticker")


def market_ticker(snapshot: DataFrame) -> DataFrame:
    """The ticker tape: last price and change with its direction."""
    return snapshot.select(
        "ticker", "last_price", "bid", "ask",
        number_or_zero("price_change_pct").alias("change_pct"),
        is_up("price_change_pct").alias("is_up"),
    ).orderBy("ticker")


def latest_raw_tick(ticks: DataFrame) -> DataFrame:
    """Latest bronze tick per ticker; event_id settles equal times.

    The last time per ticker is a hash aggregate that keeps one small row per ticker and
    task. Ties are settled on the ticks of that time only.
    """
    last = ticks.groupBy(F.col("ticker").alias("at_ticker")).agg(F.max("event_time").alias("at_time"))
    here = F.col("ticker").eqNullSafe(F.col("at_ticker")) & F.col("event_time").eqNullSafe(F.col("at_time"))
    ticks = ticks.join(last, here)
    shown = F.struct("last_price", "bid", "ask", "volume", "cum_volume", "vwap", "event_time")
    return (
        ticks.groupBy("ticker")
        .agg(F.max_by(shown, F.struct("event_time", "event_id")).alias("t"))
        .select(
            "ticker", "t.last_price", "t.bid", "t.ask", "t.volume",
            F.col("t.cum_volume").alias("total_volume"), "t.vwap", "t.event_time",
        )
        .orderBy("ticker")
    )


def price_history_day(market: DataFrame, as_of: Moment = None) -> DataFrame:
    """All tickers over the trailing day."""
    start = moment(as_of) - F.expr("INTERVAL 1 DAY")
    return (
        market.where(F.col("event_time") >= start)
        .select("ticker", "event_time", "last_price", "vwap", "bid", "ask", "volume")
        .orderBy("ticker", "event_time")
    )


def price_history(
    ticks: DataFrame,
    as_of: Moment = None,
    ticker: str = "SPY",
    hours: int = 8,
    limit: int | None = None,
    latest: bool = False,
) -> DataFrame:
    """One ticker over the trailing hours, ascending.

    A limit keeps the oldest rows of the window; `latest` keeps the newest instead.
    """
    start = moment(as_of) - F.make_interval(hours=F.lit(hours))
    window = ticks.where((F.col("ticker") == ticker) & (F.col("event_time") >= start))
    if latest and limit is not None:
        window = window.orderBy(F.desc("event_time"), F.desc("event_id")).limit(limit)
    ordered = window.orderBy("event_time", "event_id")
    if limit is not None and not latest:
        ordered = ordered.limit(limit)
    return ordered.select("event_time", "last_price", "bid", "ask", "volume", "vwap")


def stored_price_history(
    spark: SparkSession,
    layout: Layout,
    as_of: Moment = None,
    ticker: str = "SPY",
    hours: int = 8,
    name: str = "raw_market_data",
) -> DataFrame:
    """`price_history` of a stored table, of which only the day folders of the window are read."""
    start = moment(as_of) - F.make_interval(hours=F.lit(hours))
    return price_history(read_table(spark, layout, name, since=start), as_of, ticker, hours)


def stored_price_history_day(spark: SparkSession, layout: Layout, as_of: Moment = None) -> DataFrame:
    """`price_history_day` of stored silver, of which only the folders of the trailing day are read."""
    start = moment(as_of) - F.expr("INTERVAL 1 DAY")
    return price_history_day(read_table(spark, layout, "market_data_silver", since=start), as_of)


# -- traders and instruments -------------------------------------------------


def trader_days(performance: DataFrame, traders: DataFrame) -> DataFrame:
    """Trader days with name and desk, in no order."""
    who = traders.select("trader_id", F.col("name").alias("trader_name"), "desk")
    return performance.join(who, "trader_id", "left").select(
        "trader_id", "trader_name", "desk", "trade_date", "total_orders", "filled_orders",
        "active_orders", "fill_rate_pct", "avg_slippage_bps", "total_notional_usd",
        "total_filled_notional_usd", "unique_etfs_traded",
    )


def trader_listing(performance: DataFrame, traders: DataFrame) -> DataFrame:
    return trader_days(performance, traders).orderBy(
        F.desc("trade_date"), F.desc("total_notional_usd"), "trader_id"
    )


def performance_feed(performance: DataFrame) -> DataFrame:
    """Trader days as the application loads them."""
    return performance.orderBy(F.desc("trade_date"), "trader_id")


def hedge_listing(instruments: DataFrame) -> DataFrame:
    return instruments.select(
        "instrument_id", "type", "underlying", "expiry", "strike", "contract_size", "delta"
    ).orderBy("type", "underlying", "instrument_id")


# -- scatter charts ----------------------------------------------------------


def fill_vs_notional(analytics: DataFrame) -> DataFrame:
    """Points of fill rate against notional, coloured by strategy and sized by quantity."""
    return analytics.select(
        "order_id", "notional_value", (F.col("fill_rate") * 100).alias("fill_rate_pct"), "strategy", "qty"
    )


def fill_vs_slippage(analytics: DataFrame, limit: int | None = None) -> DataFrame:
    """Points of fill rate against slippage of the orders that have a fill rate; of the newest, if limited."""
    rated = analytics.where(F.col("fill_rate").isNotNull())
    return (rated if limit is None else newest(rated, limit)).select(
        "order_id",
        half_up_value(F.col("fill_rate") * 100).alias("x"),
        half_up_value(F.col("avg_slippage_bps")).alias("y"),
        category("strategy").alias("strategy"),
    )
