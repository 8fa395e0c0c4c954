"""Silver tables. The same functions serve batch frames and micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.columns import Moment, bps_from, moment
from tapeloom.operators.quality import (
    EXECUTION_RULES,
    ORDER_RULES,
    TICK_RULES,
    expect_or_drop,
)
from tapeloom.schemas import TABLES

TICK_KEY = ("ticker", "event_time")

# The usual volume of one tick per ticker.
USUAL_VOLUME = {
    "SPY": 120_000.0,
    "QQQ": 85_000.0,
    "IVV": 95_000.0,
    "VTI": 40_000.0,
    "XLK": 25_000.0,
    "XLF": 30_000.0,
}


def unique_ticks(ticks: DataFrame, watermark: str = "2 minutes") -> DataFrame:
    """One tick per (ticker, event_time).

    A stream keeps the first arrival and bounds its state with the watermark. A
    batch keeps the smallest event_id; as an aggregate it collapses a hot key
    before the shuffle.
    """
    if ticks.isStreaming:
        return ticks.withWatermark("event_time", watermark).dropDuplicates(list(TICK_KEY))
    rest = [c for c in ticks.columns if c not in TICK_KEY]
    return (
        ticks.groupBy(*TICK_KEY)
        .agg(F.min_by(F.struct(*rest), "event_id").alias("tick"))
        .select(*TICK_KEY, "tick.*")
    )


def enriched_ticks(ticks: DataFrame, watermark: str = "2 minutes") -> DataFrame:
    """Unique ticks with mid price, spread, relative volume and move against VWAP."""
    usual = F.create_map(*[F.lit(x) for pair in USUAL_VOLUME.items() for x in pair])
    last, vwap = F.col("last_price"), F.col("vwap")
    return unique_ticks(ticks, watermark).withColumns({
        "mid_price": F.round((F.col("bid") + F.col("ask")) / 2, 4),
        "spread_bps": F.round(F.try_divide(F.col("ask") - F.col("bid"), last) * 10000, 2),
        "relative_volume": F.round(F.col("volume") / usual[F.col("ticker")], 3),
        "price_move_pct": F.round(F.try_divide(last - vwap, vwap) * 100, 4),
    }).select(*TABLES["market_data_silver"].columns)


def market_data_silver(ticks: DataFrame, watermark: str = "2 minutes") -> DataFrame:
    return expect_or_drop(enriched_ticks(ticks, watermark), TICK_RULES)


def enriched_orders(orders: DataFrame, etf_reference: DataFrame, as_of: Moment = None) -> DataFrame:
    """Orders with the attributes of their fund, notional and age.

    The join carries no hint: the optimizer broadcasts the dimension while its size
    is under the session's threshold and shuffles it beyond.
    """
    funds = etf_reference.select(
        F.col("ticker").alias("etf_ticker"),
        F.col("name").alias("etf_name"),
        "sector", "expense_ratio", "aum_bn",
    )
    age = F.unix_timestamp(moment(as_of)) - F.unix_timestamp("created_at")
    return orders.join(funds, "etf_ticker", "left").withColumns({
        "notional_value": F.round(F.col("qty") * F.col("price_limit"), 2),
        "time_in_market_sec": age,
    }).select(*TABLES["orders_silver"].columns)


def orders_silver(orders: DataFrame, etf_reference: DataFrame, as_of: Moment = None) -> DataFrame:
    return expect_or_drop(enriched_orders(orders, etf_reference, as_of), ORDER_RULES)


def enriched_executions(execs: DataFrame, orders: DataFrame, signed: bool = False) -> DataFrame:
    """Fills with the attributes of their order, slippage against arrival and notional.

    Slippage is positive when the fill is above arrival, for both sides; `signed`
    turns it round for SELL, so that positive always means a cost.

    Orders grow with the fills and are never broadcast. Both sides are partitioned by
    order_id, which the aggregation per order that follows uses again.
    """
    parents = orders.select(
        "order_id", "qty", "arrival_price", "etf_ticker", "trader_id", "direction"
    ).hint("merge")
    return priced_fills(execs.join(parents, "order_id", "left"), signed)


def priced_fills(fills: DataFrame, signed: bool = False) -> DataFrame:
    """Slippage and notional of fills that have the attributes of their order."""
    slippage = bps_from(F.col("fill_price"), F.col("arrival_price"))
    if signed:
        slippage = F.when(F.col("direction") == "SELL", -slippage).otherwise(slippage)
    arrived = F.coalesce(F.col("arrival_price") > 0, F.lit(False))
    return fills.withColumns({
        "slippage_bps": F.round(F.when(arrived, slippage).otherwise(0.0), 2),
        "fill_notional": F.round(F.col("fill_qty") * F.col("fill_price"), 2),
    }).select(*TABLES["executions_silver"].columns)


def _parents(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("order_id").alias("parent_id"), "created_at", "qty", "arrival_price", "etf_ticker", "trader_id", "direction"
    )


def _near(within: str) -> Column:
    """A fill belongs to an order of its id whose time is at most `within` away."""
    return F.expr(
        "order_id = parent_id AND exec_time >= created_at - INTERVAL {0} AND exec_time <= created_at + INTERVAL {0}".format(within)
    )


def matched_executions(execs: DataFrame, orders: DataFrame, within: str) -> DataFrame:
    """Silver fills of the orders that they belong to. It carries no hint: a small batch is broadcast to what is kept."""
    return priced_fills(execs.join(_parents(orders), _near(within)))


def unmatched_executions(execs: DataFrame, orders: DataFrame, within: str) -> DataFrame:
    """Silver fills, without attributes, that belong to no order."""
    alone = execs.join(_parents(orders), _near(within), "left_anti")
    kinds = {f.name: f.dataType for f in TABLES["executions_silver"].schema}
    return priced_fills(alone.withColumns({
        c: F.lit(None).cast(kinds[c]) for c in ("qty", "arrival_price", "etf_ticker", "trader_id", "direction")
    }))


def executions_silver(execs: DataFrame, orders: DataFrame, signed: bool = False) -> DataFrame:
    return expect_or_drop(enriched_executions(execs, orders, signed), EXECUTION_RULES)
