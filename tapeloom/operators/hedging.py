"""Hedge suggestions for many orders at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.columns import or_default


def hedge_suggestions(
    orders: DataFrame, instruments: DataFrame, hedge_type: str | None = None
) -> DataFrame:
    """Every instrument on an order's own fund, with a suggested side and size.

    Futures cover the notional, options the delta-adjusted quantity, at least one
    contract either way. Instruments are few; the optimizer broadcasts them while
    their size is under the session's threshold.
    """
    if hedge_type:
        instruments = instruments.where(F.col("type") == hedge_type)
    candidates = instruments.select(
        F.col("underlying").alias("etf_ticker"), "instrument_id", "type", "contract_size", "delta"
    )
    qty = F.coalesce(F.col("qty"), F.lit(0))
    notional = qty * F.coalesce("price_limit", F.lit(0.0))
    futures = F.ceil(notional / (or_default("price_limit", 500.0) * or_default("contract_size", 50)))
    options = F.ceil(qty / or_default("contract_size", 100) / F.abs(or_default("delta", 0.3)))
    contracts, lot = F.col("suggested_qty"), or_default("contract_size", 1)
    ratio = contracts * lot / or_default("qty", 1) * 100
    return (
        orders.join(candidates, "etf_ticker")
        .withColumn("suggested_qty", F.greatest(
            F.lit(1).cast("long"), F.when(F.col("type") == "FUTURES", futures).otherwise(options)
        ))
        .select(
            "order_id", "etf_ticker", "instrument_id", F.col("type").alias("hedge_type"),
            F.when(F.col("direction") == "BUY", "SELL").otherwise("BUY").alias("hedge_direction"),
            "suggested_qty",
            F.floor(ratio + 0.5).alias("hedge_ratio_pct"),
            F.abs(F.col("delta") * contracts * lot).alias("delta_offset"),
        )
    )
