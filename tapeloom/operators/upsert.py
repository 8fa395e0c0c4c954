"""Upsert, and the live order table as its target."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.columns import Moment, moment
from tapeloom.operators.quality import Enforced, enforce, with_defaults
from tapeloom.schemas import TABLES

# What a sync replaces in an order that is already live.
SYNCED = ("status", "filled_qty", "avg_fill_price", "avg_slippage_bps", "fill_rate")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Iterable[str],
    update_cols: Iterable[str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Target after the source is merged in: update on a key match, else insert.

    Only `update_cols` of a matched row change. Inserted rows take `defaults` for
    missing values. A key that occurs twice in the source is an error: keys are counted by a
    hash aggregate, whose shuffle the join with the target goes on from.
    """
    keys, update_cols = list(keys), list(update_cols)
    source = with_defaults(source, defaults or {})
    incoming = [c for c in source.columns if c not in keys]
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"counted_{k}"))
    counts = source.groupBy(*[F.col(k).alias(f"counted_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    once = source.select(*keys, F.struct(*incoming).alias("s")).join(counts, same).select(*keys, "s", "n")
    kept = [c for c in target.columns if c not in keys]
    current = target.select(*keys, F.struct(*kept).alias("t"))
    repeated = F.raise_error(F.concat(
        F.lit("merge source repeats key "), F.to_json(F.struct(*keys))
    ))
    s, t = F.col("s"), F.col("t")
    matched, new = s.isNotNull() & t.isNotNull(), t.isNull()

    def value(name: str) -> Column:
        if name not in incoming:
            return t[name]
        if name in update_cols:
            return F.when(s.isNotNull(), s[name]).otherwise(t[name])
        return F.when(new, s[name]).otherwise(t[name])

    checked = once.withColumn("s", F.when(F.col("n") > 1, repeated).otherwise(F.col("s"))).drop("n")
    merged = current.join(checked, keys, "full_outer")
    return merged.select(*keys, *[value(c).alias(c) for c in kept]).select(*target.columns)


def live_order_source(orders: DataFrame, analytics: DataFrame) -> DataFrame:
    """Silver orders with their progress, in the shape of the live table."""
    progress = analytics.select(
        "order_id", "filled_qty", "avg_fill_price", "avg_slippage_bps", "fill_rate"
    )
    return orders.join(progress, "order_id", "left").select(
        "order_id", "etf_ticker", "etf_name", "trader_id", "direction", "qty",
        F.coalesce("filled_qty", F.lit(0)).cast("long").alias("filled_qty"),
        "price_limit", "order_type", "status", "strategy", "created_at", "arrival_price",
        "notional_value", "avg_fill_price",
        F.coalesce("avg_slippage_bps", F.lit(0.0)).alias("avg_slippage_bps"),
        F.coalesce("fill_rate", F.lit(0.0)).alias("fill_rate"),
    )


def live_order_fallback(raw_orders: DataFrame) -> DataFrame:
    """The same shape from bronze alone, for when silver does not exist yet."""
    return raw_orders.select(
        "order_id", "etf_ticker", F.lit(None).cast("string").alias("etf_name"), "trader_id",
        "direction",
        F.coalesce("qty", F.lit(0)).alias("qty"),
        F.lit(0).cast("long").alias("filled_qty"),
        "price_limit", "order_type", "status", "strategy", "created_at", "arrival_price",
        (F.col("qty").cast("double") * F.col("price_limit")).alias("notional_value"),
        F.lit(None).cast("double").alias("avg_fill_price"),
        F.lit(0.0).alias("avg_slippage_bps"),
        F.lit(0.0).alias("fill_rate"),
    )


def parse_live_order_rows(rows: DataFrame) -> DataFrame:
    """Type rows that arrive as text; what does not parse becomes missing or its default."""
    types = {f.name: f.dataType.simpleString() for f in TABLES["live_orders"].schema}
    zero = {"qty", "filled_qty", "avg_slippage_bps", "fill_rate"}

    def parsed(name: str) -> Column:
        value = F.col(name).try_cast(types[name])
        return (F.coalesce(value, F.lit(0).cast(types[name])) if name in zero else value).alias(name)

    return rows.select(*[parsed(c) for c in rows.columns])


def as_live_orders(source: DataFrame, as_of: Moment = None) -> DataFrame:
    """A first live table from a sync source."""
    table = TABLES["live_orders"]
    rows = with_defaults(source, {
        **table.defaults,
        "last_updated": moment(as_of),
        "assigned_hedge_id": F.lit(None).cast("string"),
    })
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])


def accepted_live_orders(rows: DataFrame, one_per_key: bool = False) -> Enforced:
    """Rows that the live table takes by its declared constraints, and the others with a reason."""
    table = TABLES["live_orders"]
    return enforce(rows, table.keys, table.required, table.domains, one_per_key)


def sync_live_orders(live: DataFrame, source: DataFrame, as_of: Moment = None) -> DataFrame:
    """Merge upstream progress into the live orders.

    Upstream wins on status and progress, also over a trader's cancellation, while
    adjusted size, price, notional and the hedge stay.
    """
    source = source.withColumn("last_updated", moment(as_of))
    return merge_upsert(
        live, source, TABLES["live_orders"].keys, (*SYNCED, "last_updated"),
        {**TABLES["live_orders"].defaults, "last_updated": moment(as_of)},
    )
