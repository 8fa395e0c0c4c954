"""Gold tables that follow the batch: sums per order and per trader, day and fund, kept in buckets.

A batch of silver rows adds its fills to the sums of their orders. What the touched orders add to their
trader's day changes from their old row to the new one, so the old contribution is taken off and
the new one added: counts and sums of integers, which are exact in any order. Both are summed over the
whole touched buckets, without a join, since the orders in them that did not change cancel out. Only the buckets
of touched orders, and of the days of their traders, are read and written.

Fills may precede their order: their sums wait, and the order is shown once it arrives. An
order that arrives again takes its newest row, by (created_at, status) and the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.columns import bps_from, exact_sum, mean_of_units
from tapeloom.schemas import OPEN_STATUSES, TABLES
from tapeloom.sources.buckets import BUCKETS, BucketTable
from tapeloom.sources.layout import Layout

_ATTRIBUTES = (
    "created_at timestamp", "status string", "trader_id string", "etf_ticker string", "etf_name string", "direction string",
    "qty int", "price_limit double", "notional_value double", "order_type string", "strategy string",
)
_FILL_SUMS = {
    "filled_qty": "bigint", "fill_count": "bigint", "slippage": "decimal(38,0)", "slippages": "bigint",
    "notional": "decimal(38,0)", "price": "double", "prices": "bigint",
}
_FILL_COLUMNS = ("fill_qty", "fill_price", "fill_notional", "slippage_bps", "exec_time")
ORDERS = ", ".join([
    "order_id string", f"attributes struct<{', '.join(a.replace(' ', ': ') for a in _ATTRIBUTES)}>",
    *(f"{name} {kind}" for name, kind in _FILL_SUMS.items()), "first_fill_time timestamp", "last_fill_time timestamp",
])
_DAY_SUMS = {
    "orders": "bigint", "filled": "bigint", "active": "bigint", "fill_rate": "decimal(38,0)", "fill_rates": "bigint",
    "slippage": "decimal(38,0)", "slippages": "bigint", "notional": "decimal(38,0)", "notionals": "bigint",
    "filled_notional": "decimal(38,0)", "filled_notionals": "bigint",
}
DAYS = ", ".join(["trader_id string", "trade_date date", "etf_ticker string", *(f"{n} {k}" for n, k in _DAY_SUMS.items())])


def order_sums(layout: Layout, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(layout, "order_sums", ("order_id",), ORDERS, buckets)


def trader_day_sums(layout: Layout, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(layout, "trader_day_sums", ("trader_id", "trade_date"), DAYS, buckets)


def trader_day_rows(layout: Layout, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(layout, "trader_days", ("trader_id", "trade_date"), TABLES["trading_performance_gold"].ddl, buckets)


# -- orders ----------------------------------------------------------------------------------


def changes_of(orders: DataFrame | None = None, executions: DataFrame | None = None) -> DataFrame:
    """Silver orders and fills as rows of one shape; also of streams."""
    attributes = F.struct(*(a.split(" ")[0] for a in _ATTRIBUTES))
    kinds = {f.name: f.dataType for f in TABLES["executions_silver"].schema}
    fill = f"struct<{', '.join(f'{c}: {kinds[c].simpleString()}' for c in _FILL_COLUMNS)}>"
    kind = f"struct<{', '.join(a.replace(' ', ': ') for a in _ATTRIBUTES)}>"
    parts = []
    if orders is not None:
        parts.append(orders.select("order_id", attributes.cast(kind).alias("attributes"), F.lit(None).cast(fill).alias("fill")))
    if executions is not None:
        parts.append(executions.select("order_id", F.lit(None).cast(kind).alias("attributes"), F.struct(*_FILL_COLUMNS).cast(fill).alias("fill")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def sums_of(changes: DataFrame) -> DataFrame:
    """The sums of the fills of each order, and its attributes if it is among the changes."""
    is_fill = F.col("fill").isNotNull()
    none = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind)
    found = {
        "filled_qty": F.sum("fill.fill_qty"),
        "fill_count": F.count_if(is_fill),
        "slippage": exact_sum("fill.slippage_bps"),
        "slippages": F.count("fill.slippage_bps"),
        "notional": exact_sum("fill.fill_notional"),
        "price": F.sum("fill.fill_price"),
        "prices": F.count("fill.fill_price"),
    }
    return changes.groupBy("order_id").agg(
        F.max("attributes").alias("attributes"),
        *(none(value, _FILL_SUMS[name]).alias(name) for name, value in found.items()),
        F.min("fill.exec_time").alias("first_fill_time"), F.max("fill.exec_time").alias("last_fill_time"),
    )


def merged(before: DataFrame, more: DataFrame) -> DataFrame:
    """The sums of both, by order."""
    return summed(before.unionByName(more), "order_id")


def summed(sums: DataFrame, *keys: str) -> DataFrame:
    return sums.groupBy(*keys).agg(
        F.max("attributes").alias("attributes"),
        *(F.sum(name).cast(kind).alias(name) for name, kind in _FILL_SUMS.items()),
        F.min("first_fill_time").alias("first_fill_time"), F.max("last_fill_time").alias("last_fill_time"),
    )


def analytics_of(sums: DataFrame) -> DataFrame:
    """The gold rows of the orders that have arrived."""
    qty, limit, has_fills = F.col("qty"), F.col("price_limit"), F.col("fill_count") > 0
    return (
        sums.where(F.col("attributes").isNotNull())
        .select("*", "attributes.*")
        .withColumns({
            "fill_rate": F.round(F.when(qty > 0, F.col("filled_qty") / qty).otherwise(0.0), 4),
            "remaining_qty": qty - F.col("filled_qty"),
            "fill_count": F.when(has_fills, F.col("fill_count")),
            "avg_fill_price": F.when(F.col("prices") > 0, F.col("price") / F.col("prices")),
            "avg_slippage_bps": F.coalesce(mean_of_units(F.col("slippage"), F.col("slippages"), 2), F.lit(0.0)),
            "total_fill_notional": F.when(F.col("prices") > 0, F.col("notional").cast("double") / 100),
        })
        .withColumns({
            "vwap_vs_limit": F.round(bps_from(F.col("avg_fill_price"), limit), 2),
            "estimated_completion_pct": F.round(F.col("fill_rate") * 100, 2),
        })
        .select(*TABLES["order_analytics_gold"].columns)
    )


# -- traders' days ---------------------------------------------------------------------------


def day_sums(analytics: DataFrame) -> DataFrame:
    """What orders add to their trader, day and fund."""
    status = F.col("status")
    none = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind)
    found = {
        "orders": F.count(F.lit(1)), "filled": F.count_if(status == "FILLED"), "active": F.count_if(status.isin(*OPEN_STATUSES)),
        "fill_rate": exact_sum("fill_rate", 4), "fill_rates": F.count("fill_rate"),
        "slippage": exact_sum("avg_slippage_bps"), "slippages": F.count("avg_slippage_bps"),
        "notional": exact_sum("notional_value"), "notionals": F.count("notional_value"),
        "filled_notional": exact_sum("total_fill_notional"), "filled_notionals": F.count("total_fill_notional"),
    }
    return analytics.groupBy("trader_id", F.to_date("created_at").alias("trade_date"), "etf_ticker").agg(
        *(none(value, _DAY_SUMS[name]).alias(name) for name, value in found.items())
    )


def taken_off(sums: DataFrame) -> DataFrame:
    return sums.select("trader_id", "trade_date", "etf_ticker", *((-F.col(n)).cast(k).alias(n) for n, k in _DAY_SUMS.items()))


def merged_days(*sums: DataFrame) -> DataFrame:
    rows = sums[0]
    for more in sums[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("trader_id", "trade_date", "etf_ticker").agg(*(F.sum(n).cast(k).alias(n) for n, k in _DAY_SUMS.items()))


def changed_days(delta: DataFrame) -> DataFrame:
    """The rows that are not all zero: what orders of a touched bucket that are as they were add and take off is the same."""
    return delta.where(F.greatest(*(F.abs(F.col(n)).cast("decimal(38,0)") for n in _DAY_SUMS)) > 0)


def performance_of(sums: DataFrame) -> DataFrame:
    """The gold rows of traders' days from their sums by fund. A fund counts while orders of it are left."""
    total = lambda name: F.sum(name)
    mean = lambda value, n, places: mean_of_units(total(value), total(n), places)
    units = lambda value, n: F.when(total(n) > 0, total(value).cast("double") / 100)
    return (
        sums.groupBy("trader_id", "trade_date")
        .agg(
            total("orders").alias("total_orders"), total("filled").alias("filled_orders"), total("active").alias("active_orders"),
            mean("fill_rate", "fill_rates", 4).alias("avg_fill_rate"),
            F.coalesce(mean("slippage", "slippages", 2), F.lit(0.0)).alias("avg_slippage_bps"),
            units("notional", "notionals").alias("total_notional_usd"),
            units("filled_notional", "filled_notionals").alias("total_filled_notional_usd"),
            F.count_if(F.col("etf_ticker").isNotNull() & (F.col("orders") > 0)).alias("unique_etfs_traded"),
        )
        .where("total_orders > 0")
        .withColumns({
            "fill_rate_pct": F.round(F.col("filled_orders") / F.col("total_orders") * 100, 2),
            "participation_rate": F.round(F.col("avg_fill_rate") * 100, 2),
        })
        .select(*TABLES["trading_performance_gold"].columns)
    )


# -- a batch ---------------------------------------------------------------------------------


def apply_changes(spark: SparkSession, layout: Layout, changes: DataFrame, batch: int, buckets: int = BUCKETS) -> None:
    """Add a batch of silver rows to the sums of their orders, and what that changes to their traders' days."""
    orders, days, rows = (t(layout, buckets) for t in (order_sums, trader_day_sums, trader_day_rows))
    new = sums_of(changes).persist()
    try:
        touched = orders.touched(new)
        if not touched:
            return
        before = orders.read(spark, touched, batch)
        orders.write(summed(orders.spread(before.unionByName(new), touched), "bucket", "part", "order_id"), batch)
        old, now = (day_sums(analytics_of(rows)) for rows in (before, orders.read(spark, touched, batch + 1)))
        delta = changed_days(merged_days(taken_off(old), now)).persist()
        if of_days := days.touched(delta):
            days.write(merged_days(days.read(spark, of_days, batch), delta), batch)
            rows.write(performance_of(days.read(spark, of_days, batch + 1)), batch)
        delta.unpersist()
    finally:
        new.unpersist()
    for table in (orders, days, rows):
        table.drop_old(spark)


def read_order_analytics(spark: SparkSession, layout: Layout) -> DataFrame:
    return analytics_of(order_sums(layout).read(spark))


def read_trading_performance(spark: SparkSession, layout: Layout) -> DataFrame:
    return trader_day_rows(layout).read(spark)


def order_progress(spark: SparkSession, layout: Layout, order_ids: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The gold rows of some orders; only their buckets are read."""
    table = order_sums(layout, buckets)
    wanted = spark.createDataFrame([(i,) for i in order_ids], "order_id string")
    found = table.read(spark, table.touched(wanted)).where(F.col("order_id").isin(*order_ids))
    return analytics_of(found)
