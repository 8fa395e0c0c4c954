"""Desk KPIs, counters and chart aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.columns import (
    category,
    exact_sum,
    half_up,
    number_or_zero,
    slippage_grade,
    slippage_side,
    sum_of_rounded,
)
from tapeloom.plans.read_models import newest
from tapeloom.schemas import OPEN_STATUSES, STATUSES


def _total(value: str, places: int) -> Column:
    """Sum in units of the last place; missing values count as zero."""
    return F.coalesce(exact_sum(number_or_zero(value), places), F.lit(0).cast("decimal(38,0)"))


def _mean(value: str, places: int = 2) -> Column:
    """Unrounded mean of a rounded value, independent of the order of summation."""
    n = F.count(value)
    return F.when(n > 0, exact_sum(value, places).cast("double") / (n * 10**places))


def kpi_row(orders: DataFrame, analytics: DataFrame, limit: tuple[int, int] | None = None) -> DataFrame:
    """Active orders, share of filled orders, mean slippage and mean fill rate.

    `limit` restricts the KPIs to the newest (orders, analytics) rows, which is what
    a screen that loads (100, 200) rows shows. Percentages have one decimal, ties up.
    """
    if limit:
        orders, analytics = newest(orders, limit[0]), newest(analytics, limit[1])
    rows = orders.select(F.lit(True).alias("is_order"), "status").unionByName(
        analytics.select(F.lit(False).alias("is_order"), "avg_slippage_bps", "fill_rate"),
        allowMissingColumns=True,
    )
    status = F.col("status")
    n_orders, n_analytics = F.count_if("is_order"), F.count_if(~F.col("is_order"))
    zero = F.lit(0.0)
    return rows.agg(
        F.count_if(status.isin(*OPEN_STATUSES)).alias("active_count"),
        F.coalesce(half_up(F.count_if(status == "FILLED") * 100, n_orders, 1), zero).alias("fill_rate"),
        F.coalesce(half_up(_total("avg_slippage_bps", 2), n_analytics * 100, 1), zero)
        .alias("avg_slippage"),
        F.coalesce(half_up(_total("fill_rate", 4), n_analytics * 100, 1), zero)
        .alias("participation_rate"),
    ).withColumns({
        "slippage_grade": slippage_grade("avg_slippage"),
        "slippage_side": slippage_side("avg_slippage"),
    })


def dashboard_counters(active: DataFrame, listing: DataFrame) -> DataFrame:
    """The dashboard's counters: counts, means and totals over all rows."""
    rows = active.select("status", F.col("notional_value").alias("active_notional")).unionByName(
        listing.select("order_id", "fill_rate_pct", "avg_slippage_bps", "notional_value"),
        allowMissingColumns=True,
    )
    return rows.agg(
        F.count_if(F.col("status").isin(*OPEN_STATUSES)).alias("active_orders"),
        (sum_of_rounded("active_notional") / 1_000_000).alias("total_notional_musd"),
        _mean("fill_rate_pct").alias("avg_fill_rate_pct"),
        _mean("avg_slippage_bps").alias("avg_slippage_bps"),
        sum_of_rounded("notional_value").alias("filled_notional_usd"),
        F.count("order_id").alias("total_orders"),
    )


def status_counts(orders: DataFrame) -> DataFrame:
    """Orders per tab, in one pass: ALL and every status, including empty ones."""
    status = F.col("status")
    counts = orders.agg(
        F.count(F.lit(1)).alias("ALL"),
        *[F.count_if(status == s).alias(s) for s in STATUSES],
    )
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("status"), F.col(name).alias("orders"))
        for name in ("ALL", *STATUSES)
    ])))


def orders_by_status(orders: DataFrame) -> DataFrame:
    """Statuses that occur, most frequent first."""
    return (
        orders.groupBy("status")
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy(F.desc("orders"), "status")
    )


def by_strategy(analytics: DataFrame) -> DataFrame:
    """Mean fill rate and slippage per strategy, best fill rate first; ties in rounding go up."""
    n = F.count(F.lit(1))
    return (
        analytics.groupBy(category("strategy").alias("strategy"))
        .agg(
            n.alias("total"),
            half_up(_total("fill_rate", 4), n * 100, 1).alias("fill_rate"),
            half_up(_total("avg_slippage_bps", 2), n * 100, 1).alias("avg_slippage"),
        )
        .orderBy(F.desc("fill_rate"), "strategy")
    )


def average_by(df: DataFrame, key: str, value: str, places: int = 2) -> DataFrame:
    """Mean per key of a value that is rounded to `places` decimals."""
    return df.groupBy(key).agg(_mean(value, places).alias(f"avg_{value.removeprefix('avg_')}"))


def slippage_by_etf(listing: DataFrame) -> DataFrame:
    return average_by(listing, "etf_ticker", "avg_slippage_bps")


def fill_by_type(listing: DataFrame) -> DataFrame:
    return average_by(listing, "order_type", "fill_rate_pct")


def orders_over_time(active: DataFrame, bucket: str | None = None) -> DataFrame:
    """Orders per creation time and strategy; `bucket` truncates the time (hour, day, ...)."""
    at = F.date_trunc(bucket, "created_at") if bucket else F.col("created_at")
    return active.groupBy(at.alias("created_at"), "strategy").agg(F.count(F.lit(1)).alias("orders"))


def slippage_by_trader(traders: DataFrame) -> DataFrame:
    """Mean of the daily slippage per trader and desk."""
    return traders.groupBy("trader_name", "desk").agg(
        _mean("avg_slippage_bps").alias("avg_slippage_bps")
    )


def notional_by_trader(traders: DataFrame) -> DataFrame:
    return traders.groupBy("trader_name", "desk").agg(
        sum_of_rounded("total_notional_usd").alias("total_notional_usd")
    )


def volume_by_etf(listing: DataFrame) -> DataFrame:
    return listing.select("ticker", "total_volume")


def price_bounds(history: DataFrame) -> DataFrame:
    """Axis of the price chart: just below the lowest and above the highest non-zero price."""
    price = F.when(F.col("last_price") != 0, F.col("last_price"))
    return history.agg(
        (F.min(price) * 0.9995).alias("min_price"),
        (F.max(price) * 1.0005).alias("max_price"),
    )
