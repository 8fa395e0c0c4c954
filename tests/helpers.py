"""Hand-written tables for tests."""

from datetime import datetime

from pyspark.sql.types import StructField, StructType

from tapeloom.schemas import TABLES


def ts(text):
    return datetime.fromisoformat(text)


def table(spark, name, rows, **common):
    """A declared table from partial rows; constraints are not enforced, missing fields are NULL."""
    schema = StructType([StructField(f.name, f.dataType, True) for f in TABLES[name].schema])
    values = [tuple({**common, **r}.get(c) for c in schema.names) for r in rows]
    return spark.createDataFrame(values, schema)


def by(df, key):
    return {row[key]: row for row in df.collect()}


TICK = dict(
    event_time=ts("2024-01-02 10:00:00"), ticker="SPY", bid=99.0, ask=101.0, last_price=100.0,
    volume=60_000, cum_volume=1_000, vwap=100.0, source="sim",
)
ORDER = dict(
    trader_id="T001", etf_ticker="SPY", direction="BUY", qty=100, order_type="LIMIT",
    price_limit=10.0, status="PENDING", created_at=ts("2024-01-02 09:00:00"), strategy="VWAP",
    arrival_price=10.0,
)
FILL = dict(
    order_id="O1", fill_qty=10, fill_price=10.0, venue="IEX", exec_time=ts("2024-01-02 09:30:00")
)
LIVE = dict(
    etf_ticker="SPY", trader_id="T001", direction="BUY", qty=100, filled_qty=0, price_limit=10.0,
    status="PENDING", arrival_price=10.0, notional_value=1000.0, avg_slippage_bps=0.0, fill_rate=0.0,
    created_at=ts("2024-01-02 09:00:00"), last_updated=ts("2024-01-02 09:00:00"),
)
