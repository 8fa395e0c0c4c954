"""Declared tables: columns, keys, constraints, defaults and storage layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

# The domains of the categorical columns.
STATUSES = ("PENDING", "PARTIAL", "FILLED", "CANCELLED")
OPEN_STATUSES = ("PENDING", "PARTIAL")
CLOSED_STATUSES = ("FILLED", "CANCELLED")
DIRECTIONS = ("BUY", "SELL")
ORDER_TYPES = ("LIMIT", "VWAP", "TWAP", "MKT")
STRATEGIES = ("TWAP", "VWAP", "IS", "POV", "MKT_ON_CLOSE")
INSTRUMENT_TYPES = ("FUTURES", "OPTIONS")
ACTION_TYPES = ("CANCEL", "EXECUTE", "ADJUST_SIZE", "ADJUST_PRICE", "HEDGE")
DEFAULT_TRADER = "T001"


@dataclass(frozen=True)
class Table:
    """`day_of` names the timestamp whose date partitions the files, for the tables that
    are read by time.

    `storage` is `append` (files only ever added), `batches` (one folder per
    micro-batch, replaced as a whole when the batch is retried) or `snapshots`
    (one folder per full version, the newest complete one is current).
    """

    ddl: str
    keys: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    day_of: str | None = None
    storage: str = "append"

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def required(self) -> list[str]:
        """Columns that may not be missing."""
        declared = [c.split() for c in self.ddl.split(", ")]
        return [c[0] for c in declared if c[2:] == ["not", "null"] or c[0] in self.not_null]

    @property
    def columns(self) -> list[str]:
        return self.schema.names


TABLES: dict[str, Table] = {
    # dimensions
    "etf_reference": Table(
        "ticker string, name string, aum_bn double, benchmark string, sector string, "
        "expense_ratio double, intraday_iv double, base_price double",
        keys=("ticker",),
    ),
    "etf_constituents": Table(
        "etf_ticker string not null, constituent string not null, weight_pct double, sector string",
        keys=("etf_ticker", "constituent"),
        not_null=("etf_ticker", "constituent"),
    ),
    "hedge_instruments": Table(
        "instrument_id string, type string, underlying string, expiry string, strike double, "
        "contract_size int, delta double",
        keys=("instrument_id",),
        domains={"type": INSTRUMENT_TYPES},
    ),
    "traders": Table(
        "trader_id string, name string, desk string, risk_limit_usd bigint",
        keys=("trader_id",),
    ),
    # bronze: every column is required of the producer
    "raw_market_data": Table(
        "event_id string not null, event_time timestamp not null, ticker string not null, "
        "bid double not null, ask double not null, last_price double not null, "
        "volume bigint not null, cum_volume bigint not null, vwap double not null, "
        "source string not null",
        keys=("ticker", "event_time"),
        not_null=("event_id", "event_time", "ticker"),
        day_of="event_time",
    ),
    "raw_orders": Table(
        "order_id string not null, trader_id string not null, etf_ticker string not null, "
        "direction string not null, qty int not null, order_type string not null, "
        "price_limit double not null, status string not null, created_at timestamp not null, "
        "strategy string not null, arrival_price double not null",
        keys=("order_id",),
        not_null=("order_id",),
        domains={"direction": DIRECTIONS, "status": STATUSES, "order_type": ORDER_TYPES,
                 "strategy": STRATEGIES},
    ),
    "raw_executions": Table(
        "exec_id string not null, order_id string not null, fill_qty int not null, "
        "fill_price double not null, venue string not null, exec_time timestamp not null",
        keys=("exec_id",),
        not_null=("exec_id", "order_id"),
    ),
    # silver
    "market_data_silver": Table(
        "event_id string, event_time timestamp, ticker string, bid double, ask double, "
        "last_price double, mid_price double, spread_bps double, volume bigint, "
        "cum_volume bigint, vwap double, relative_volume double, price_move_pct double, "
        "source string",
        keys=("ticker", "event_time"),
        day_of="event_time",
        storage="batches",
    ),
    "orders_silver": Table(
        "order_id string, trader_id string, etf_ticker string, etf_name string, sector string, "
        "direction string, qty int, order_type string, price_limit double, arrival_price double, "
        "status string, created_at timestamp, strategy string, notional_value double, "
        "time_in_market_sec bigint, expense_ratio double, aum_bn double",
        keys=("order_id",),
        storage="batches",
    ),
    "executions_silver": Table(
        "exec_id string, order_id string, etf_ticker string, trader_id string, direction string, "
        "fill_qty int, fill_price double, fill_notional double, venue string, "
        "exec_time timestamp, arrival_price double, slippage_bps double, qty int",
        keys=("exec_id",),
        storage="batches",
    ),
    # gold
    "order_analytics_gold": Table(
        "order_id string, trader_id string, etf_ticker string, etf_name string, direction string, "
        "qty int, filled_qty bigint, remaining_qty bigint, fill_rate double, fill_count bigint, "
        "avg_slippage_bps double, avg_fill_price double, total_fill_notional double, "
        "notional_value double, estimated_completion_pct double, vwap_vs_limit double, "
        "order_type string, strategy string, status string, created_at timestamp, "
        "first_fill_time timestamp, last_fill_time timestamp",
        keys=("order_id",),
        storage="snapshots",
    ),
    "market_snapshot_gold": Table(
        "ticker string, event_time timestamp, last_price double, bid double, ask double, "
        "mid_price double, spread_bps double, volume bigint, total_volume bigint, "
        "cum_volume bigint, vwap double, intraday_high double, intraday_low double, "
        "open_price double, price_change_pct double, relative_volume double, source string",
        keys=("ticker",),
        storage="snapshots",
    ),
    "trading_performance_gold": Table(
        "trader_id string, trade_date date, total_orders bigint, filled_orders bigint, "
        "active_orders bigint, fill_rate_pct double, participation_rate double, "
        "avg_slippage_bps double, total_notional_usd double, total_filled_notional_usd double, "
        "unique_etfs_traded bigint",
        keys=("trader_id", "trade_date"),
        storage="snapshots",
    ),
    # order state
    "live_orders": Table(
        "order_id string, etf_ticker string, etf_name string, trader_id string, direction string, "
        "qty int, filled_qty bigint, price_limit double, order_type string, status string, "
        "strategy string, created_at timestamp, last_updated timestamp, arrival_price double, "
        "notional_value double, avg_fill_price double, avg_slippage_bps double, "
        "fill_rate double, assigned_hedge_id string",
        keys=("order_id",),
        not_null=("order_id", "etf_ticker", "trader_id", "direction", "qty", "filled_qty", "status"),
        domains={"direction": DIRECTIONS},
        defaults={"filled_qty": 0, "status": "PENDING", "fill_rate": 0.0},
        storage="snapshots",
    ),
    # syncs from upstream on their way to the live orders, in the same shape
    "live_order_updates": Table(
        "order_id string, etf_ticker string, etf_name string, trader_id string, direction string, "
        "qty int, filled_qty bigint, price_limit double, order_type string, status string, "
        "strategy string, created_at timestamp, last_updated timestamp, arrival_price double, "
        "notional_value double, avg_fill_price double, avg_slippage_bps double, "
        "fill_rate double, assigned_hedge_id string",
        not_null=("order_id", "etf_ticker", "trader_id", "direction", "qty", "filled_qty", "status"),
        domains={"direction": DIRECTIONS},
        defaults={"filled_qty": 0, "status": "PENDING", "fill_rate": 0.0},
    ),
    "rejected_live_orders": Table(
        "order_id string, reason string, row string",
        storage="snapshots",
    ),
    "order_actions": Table(
        "action_id bigint, order_id string, action_type string, old_value string, "
        "new_value string, trader_id string, ts timestamp",
        keys=("action_id",),
        not_null=("order_id", "action_type"),
        domains={"action_type": ACTION_TYPES},
        storage="batches",
    ),
    "rejected_actions": Table(
        "action_id bigint, order_id string, action_type string, reason string, code int, "
        "trader_id string, ts timestamp",
        keys=("action_id",),
        storage="batches",
    ),
    "hedge_requests": Table(
        "hedge_id bigint, parent_order_id string, instrument_id string, direction string, "
        "qty int, hedge_type string, status string, created_at timestamp",
        keys=("hedge_id",),
        not_null=("parent_order_id", "instrument_id", "direction", "qty", "hedge_type"),
        defaults={"status": "PENDING"},
        storage="batches",
    ),
    # input of the order-state operators
    "actions": Table(
        "action_id bigint, order_id string, action_type string, qty int, price_limit double, "
        "instrument_id string, direction string, hedge_type string, trader_id string, "
        "ts timestamp",
        keys=("action_id",),
        defaults={"trader_id": DEFAULT_TRADER},
    ),
}
