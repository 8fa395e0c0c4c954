"""DuckDB twins of the registered queries.

Each text stands on the generic test tables alone: the desk's tables and the
intermediate results it uses are prepended as common table expressions. The twins
are written with rankings, joins and row-level windows where the Spark plans use
aggregates and slices, so agreement is not by construction.

Spark rounds the decimal expansion of a double, half away from zero, and has no
negative zero there. Rounded values that may be negative get `+ 0.0` here, and ties
of an inexact product are rounded as decimals.
"""

from __future__ import annotations

import re

from tapeloom.schemas import TABLES
from tapeloom.sources.desk_views import MARKET_AS_OF, ORDERS_AS_OF, VIEWS, duckdb_view
from tapeloom.workload.queries import LAST_SYNC, LATE

_MARKET_NOW = f"TIMESTAMP '{MARKET_AS_OF}'"
_ORDERS_NOW = f"TIMESTAMP '{ORDERS_AS_OF}'"


def _units(value: str, places: int) -> str:
    return f"CAST(round({value} * {10**places}) AS BIGINT)"


def _rounded_mean(value: str, places: int) -> str:
    """Exact mean, rounded half away from zero."""
    s, n = f"sum({_units(value, places)})", f"count({value})"
    return f"CAST(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) AS DOUBLE) / {10**places}"


def _mean(value: str, places: int = 2) -> str:
    s, n = f"sum({_units(value, places)})", f"count({value})"
    return f"CAST({s} AS DOUBLE) / ({n} * {10**places})"


def _half_up(numerator: str, denominator: str) -> str:
    """Ratio to one decimal, ties towards plus infinity."""
    return f"floor(CAST(20 * ({numerator}) + ({denominator}) AS DOUBLE) / (2 * ({denominator}))) / 10"


_STEPS: dict[str, str] = {
    "tick_dedup": """
        SELECT * FROM raw_market_data
        QUALIFY row_number() OVER (PARTITION BY ticker, event_time ORDER BY event_id) = 1""",
    "tick_enriched": """
        SELECT event_id, event_time, ticker, bid, ask, last_price,
          round((bid + ask) / 2, 4) AS mid_price,
          round((ask - bid) / nullif(last_price, 0) * 10000, 2) AS spread_bps,
          volume, cum_volume, vwap,
          round(CAST(volume AS DOUBLE) / CAST(CASE ticker WHEN 'SPY' THEN 120000
            WHEN 'QQQ' THEN 85000 WHEN 'IVV' THEN 95000 WHEN 'VTI' THEN 40000
            WHEN 'XLK' THEN 25000 WHEN 'XLF' THEN 30000 END AS DOUBLE), 3) AS relative_volume,
          round((last_price - vwap) / nullif(vwap, 0) * 100, 4) + 0.0 AS price_move_pct, source
        FROM tick_dedup""",
    "market": """
        SELECT * FROM tick_enriched WHERE ticker IS NOT NULL AND last_price > 0 AND ask >= bid""",
    "order_enriched": f"""
        SELECT o.order_id, o.trader_id, o.etf_ticker, e.name AS etf_name, e.sector, o.direction,
          o.qty, o.order_type, o.price_limit, o.arrival_price, o.status, o.created_at, o.strategy,
          round(o.qty * o.price_limit, 2) AS notional_value,
          CAST(epoch({_ORDERS_NOW}) - epoch(o.created_at) AS BIGINT) AS time_in_market_sec,
          e.expense_ratio, e.aum_bn
        FROM raw_orders o LEFT JOIN etf_reference e ON o.etf_ticker = e.ticker""",
    "orders_s": "SELECT * FROM order_enriched WHERE order_id IS NOT NULL AND qty > 0",
    "exec_enriched": """
        SELECT x.exec_id, x.order_id, o.etf_ticker, o.trader_id, o.direction, x.fill_qty,
          x.fill_price, round(x.fill_qty * x.fill_price, 2) AS fill_notional, x.venue, x.exec_time,
          o.arrival_price,
          round(CASE WHEN o.arrival_price > 0
            THEN (x.fill_price - o.arrival_price) / o.arrival_price * 10000 ELSE 0.0 END, 2) + 0.0
            AS slippage_bps, o.qty
        FROM raw_executions x LEFT JOIN raw_orders o ON x.order_id = o.order_id""",
    "executions_s": "SELECT * FROM exec_enriched WHERE exec_id IS NOT NULL AND fill_qty > 0",
    "fills": f"""
        SELECT order_id, CAST(sum(fill_qty) AS BIGINT) AS filled_qty, count(exec_id) AS fill_count,
          {_rounded_mean('slippage_bps', 2)} AS avg_slippage_bps,
          sum(fill_notional) AS total_fill_notional, avg(fill_price) AS avg_fill_price,
          min(exec_time) AS first_fill_time, max(exec_time) AS last_fill_time
        FROM executions_s GROUP BY order_id""",
    "analytics": """
        SELECT o.order_id, o.trader_id, o.etf_ticker, o.etf_name, o.direction, o.qty,
          coalesce(f.filled_qty, 0) AS filled_qty, o.qty - coalesce(f.filled_qty, 0) AS remaining_qty,
          round(coalesce(f.filled_qty, 0) / CAST(o.qty AS DOUBLE), 4) AS fill_rate, f.fill_count,
          coalesce(f.avg_slippage_bps, 0.0) AS avg_slippage_bps, f.avg_fill_price,
          f.total_fill_notional, o.notional_value,
          round(round(coalesce(f.filled_qty, 0) / CAST(o.qty AS DOUBLE), 4) * 100, 2)
            AS estimated_completion_pct,
          round(CASE WHEN o.price_limit > 0
            THEN (f.avg_fill_price - o.price_limit) / o.price_limit * 10000 END, 2) + 0.0
            AS vwap_vs_limit,
          o.order_type, o.strategy, o.status, o.created_at, f.first_fill_time, f.last_fill_time
        FROM orders_s o LEFT JOIN fills f ON o.order_id = f.order_id""",
    "latest_tick": """
        SELECT * FROM market
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY event_time DESC, event_id) = 1""",
    "intraday": f"""
        SELECT ticker, min(last_price) AS intraday_low, max(last_price) AS intraday_high,
          arg_min(last_price, event_time) AS open_price, max(cum_volume) AS total_volume
        FROM market WHERE event_time >= date_trunc('day', {_MARKET_NOW}) GROUP BY ticker""",
    "snapshot": """
        SELECT l.ticker, l.event_time, l.last_price, l.bid, l.ask, l.mid_price, l.spread_bps,
          l.volume, i.total_volume, l.cum_volume, l.vwap, i.intraday_high, i.intraday_low,
          i.open_price,
          round(CASE WHEN i.open_price > 0
            THEN (l.last_price - i.open_price) / i.open_price * 100 ELSE 0.0 END, 4) + 0.0
            AS price_change_pct, l.relative_volume, l.source
        FROM latest_tick l LEFT JOIN intraday i ON l.ticker = i.ticker""",
    "performance": f"""
        SELECT trader_id, CAST(created_at AS DATE) AS trade_date, count(order_id) AS total_orders,
          count(*) FILTER (status = 'FILLED') AS filled_orders,
          count(*) FILTER (status IN ('PENDING', 'PARTIAL')) AS active_orders,
          round(count(*) FILTER (status = 'FILLED') / CAST(count(order_id) AS DOUBLE) * 100, 2)
            AS fill_rate_pct,
          round({_rounded_mean('fill_rate', 4)} * 100, 2) AS participation_rate,
          {_rounded_mean('avg_slippage_bps', 2)} AS avg_slippage_bps,
          sum(notional_value) AS total_notional_usd,
          sum(total_fill_notional) AS total_filled_notional_usd,
          count(DISTINCT etf_ticker) AS unique_etfs_traded
        FROM analytics GROUP BY trader_id, trade_date""",
    "active": """
        SELECT o.order_id, o.etf_ticker, o.trader_id, o.direction, o.qty,
          coalesce(a.filled_qty, 0) AS filled_qty, o.price_limit, o.order_type, o.status,
          o.strategy, o.created_at, o.notional_value,
          coalesce(a.fill_rate * 100, 0) AS fill_rate_pct,
          coalesce(a.avg_slippage_bps, 0) AS avg_slippage_bps,
          coalesce(a.estimated_completion_pct, 0) AS estimated_completion_pct
        FROM orders_s o LEFT JOIN analytics a ON o.order_id = a.order_id""",
    "listing": """
        SELECT order_id, trader_id, etf_ticker, direction, qty, filled_qty,
          fill_rate * 100 AS fill_rate_pct, avg_slippage_bps, avg_fill_price, notional_value,
          order_type, strategy, status, created_at, vwap_vs_limit
        FROM analytics""",
    "trader_days": """
        SELECT p.trader_id, t.name AS trader_name, t.desk, p.trade_date, p.total_orders,
          p.filled_orders, p.active_orders, p.fill_rate_pct, p.avg_slippage_bps,
          p.total_notional_usd, p.total_filled_notional_usd, p.unique_etfs_traded
        FROM performance p LEFT JOIN traders t ON p.trader_id = t.trader_id""",
    "sync_source": """
        SELECT o.order_id, o.etf_ticker, o.etf_name, o.trader_id, o.direction, o.qty,
          coalesce(a.filled_qty, 0) AS filled_qty, o.price_limit, o.order_type, o.status, o.strategy,
          o.created_at, o.arrival_price, o.notional_value, a.avg_fill_price,
          coalesce(a.avg_slippage_bps, 0.0) AS avg_slippage_bps, coalesce(a.fill_rate, 0.0) AS fill_rate
        FROM orders_s o LEFT JOIN analytics a ON o.order_id = a.order_id""",
    "live": f"""
        SELECT order_id, etf_ticker, etf_name, trader_id, direction, qty, filled_qty, price_limit,
          order_type, status, strategy, created_at, {_ORDERS_NOW} AS last_updated, arrival_price,
          notional_value, avg_fill_price, avg_slippage_bps, fill_rate,
          CAST(NULL AS VARCHAR) AS assigned_hedge_id
        FROM sync_source""",
    "fallback": """
        SELECT order_id, etf_ticker, CAST(NULL AS VARCHAR) AS etf_name, trader_id, direction,
          coalesce(qty, 0) AS qty, CAST(0 AS BIGINT) AS filled_qty, price_limit, order_type, status,
          strategy, created_at, arrival_price, CAST(qty AS DOUBLE) * price_limit AS notional_value,
          CAST(NULL AS DOUBLE) AS avg_fill_price, CAST(0 AS DOUBLE) AS avg_slippage_bps,
          CAST(0 AS DOUBLE) AS fill_rate
        FROM raw_orders""",
    "acts1": """
        SELECT a.*, l.order_id IS NOT NULL AS known, l.status AS status0, l.qty AS qty0,
          l.price_limit AS price0, l.filled_qty AS filled0, l.assigned_hedge_id AS hedge0,
          l.arrival_price, s.last_price AS market_price,
          row_number() OVER (PARTITION BY a.order_id ORDER BY a.ts, a.action_id) AS rn,
          coalesce(max(CAST(a.action_type = 'CANCEL' AS INT)) OVER w, 0) AS cancelled,
          last_value(CASE WHEN a.action_type = 'HEDGE' THEN a.action_id END IGNORE NULLS) OVER w
            AS hedge_before
        FROM actions a LEFT JOIN live l ON a.order_id = l.order_id
          LEFT JOIN snapshot s ON l.etf_ticker = s.ticker
        WINDOW w AS (PARTITION BY a.order_id ORDER BY a.ts, a.action_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "acts2": """
        SELECT *,
          coalesce(last_value(CASE WHEN action_type = 'ADJUST_SIZE' AND qty > 0 AND cancelled = 0
            AND status0 NOT IN ('FILLED', 'CANCELLED') THEN qty END IGNORE NULLS) OVER w, qty0)
            AS qty_before,
          coalesce(last_value(CASE WHEN action_type = 'ADJUST_PRICE' AND price_limit > 0
            AND cancelled = 0 AND status0 NOT IN ('FILLED', 'CANCELLED') THEN price_limit END
            IGNORE NULLS) OVER w, price0) AS price_before
        FROM acts1
        WINDOW w AS (PARTITION BY order_id ORDER BY rn
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "acts3": """
        SELECT *, action_type = 'EXECUTE' AND (market_price IS NOT NULL
            OR coalesce(arrival_price, 0) <= 0 OR price_before IS NOT NULL) AS executable
        FROM acts2""",
    "acts4": """
        SELECT *, CASE WHEN status0 = 'FILLED'
            OR coalesce(max(CAST(executable AS INT)) OVER w, 0) = 1 THEN 'FILLED'
            WHEN status0 = 'CANCELLED' OR cancelled = 1 THEN 'CANCELLED'
            ELSE status0 END AS status_before
        FROM acts3
        WINDOW w AS (PARTITION BY order_id ORDER BY rn
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "judged": """
        SELECT *, CASE
            WHEN action_type = 'ADJUST_SIZE' AND coalesce(qty, 0) <= 0 THEN 'BAD_VALUE'
            WHEN action_type = 'ADJUST_PRICE' AND coalesce(price_limit, 0) <= 0 THEN 'BAD_VALUE'
            WHEN NOT known THEN 'UNKNOWN_ORDER'
            WHEN action_type IN ('CANCEL', 'ADJUST_SIZE', 'ADJUST_PRICE')
              AND status_before IN ('FILLED', 'CANCELLED') THEN 'CLOSED'
            WHEN action_type = 'EXECUTE' AND status_before = 'FILLED' THEN 'CLOSED'
            WHEN action_type = 'EXECUTE' AND NOT executable THEN 'NO_PRICE'
            ELSE 'OK' END AS verdict,
          coalesce(market_price, price_before) AS exec_price,
          CASE WHEN arrival_price > 0 THEN round((coalesce(market_price, price_before) - arrival_price)
            / arrival_price * 10000, 2) + 0.0 ELSE 0.0 END AS exec_slippage
        FROM acts4""",
    "accepted": "SELECT * FROM judged WHERE verdict = 'OK'",
    "changes": """
        SELECT order_id, arg_max(qty, rn) FILTER (action_type = 'ADJUST_SIZE') AS new_qty,
          arg_max(price_limit, rn) FILTER (action_type = 'ADJUST_PRICE') AS new_price,
          CAST(arg_max(action_id, rn) FILTER (action_type = 'HEDGE') AS VARCHAR) AS new_hedge,
          bool_or(action_type = 'CANCEL') AS cancelled, bool_or(action_type = 'EXECUTE') AS executed,
          max(exec_price) FILTER (action_type = 'EXECUTE') AS exec_price,
          max(exec_slippage) FILTER (action_type = 'EXECUTE') AS exec_slippage, max(ts) AS touched
        FROM accepted GROUP BY order_id""",
    "state": """
        SELECT l.order_id, l.etf_ticker, l.etf_name, l.trader_id, l.direction,
          coalesce(c.new_qty, l.qty) AS qty,
          CASE WHEN c.executed THEN coalesce(c.new_qty, l.qty) ELSE l.filled_qty END AS filled_qty,
          coalesce(c.new_price, l.price_limit) AS price_limit, l.order_type,
          CASE WHEN c.executed THEN 'FILLED' WHEN c.cancelled THEN 'CANCELLED' ELSE l.status END
            AS status,
          l.strategy, l.created_at, coalesce(c.touched, l.last_updated) AS last_updated,
          l.arrival_price,
          CASE WHEN c.new_qty IS NOT NULL OR c.new_price IS NOT NULL
            THEN coalesce(c.new_qty, l.qty) * coalesce(c.new_price, l.price_limit, 0)
            ELSE l.notional_value END AS notional_value,
          CASE WHEN c.executed THEN c.exec_price ELSE l.avg_fill_price END AS avg_fill_price,
          CASE WHEN c.executed THEN c.exec_slippage ELSE l.avg_slippage_bps END AS avg_slippage_bps,
          CASE WHEN c.executed THEN 1.0 ELSE l.fill_rate END AS fill_rate,
          coalesce(c.new_hedge, l.assigned_hedge_id) AS assigned_hedge_id
        FROM live l LEFT JOIN changes c ON l.order_id = c.order_id""",
    "history": f"""
        SELECT event_time, last_price, bid, ask, volume, vwap FROM raw_market_data
        WHERE ticker = 'SPY' AND event_time >= {_MARKET_NOW} - INTERVAL 8 HOUR
        ORDER BY event_time, event_id""",
}


_ORDER_SUMMARY = f"""
        SELECT {_ORDERS_NOW} AS generated_at, count(*) AS total_orders,
          (SELECT count(*) FROM raw_executions) AS total_executions,
          count(*) FILTER (status = 'PENDING') AS "PENDING",
          count(*) FILTER (status = 'PARTIAL') AS "PARTIAL",
          count(*) FILTER (status = 'FILLED') AS "FILLED",
          count(*) FILTER (status = 'CANCELLED') AS "CANCELLED"
        FROM raw_orders"""

_OPENED_AUDIT = """
        SELECT action_id, order_id, action_type, trader_id, ts,
          CASE WHEN action_type IN ('CANCEL', 'EXECUTE') THEN status_before END AS old_status,
          CASE WHEN action_type = 'EXECUTE' THEN filled0 END AS old_filled_qty,
          CASE WHEN action_type = 'ADJUST_SIZE' THEN qty_before END AS old_qty,
          CASE WHEN action_type = 'ADJUST_PRICE' AND price_before <> 0 THEN price_before END
            AS old_price_limit,
          CASE WHEN action_type = 'HEDGE' THEN coalesce(CAST(hedge_before AS VARCHAR), hedge0) END
            AS old_assigned_hedge_id,
          CASE action_type WHEN 'CANCEL' THEN 'CANCELLED' WHEN 'EXECUTE' THEN 'FILLED' END AS new_status,
          CASE WHEN action_type = 'EXECUTE' THEN exec_price END AS new_fill_price,
          CASE WHEN action_type = 'EXECUTE' THEN exec_slippage END AS new_slippage_bps,
          CASE WHEN action_type IN ('ADJUST_SIZE', 'HEDGE') THEN qty END AS new_qty,
          CASE WHEN action_type = 'ADJUST_PRICE' THEN price_limit END AS new_price_limit,
          CASE WHEN action_type = 'HEDGE' THEN action_id END AS new_hedge_id,
          CASE WHEN action_type = 'HEDGE' THEN instrument_id END AS new_instrument_id
        FROM accepted"""


def _metrics(table: str, rows: str, rules: dict[str, str]) -> list[str]:
    kept = " AND ".join(f"({p})" for p in rules.values())
    return [
        f"""SELECT '{table}' AS table_name, '{rule}' AS rule,
          count(*) FILTER ({predicate}) AS passed,
          count(*) - count(*) FILTER ({predicate}) AS failed, count(*) AS total,
          count(*) FILTER ({kept}) AS kept FROM {rows}"""
        for rule, predicate in rules.items()
    ]


def _violations(table: str, rows: str) -> list[str]:
    declared = TABLES[table]
    bad = {f"not_null({c})": f"{c} IS NULL" for c in declared.required}
    for column, allowed in declared.domains.items():
        bad[f"check({column})"] = f"{column} NOT IN ({', '.join(repr(v) for v in allowed)})"
    keys = ", ".join(declared.keys)
    return [
        f"""SELECT '{table}' AS table_name, '{name}' AS "constraint",
          count(*) FILTER ({predicate}) AS violations FROM {rows}"""
        for name, predicate in bad.items()
    ] + [
        f"""SELECT '{table}' AS table_name, 'unique({keys})' AS "constraint",
          count(*) AS violations
          FROM (SELECT {keys} FROM {rows} GROUP BY {keys} HAVING count(*) > 1)"""
    ]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_FINAL: dict[str, str] = {
    "market_silver": "SELECT * FROM market",
    "orders_silver": "SELECT * FROM orders_s",
    "executions_silver": "SELECT * FROM executions_s",
    "order_analytics": "SELECT * FROM analytics",
    "market_snapshot": "SELECT * FROM snapshot",
    "trading_performance": "SELECT * FROM performance",
    "expectation_metrics": _union([
        *_metrics("market_data_silver", "tick_enriched", {
            "valid_ticker": "ticker IS NOT NULL", "valid_price": "last_price > 0",
            "valid_spread": "ask >= bid"}),
        *_metrics("orders_silver", "order_enriched", {
            "valid_order_id": "order_id IS NOT NULL", "valid_qty": "qty > 0"}),
        *_metrics("executions_silver", "exec_enriched", {
            "valid_exec_id": "exec_id IS NOT NULL", "positive_fill": "fill_qty > 0"}),
    ]),
    "constraint_violations": _union([
        *_violations("live_orders", "fallback"),
        *_violations("raw_market_data", "raw_market_data"),
        *_violations("raw_orders", "raw_orders"),
    ]),
    "active_orders": "SELECT * FROM active",
    "market_listing": """
        SELECT ticker, last_price, bid, ask, spread_bps, total_volume, vwap, intraday_high,
          intraday_low, price_change_pct, relative_volume, event_time FROM snapshot""",
    "market_feed": """
        SELECT ticker, last_price, bid, ask, mid_price, spread_bps, volume, total_volume, vwap,
          intraday_high, intraday_low, open_price, price_change_pct, relative_volume, event_time
        FROM snapshot""",
    "market_ticker": """
        SELECT ticker, last_price, bid, ask, coalesce(price_change_pct, 0) AS change_pct,
          coalesce(price_change_pct, 0) >= 0 AS is_up FROM snapshot""",
    "execution_listing": "SELECT * FROM listing",
    "analytics_feed": """
        SELECT order_id, trader_id, etf_ticker, direction, qty, filled_qty, remaining_qty, fill_rate,
          avg_slippage_bps, avg_fill_price, notional_value, estimated_completion_pct, vwap_vs_limit,
          order_type, strategy, status, created_at, first_fill_time, last_fill_time
        FROM analytics ORDER BY created_at DESC, order_id LIMIT 200""",
    "trader_listing": "SELECT * FROM trader_days",
    "performance_feed": "SELECT * FROM performance",
    "price_history_day": f"""
        SELECT ticker, event_time, last_price, vwap, bid, ask, volume FROM market
        WHERE event_time >= {_MARKET_NOW} - INTERVAL 1 DAY""",
    "price_history_day_stored": f"""
        SELECT ticker, event_time, last_price, vwap, bid, ask, volume FROM market
        WHERE event_time >= {_MARKET_NOW} - INTERVAL 1 DAY""",
    "price_history_ticker": "SELECT * FROM history",
    "price_history_stored": "SELECT * FROM history",
    "prices_from_bronze": """
        SELECT ticker, last_price FROM raw_market_data
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY event_time DESC, event_id DESC) = 1""",
    "order_summary_file": _ORDER_SUMMARY,
    "live_orders_parsed": """
        SELECT * REPLACE (CASE WHEN qty % 700 = 0 THEN 0 ELSE qty END AS qty,
          CASE WHEN qty % 700 = 0 THEN 'PENDING' ELSE status END AS status) FROM live""",
    "orders_by_statement": """
        SELECT order_id, trader_id, qty FROM raw_orders WHERE status = 'PENDING' AND qty > 5000""",
    "hedge_instruments": "SELECT * FROM instrument_catalog",
    "order_blotter": """
        SELECT * FROM live WHERE status IN ('PENDING', 'PARTIAL') AND etf_ticker = 'SPY'
        ORDER BY created_at DESC, order_id LIMIT 100""",
    "blotter_fallback": """
        SELECT order_id, etf_ticker, trader_id, direction, qty, filled_qty, remaining_qty, order_type,
          status, strategy, created_at, notional_value,
          CAST(round(CAST(fill_rate * 100 AS DECIMAL(38, 14)), 1) AS DOUBLE) AS fill_pct,
          round(avg_slippage_bps, 2) AS avg_slippage_bps
        FROM analytics ORDER BY created_at DESC, order_id LIMIT 100""",
    "latest_raw_tick": """
        SELECT ticker, last_price, bid, ask, volume, cum_volume AS total_volume, vwap, event_time
        FROM raw_market_data
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY event_time DESC, event_id DESC) = 1""",
    "order_search": """
        SELECT * FROM orders_s WHERE coalesce(contains(lower(order_id), 'vwap'), false)
          OR coalesce(contains(lower(etf_ticker), 'vwap'), false)
          OR coalesce(contains(lower(trader_id), 'vwap'), false)
          OR coalesce(contains(lower(strategy), 'vwap'), false)""",
    "order_sort_nulls_last": """
        SELECT * FROM orders_s ORDER BY lower(strategy) DESC NULLS LAST, order_id""",
    "open_orders": """
        SELECT order_id, etf_ticker, direction, qty, arrival_price FROM raw_orders
        WHERE status IN ('PENDING', 'PARTIAL')""",
    "actionable_orders": "SELECT * FROM orders_s WHERE status NOT IN ('FILLED', 'CANCELLED')",
    "kpi_row": f"""
        SELECT o.*, a.*,
          CASE WHEN a.avg_slippage <= 2 THEN 'good' WHEN a.avg_slippage <= 5 THEN 'warn' ELSE 'bad'
            END AS slippage_grade,
          CASE WHEN a.avg_slippage >= 0 THEN 'vs arrival' ELSE 'saved vs arrival' END AS slippage_side
        FROM (SELECT count(*) FILTER (status IN ('PENDING', 'PARTIAL')) AS active_count,
                {_half_up("100 * count(*) FILTER (status = 'FILLED')", "count(*)")} AS fill_rate
              FROM live) o,
             (SELECT {_half_up(f"sum({_units('avg_slippage_bps', 2)})", "100 * count(*)")} AS avg_slippage,
                {_half_up(f"sum({_units('fill_rate', 4)})", "100 * count(*)")} AS participation_rate
              FROM analytics) a""",
    "dashboard_counters": f"""
        SELECT a.*, l.*
        FROM (SELECT count(*) FILTER (status IN ('PENDING', 'PARTIAL')) AS active_orders,
                sum(notional_value) / 1000000 AS total_notional_musd FROM active) a,
             (SELECT {_mean('fill_rate_pct')} AS avg_fill_rate_pct,
                {_mean('avg_slippage_bps')} AS avg_slippage_bps,
                sum(notional_value) AS filled_notional_usd, count(order_id) AS total_orders
              FROM listing) l""",
    "status_counts": """
        SELECT d.status, count(o.order_id) AS orders
        FROM (VALUES ('PENDING'), ('PARTIAL'), ('FILLED'), ('CANCELLED')) d(status)
          LEFT JOIN orders_s o ON o.status = d.status GROUP BY d.status
        UNION ALL SELECT 'ALL', count(*) FROM orders_s""",
    "orders_by_status": "SELECT status, count(order_id) AS orders FROM active GROUP BY status",
    "order_summary": _ORDER_SUMMARY,
    "by_strategy": f"""
        SELECT coalesce(nullif(strategy, ''), 'UNKNOWN') AS strategy, count(*) AS total,
          {_half_up(f"sum({_units('fill_rate', 4)})", "100 * count(*)")} AS fill_rate,
          {_half_up(f"sum({_units('avg_slippage_bps', 2)})", "100 * count(*)")} AS avg_slippage
        FROM analytics GROUP BY 1""",
    "slippage_by_etf": f"""
        SELECT etf_ticker, {_mean('avg_slippage_bps')} AS avg_slippage_bps
        FROM listing GROUP BY etf_ticker""",
    "fill_by_type": f"""
        SELECT order_type, {_mean('fill_rate_pct')} AS avg_fill_rate_pct
        FROM listing GROUP BY order_type""",
    "orders_over_time": """
        SELECT created_at, strategy, count(order_id) AS orders FROM active
        GROUP BY created_at, strategy""",
    "slippage_by_trader": f"""
        SELECT trader_name, desk, {_mean('avg_slippage_bps')} AS avg_slippage_bps
        FROM trader_days GROUP BY trader_name, desk""",
    "notional_by_trader": """
        SELECT trader_name, desk, sum(total_notional_usd) AS total_notional_usd
        FROM trader_days GROUP BY trader_name, desk""",
    "volume_by_etf": "SELECT ticker, total_volume FROM snapshot",
    "fill_vs_notional": """
        SELECT order_id, notional_value, fill_rate_pct, strategy, qty FROM listing""",
    "fill_vs_slippage": """
        SELECT order_id, floor(fill_rate * 100 * 10 + 0.5) / 10 AS x,
          floor(avg_slippage_bps * 10 + 0.5) / 10 AS y,
          coalesce(nullif(strategy, ''), 'UNKNOWN') AS strategy
        FROM analytics WHERE fill_rate IS NOT NULL""",
    "price_bounds": """
        SELECT min(last_price) FILTER (last_price <> 0) * 0.9995 AS min_price,
          max(last_price) FILTER (last_price <> 0) * 1.0005 AS max_price FROM history""",
    "blotter_enriched": """
        SELECT l.order_id, l.etf_ticker, l.direction, l.qty, l.filled_qty, l.price_limit, l.strategy,
          l.order_type, l.status, l.created_at, a.fill_rate * 100 AS fill_pct,
          least(100.0, a.fill_rate * 100) AS fill_bar_pct, a.avg_slippage_bps AS slippage_bps,
          CASE WHEN a.avg_slippage_bps IS NULL THEN 'none' WHEN a.avg_slippage_bps > 3 THEN 'bad'
            WHEN a.avg_slippage_bps < -1 THEN 'good' ELSE 'neutral' END AS slippage_band,
          l.status NOT IN ('FILLED', 'CANCELLED') AS actionable
        FROM live l LEFT JOIN analytics a ON l.order_id = a.order_id""",
    "live_orders_fallback": "SELECT * FROM fallback",
    "live_orders_merge": f"""
        SELECT coalesce(t.order_id, s.order_id) AS order_id,
          CASE WHEN t.order_id IS NULL THEN s.etf_ticker ELSE t.etf_ticker END AS etf_ticker,
          CASE WHEN t.order_id IS NULL THEN s.etf_name ELSE t.etf_name END AS etf_name,
          CASE WHEN t.order_id IS NULL THEN s.trader_id ELSE t.trader_id END AS trader_id,
          CASE WHEN t.order_id IS NULL THEN s.direction ELSE t.direction END AS direction,
          CASE WHEN t.order_id IS NULL THEN s.qty ELSE t.qty END AS qty,
          CASE WHEN s.order_id IS NULL THEN t.filled_qty ELSE s.filled_qty END AS filled_qty,
          CASE WHEN t.order_id IS NULL THEN s.price_limit ELSE t.price_limit END AS price_limit,
          CASE WHEN t.order_id IS NULL THEN s.order_type ELSE t.order_type END AS order_type,
          CASE WHEN s.order_id IS NULL THEN t.status ELSE s.status END AS status,
          CASE WHEN t.order_id IS NULL THEN s.strategy ELSE t.strategy END AS strategy,
          CASE WHEN t.order_id IS NULL THEN s.created_at ELSE t.created_at END AS created_at,
          CASE WHEN s.order_id IS NULL THEN TIMESTAMP '{LAST_SYNC}' ELSE {_ORDERS_NOW} END
            AS last_updated,
          CASE WHEN t.order_id IS NULL THEN s.arrival_price ELSE t.arrival_price END AS arrival_price,
          CASE WHEN t.order_id IS NULL THEN s.notional_value ELSE t.notional_value END
            AS notional_value,
          CASE WHEN s.order_id IS NULL THEN t.avg_fill_price ELSE s.avg_fill_price END
            AS avg_fill_price,
          CASE WHEN s.order_id IS NULL THEN t.avg_slippage_bps ELSE s.avg_slippage_bps END
            AS avg_slippage_bps,
          CASE WHEN s.order_id IS NULL THEN t.fill_rate ELSE s.fill_rate END AS fill_rate,
          CAST(NULL AS VARCHAR) AS assigned_hedge_id
        FROM (SELECT * FROM fallback WHERE created_at < TIMESTAMP '{LAST_SYNC}') t
          FULL JOIN sync_source s ON t.order_id = s.order_id""",
    "actions_state": "SELECT * FROM state",
    "actions_audit": _OPENED_AUDIT,
    "actions_rejected": """
        SELECT action_id, order_id, action_type, verdict AS reason,
          CAST(CASE verdict WHEN 'UNKNOWN_ORDER' THEN 404 WHEN 'NO_PRICE' THEN 500 ELSE 400 END
            AS INT) AS code, trader_id, ts
        FROM judged WHERE verdict <> 'OK'""",
    "hedge_rejected": """
        SELECT action_id, order_id, action_type, 'BAD_HEDGE' AS reason, CAST(422 AS INT) AS code, trader_id, ts
        FROM actions WHERE action_type = 'HEDGE' AND (action_id % 5 = 0 OR action_id % 6 = 0
          OR instrument_id IS NULL OR direction IS NULL OR qty IS NULL OR hedge_type IS NULL)""",
    "live_orders_rejected": """
        SELECT order_id, CASE WHEN qty % 700 = 0 THEN 'not_null(trader_id)'
          WHEN qty % 500 = 0 THEN 'check(direction)' ELSE 'unique(order_id)' END AS reason
        FROM (SELECT order_id, qty, false AS again FROM raw_orders
              UNION ALL SELECT order_id, qty, true FROM raw_orders WHERE qty % 300 = 0)
        WHERE qty % 700 = 0 OR qty % 500 = 0 OR again""",
    "hedge_requests": """
        SELECT action_id AS hedge_id, order_id AS parent_order_id, instrument_id, direction, qty,
          hedge_type, 'PENDING' AS status, ts AS created_at
        FROM accepted WHERE action_type = 'HEDGE'""",
    "audit_by_order": f"""{_OPENED_AUDIT}
        WHERE order_id IN (SELECT order_id FROM live WHERE status = 'PENDING')""",
    "audit_of_order": f"{_OPENED_AUDIT} WHERE order_id = 'ORD-7'",
    "adjustment_preview": """
        SELECT a.action_id, a.order_id, a.action_type,
          CASE WHEN a.action_type = 'ADJUST_SIZE'
            THEN CASE WHEN a.qty > 0 THEN a.qty * coalesce(l.price_limit, 0) END
            ELSE CASE WHEN a.price_limit > 0 THEN coalesce(l.qty, 0) * a.price_limit END
            END AS new_notional,
          CASE WHEN a.action_type = 'ADJUST_SIZE' AND a.qty > 0
            THEN round(CAST(a.qty - l.qty AS DOUBLE) / l.qty * 100, 1) + 0.0 END AS qty_change_pct
        FROM actions a JOIN live l ON a.order_id = l.order_id
        WHERE a.action_type IN ('ADJUST_SIZE', 'ADJUST_PRICE')""",
    "hedge_suggestions": """
        SELECT order_id, etf_ticker, instrument_id, type AS hedge_type, hedge_direction,
          suggested_qty,
          CAST(floor(suggested_qty * contract_size / CAST(qty AS DOUBLE) * 100 + 0.5) AS BIGINT)
            AS hedge_ratio_pct,
          abs(delta * suggested_qty * contract_size) AS delta_offset
        FROM (SELECT o.order_id, o.etf_ticker, i.instrument_id, i.type, i.contract_size, i.delta, o.qty,
                CASE WHEN o.direction = 'BUY' THEN 'SELL' ELSE 'BUY' END AS hedge_direction,
                CAST(greatest(1, CASE WHEN i.type = 'FUTURES'
                  THEN ceil(o.qty * coalesce(o.price_limit, 0)
                            / (coalesce(nullif(o.price_limit, 0), 500) * i.contract_size))
                  ELSE ceil(CAST(o.qty AS DOUBLE) / i.contract_size / abs(i.delta)) END) AS BIGINT)
                  AS suggested_qty
              FROM live o JOIN hedge_instruments i ON o.etf_ticker = i.underlying
              WHERE o.status NOT IN ('FILLED', 'CANCELLED'))""",
    "row_counts": _union([
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("raw_market_data", "raw_orders", "raw_executions", "actions")
    ]),
    "market_snapshot_json": f"""
        SELECT ticker, {_MARKET_NOW} AS generated_at, last_price, bid, ask, volume, vwap,
          intraday_high, intraday_low FROM snapshot""",
    "stream_market_dedupe": "SELECT DISTINCT ticker, event_time FROM raw_market_data",
    "stream_market_silver": f"SELECT * FROM market WHERE NOT ({LATE})",
    "stream_market_snapshot": "SELECT * FROM snapshot",
    "stream_gold_refresh": "SELECT * FROM analytics",
    "stream_order_actions": "SELECT * FROM state",
    "stream_gold_incremental": "SELECT * FROM analytics",
    "stream_trader_days": "SELECT * FROM performance",
    "stream_early_fills": "SELECT * FROM executions_s",
    "stream_expectations": _union([
        f"""SELECT 'orders_silver' AS table_name, CAST(batch AS BIGINT) AS batch, '{rule}' AS rule,
          count(*) FILTER ({predicate}) AS passed, count(*) - count(*) FILTER ({predicate}) AS failed,
          count(*) AS total, count(*) FILTER (order_id IS NOT NULL AND qty > 0) AS kept
        FROM (SELECT *, CASE WHEN created_at < TIMESTAMP '1997-01-01' THEN 0
                WHEN created_at < TIMESTAMP '1999-01-01' THEN 1 ELSE 2 END AS batch FROM raw_orders) GROUP BY batch"""
        for rule, predicate in (("valid_order_id", "order_id IS NOT NULL"), ("valid_qty", "qty > 0"))
    ]),
    "stream_late_rows": f"""
        SELECT 'market_data_silver' AS query, CAST(count(*) AS BIGINT) AS late_rows FROM tick_dedup WHERE {LATE}""",
    "stream_restarted": "SELECT * FROM orders_s",
    "live_orders_interleaved": f"""
        SELECT t.* REPLACE (s.status AS status, s.filled_qty AS filled_qty, s.avg_fill_price AS avg_fill_price,
          s.avg_slippage_bps AS avg_slippage_bps, s.fill_rate AS fill_rate, {_ORDERS_NOW} AS last_updated)
        FROM state t JOIN sync_source s ON t.order_id = s.order_id""",
    "stream_actions_redelivered": "SELECT * FROM state",
}


def _with_steps(statement: str) -> str:
    """Prepend the steps a statement uses, each before its first use."""
    texts = {**{name: duckdb_view(name) for name in VIEWS}, **_STEPS}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s+([a-z_0-9]+)", text):
            if name in texts and name not in needed:
                visit(texts[name])
                needed.append(name)

    visit(statement)
    steps = ",\n".join(f"{name} AS ({texts[name]})" for name in needed)
    return f"WITH {steps}\n{statement}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_steps(statement) for name, statement in _FINAL.items()}
