"""Desk tables derived from the generic test tables.

One text per table serves Spark and DuckDB: `{orders}` and the like stand for the
input tables, `{K}` for the number inside an event's JSON properties. Prices are
multiples of 1/4, so that sums are exact and independent of partition order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The clocks of the market and of the order book in the test data.
MARKET_AS_OF = "2024-01-30 23:59:59"
ORDERS_AS_OF = "2001-08-31 00:00:00"


def _ticker(key: str) -> str:
    """Six known funds and one that the dimension lacks."""
    return (
        f"CASE {key} % 7 WHEN 0 THEN 'SPY' WHEN 1 THEN 'QQQ' WHEN 2 THEN 'IVV' WHEN 3 THEN 'VTI' "
        f"WHEN 4 THEN 'XLK' WHEN 5 THEN 'XLF' ELSE 'ZZZ' END"
    )


VIEWS: dict[str, str] = {
    "raw_orders": f"""
        SELECT CONCAT('ORD-', CAST(o_orderkey AS STRING)) AS order_id,
          CONCAT('T', CAST(o_custkey % 25 AS STRING)) AS trader_id,
          {_ticker('o_orderkey')} AS etf_ticker,
          CASE WHEN o_orderkey % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS direction,
          CAST(100 * (o_orderkey % 150) AS INT) AS qty,
          CASE o_orderkey % 4 WHEN 0 THEN 'LIMIT' WHEN 1 THEN 'VWAP' WHEN 2 THEN 'TWAP'
            ELSE 'MKT' END AS order_type,
          CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(400 + o_orderkey % 97
                      + CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE -2 END AS DOUBLE) / 4
            END AS price_limit,
          CASE WHEN o_orderkey % 10 = 9 THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'FILLED'
            WHEN o_orderstatus = 'P' THEN 'PARTIAL' ELSE 'PENDING' END AS status,
          CAST(date_trunc('month', o_orderdate) AS TIMESTAMP)
            + INTERVAL '1' SECOND * CAST(34200 + o_orderkey % 23400 AS INT) AS created_at,
          CASE o_custkey % 6 WHEN 0 THEN 'TWAP' WHEN 1 THEN 'VWAP' WHEN 2 THEN 'IS'
            WHEN 3 THEN 'POV' WHEN 4 THEN 'MKT_ON_CLOSE' ELSE NULL END AS strategy,
          CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(400 + o_orderkey % 97 AS DOUBLE) / 4 END AS arrival_price
        FROM {{orders}}""",
    "raw_executions": """
        SELECT CONCAT('EXEC-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
              CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING), '-',
              CAST(CAST(l_shipdate AS DATE) AS STRING)) AS exec_id,
          CASE WHEN l_partkey % 211 = 0 THEN CONCAT('MISSING-', CAST(l_orderkey AS STRING))
            ELSE CONCAT('ORD-', CAST(l_orderkey AS STRING)) END AS order_id,
          CASE WHEN l_partkey % 199 = 0 THEN 0 ELSE CAST(l_quantity AS INT) * 100 END AS fill_qty,
          CAST(400 + (l_partkey + l_linenumber) % 97 AS DOUBLE) / 4 AS fill_price,
          CASE l_suppkey % 5 WHEN 0 THEN 'NYSE_ARCA' WHEN 1 THEN 'NASDAQ' WHEN 2 THEN 'CBOE_EDGX'
            WHEN 3 THEN 'IEX' ELSE 'MEMX' END AS venue,
          CAST(l_shipdate AS TIMESTAMP) AS exec_time
        FROM {lineitem}""",
    "raw_market_data": f"""
        SELECT CONCAT('MKT_', CAST(event_id AS STRING)) AS event_id,
          CAST(date_trunc('hour', ts) AS TIMESTAMP) AS event_time,
          CASE WHEN user_id % 53 = 0 THEN NULL ELSE {_ticker('user_id')} END AS ticker,
          last_price - CAST(k AS DOUBLE) / 128 AS bid,
          last_price + CAST(k - 6 AS DOUBLE) / 128 AS ask,
          CASE WHEN event_id % 101 = 0 THEN CAST(0 AS DOUBLE) ELSE last_price END AS last_price,
          CAST(1000 * (k + 1) AS BIGINT) AS volume,
          CAST(100 * (event_id + 1) AS BIGINT) AS cum_volume,
          CASE WHEN event_id % 103 = 0 THEN CAST(0 AS DOUBLE)
            ELSE last_price + CAST(1 AS DOUBLE) / 4 END AS vwap,
          'sim' AS source
        FROM (SELECT *, CAST({{K}} AS INT) AS k,
                CAST(100 + event_id % 97 AS DOUBLE) AS last_price FROM {{events}}) e""",
    "actions": """
        SELECT CAST(event_id AS BIGINT) AS action_id,
          CASE WHEN event_id % 97 = 0 THEN 'ORD-NONE'
            ELSE CONCAT('ORD-', CAST((event_id % 200) * 6 + 1 AS STRING)) END AS order_id,
          CASE WHEN event_id % 13 = 0 THEN 'CANCEL' WHEN event_id % 17 = 0 THEN 'EXECUTE'
            WHEN event_type = 'purchase' THEN 'HEDGE'
            WHEN event_type IN ('click', 'error') THEN 'ADJUST_SIZE' ELSE 'ADJUST_PRICE'
            END AS action_type,
          CAST(100 * (k - 2) AS INT) AS qty,
          CASE WHEN k % 33 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(400 + k AS DOUBLE) / 4
            END AS price_limit,
          'ES_MAR26' AS instrument_id, 'SELL' AS direction, 'FUTURES' AS hedge_type,
          CONCAT('T', CAST(user_id % 25 AS STRING)) AS trader_id,
          CAST(ts AS TIMESTAMP) AS ts
        FROM (SELECT *, CAST({K} AS INT) AS k FROM {events}) e""",
    # 'ZZZ' and trader T24 are missing, to leave left joins without a match.
    "etf_reference": """
        SELECT CAST(c0 AS STRING) AS ticker, CAST(c1 AS STRING) AS name,
          CAST(c2 AS DOUBLE) AS aum_bn, CAST(c3 AS STRING) AS sector,
          CAST(c4 AS DOUBLE) AS expense_ratio
        FROM (VALUES ('SPY', 'SPDR S&P 500 ETF Trust', 530.2, 'Broad Market', 0.0945),
          ('QQQ', 'Invesco QQQ Trust', 290.8, 'Technology', 0.20),
          ('IVV', 'iShares Core S&P 500 ETF', 490.1, 'Broad Market', 0.03),
          ('VTI', 'Vanguard Total Stock Market ETF', 410.5, 'Broad Market', 0.03),
          ('XLK', 'Technology Select Sector SPDR', 72.3, 'Technology', 0.09),
          ('XLF', 'Financial Select Sector SPDR', 45.1, 'Financials', 0.09)
        ) AS t(c0, c1, c2, c3, c4)""",
    "hedge_instruments": """
        SELECT CAST(c0 AS STRING) AS instrument_id, CAST(c1 AS STRING) AS type,
          CAST(c2 AS STRING) AS underlying, CAST(c3 AS STRING) AS expiry,
          CAST(c4 AS DOUBLE) AS strike, CAST(c5 AS INT) AS contract_size, CAST(c6 AS DOUBLE) AS delta
        FROM (VALUES ('ES_MAR26', 'FUTURES', 'SPY', '2026-03-21', NULL, 50, 1.0),
          ('NQ_MAR26', 'FUTURES', 'QQQ', '2026-03-21', NULL, 20, 1.0),
          ('ES_JUN26', 'FUTURES', 'SPY', '2026-06-20', NULL, 50, 1.0),
          ('NQ_JUN26', 'FUTURES', 'QQQ', '2026-06-20', NULL, 20, 1.0),
          ('SPY_P510_MAR26', 'OPTIONS', 'SPY', '2026-03-21', 510.0, 100, -0.45),
          ('SPY_P500_MAR26', 'OPTIONS', 'SPY', '2026-03-21', 500.0, 100, -0.30),
          ('QQQ_P440_MAR26', 'OPTIONS', 'QQQ', '2026-03-21', 440.0, 100, -0.35),
          ('SPY_P490_JUN26', 'OPTIONS', 'SPY', '2026-06-20', 490.0, 100, -0.28)
        ) AS t(c0, c1, c2, c3, c4, c5, c6)""",
    "traders": """
        SELECT CONCAT('T', CAST(i AS STRING)) AS trader_id,
          CONCAT('Trader ', CAST(i AS STRING)) AS name,
          CASE i % 3 WHEN 0 THEN 'ETF Execution' WHEN 1 THEN 'Index Arb' ELSE 'Macro/Overlay'
            END AS desk,
          CAST(1000000 * (i + 1) AS BIGINT) AS risk_limit_usd
        FROM (SELECT DISTINCT c_custkey % 25 AS i FROM {customer}) c
        WHERE i <> 24""",
    # A listing of instruments that grows with the parts table.
    "instrument_catalog": f"""
        SELECT CONCAT('INST-', CAST(p_partkey AS STRING)) AS instrument_id,
          CASE WHEN p_partkey % 2 = 0 THEN 'FUTURES' ELSE 'OPTIONS' END AS type,
          {_ticker('p_partkey')} AS underlying,
          CASE WHEN p_size % 2 = 0 THEN '2026-03-21' ELSE '2026-06-20' END AS expiry,
          CASE WHEN p_partkey % 2 = 1 THEN CAST(400 + p_partkey % 97 AS DOUBLE) END AS strike,
          CAST(CASE WHEN p_partkey % 2 = 0 THEN 50 ELSE 100 END AS INT) AS contract_size,
          CASE WHEN p_partkey % 2 = 0 THEN CAST(1 AS DOUBLE)
            ELSE CAST(-(1 + p_size % 16) AS DOUBLE) / 32 END AS delta
        FROM {{part}}""",
}

_INPUTS = ("orders", "lineitem", "events", "customer", "part")


def duckdb_view(name: str) -> str:
    text = VIEWS[name].replace("{K}", "json_extract_string(props, '$.k')")
    for table in _INPUTS:
        text = text.replace(f"{{{table}}}", table)
    return text


def spark_view(spark: SparkSession, directory: str, name: str) -> DataFrame:
    text = VIEWS[name].replace("{K}", "get_json_object(props, '$.k')")
    tables = {
        t: spark.read.parquet(f"{directory}/{t}.parquet") for t in _INPUTS if f"{{{t}}}" in text
    }
    return spark.sql(text, **tables)
