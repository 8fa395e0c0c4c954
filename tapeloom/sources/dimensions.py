"""Rows of the small dimensions the desk ships with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.schemas import TABLES

# The funds, their top holdings, the hedge instruments and the traders.
# intraday_iv is a measured quantity without a fixed value.
ETF_REFERENCE = [
    ("SPY", "SPDR S&P 500 ETF Trust", 530.2, "S&P 500", "Broad Market", 0.0945, None, 521.50),
    ("QQQ", "Invesco QQQ Trust", 290.8, "Nasdaq-100", "Technology", 0.20, None, 448.30),
    ("IVV", "iShares Core S&P 500 ETF", 490.1, "S&P 500", "Broad Market", 0.03, None, 524.75),
    ("VTI", "Vanguard Total Stock Market ETF", 410.5, "CRSP US Total Market", "Broad Market",
     0.03, None, 263.40),
    ("XLK", "Technology Select Sector SPDR", 72.3, "S&P Tech Sector", "Technology",
     0.09, None, 218.60),
    ("XLF", "Financial Select Sector SPDR", 45.1, "S&P Financial Sector", "Financials",
     0.09, None, 49.80),
]

HEDGE_INSTRUMENTS = [
    ("ES_MAR26", "FUTURES", "SPY", "2026-03-21", None, 50, 1.0),
    ("NQ_MAR26", "FUTURES", "QQQ", "2026-03-21", None, 20, 1.0),
    ("ES_JUN26", "FUTURES", "SPY", "2026-06-20", None, 50, 1.0),
    ("NQ_JUN26", "FUTURES", "QQQ", "2026-06-20", None, 20, 1.0),
    ("SPY_P510_MAR26", "OPTIONS", "SPY", "2026-03-21", 510.0, 100, -0.45),
    ("SPY_P500_MAR26", "OPTIONS", "SPY", "2026-03-21", 500.0, 100, -0.30),
    ("QQQ_P440_MAR26", "OPTIONS", "QQQ", "2026-03-21", 440.0, 100, -0.35),
    ("SPY_P490_JUN26", "OPTIONS", "SPY", "2026-06-20", 490.0, 100, -0.28),
]

TRADERS = [
    ("T001", "Alex Chen", "ETF Execution", 50_000_000),
    ("T002", "Maria Santos", "Index Arb", 75_000_000),
    ("T003", "James Park", "ETF Execution", 40_000_000),
    ("T004", "Sarah Kim", "Macro/Overlay", 100_000_000),
    ("T005", "David Liu", "ETF Execution", 30_000_000),
]

_ROWS = {
    "etf_reference": ETF_REFERENCE,
    "hedge_instruments": HEDGE_INSTRUMENTS,
    "traders": TRADERS,
}


def dimension(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(_ROWS[name], TABLES[name].schema)
