"""Table-level operators: data quality, upsert, order-state replay, hedging."""
