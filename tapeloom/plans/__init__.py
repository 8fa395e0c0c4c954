"""Silver and gold tables, read models and desk KPIs."""
