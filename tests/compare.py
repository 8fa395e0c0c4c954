"""Order-insensitive, exact comparison of a Spark result with a DuckDB result."""

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(directory):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return con


def _family(dtype: str) -> str:
    dtype = dtype.lower()
    if dtype.startswith(("decimal", "double", "float")):
        return "float"
    if dtype in ("tinyint", "smallint", "int", "integer", "bigint", "hugeint"):
        return "int"
    if dtype.startswith("timestamp"):
        return "timestamp"
    return {"varchar": "string"}.get(dtype, dtype)


def _value(x):
    if x is None or x is pd.NaT:
        return None
    if hasattr(x, "tzinfo") and getattr(x, "tzinfo", None) is not None:
        x = x.replace(tzinfo=None)
    return x


def _sorted(rows):
    return sorted((tuple(_value(v) for v in r) for r in rows), key=lambda r: tuple(map(repr, r)))


def differences(df, con, sql, limit=5):
    """Human-readable differences; empty if schema and all values agree exactly."""
    relation = con.sql(sql)
    ours = {n: _family(t) for n, t in df.dtypes}
    theirs = {n: _family(str(t)) for n, t in zip(relation.columns, relation.types)}
    if ours != theirs:
        return [f"schema: spark {ours} duckdb {theirs}"]
    names = sorted(ours)
    left = _sorted(df.select(*[df[f"`{n}`"] for n in names]).collect())
    right = _sorted(relation.select(*[f'"{n}"' for n in names]).fetchall())
    out = []
    if len(left) != len(right):
        out.append(f"rows: spark {len(left)} duckdb {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        out.append(f"{len(bad)} rows differ in {names}")
        out += [f"  spark {a}\n  duck  {b}" for a, b in bad[:limit]]
    return out
