"""Row expectations and table constraints."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Mapping[str, str]

# The expectations of the silver tables.
TICK_RULES: Rules = {
    "valid_ticker": "ticker IS NOT NULL",
    "valid_price": "last_price > 0",
    "valid_spread": "ask >= bid",
}
ORDER_RULES: Rules = {
    "valid_order_id": "order_id IS NOT NULL",
    "valid_qty": "qty > 0",
}
EXECUTION_RULES: Rules = {
    "valid_exec_id": "exec_id IS NOT NULL",
    "positive_fill": "fill_qty > 0",
}


def _holds(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows for which every rule is TRUE; unknown counts as failed."""
    for predicate in rules.values():
        df = df.where(F.expr(predicate))
    return df


def rule_counts(rules: Rules) -> list[Column]:
    """Aggregates: total rows, rows kept by all rules, rows that hold each, as rule_0 and so on."""
    kept = F.lit(True)
    for predicate in rules.values():
        kept = kept & _holds(predicate)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(kept).alias("kept"),
        *[F.count_if(_holds(p)).alias(f"rule_{i}") for i, p in enumerate(rules.values())],
    ]


def expectation_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """Passed and failed rows per rule, and rows kept by all of them, in one pass."""
    counts = df.agg(*rule_counts(rules))
    per_rule = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"rule_{i}").alias("passed"))
        for i, name in enumerate(rules)
    ])
    return counts.select("total", "kept", F.inline(per_rule)).select(
        "rule", "passed", (F.col("total") - F.col("passed")).alias("failed"), "total", "kept"
    )


def constraint_violations(
    df: DataFrame,
    keys: Iterable[str] = (),
    not_null: Iterable[str] = (),
    domains: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Violations per declared constraint.

    NOT NULL and CHECK count rows, a key counts the values that occur more than
    once. A NULL passes a CHECK, as in SQL.
    """
    checks = {f"not_null({c})": F.col(c).isNull() for c in not_null}
    for column, allowed in (domains or {}).items():
        checks[f"check({column})"] = ~F.col(column).isin(*allowed)
    keys = list(keys)
    if not keys and not checks:
        raise ValueError("no constraint given")
    counted = {name: F.count_if(bad) for name, bad in checks.items()}
    names = [f"check_{i}" for i in range(len(checks))]
    if keys:  # counted within each key, then summed up, so the rows are read once
        per_key = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in zip(names, counted.values(), strict=True)]
        )
        totals = [F.coalesce(F.sum(n), F.lit(0)) for n in names] + [F.count_if(F.col("n") > 1)]
        names.append("repeated")
        row = per_key.agg(*[t.alias(n) for n, t in zip(names, totals, strict=True)])
    else:
        row = df.agg(*[c.alias(n) for n, c in zip(names, counted.values(), strict=True)])
    labels = [*checks, *([f"unique({', '.join(keys)})"] if keys else [])]
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("constraint"), F.col(n).alias("violations"))
        for label, n in zip(labels, names, strict=True)
    ])))


class Enforced(NamedTuple):
    kept: DataFrame
    rejected: DataFrame


def enforce(
    df: DataFrame, keys: Iterable[str], required: Iterable[str], domains: Mapping[str, Iterable[str]], one_per_key: bool = False
) -> Enforced:
    """Rows that a table with these constraints takes, and the others with a reason.

    A row that is repeated as it is counts once. Of different rows with one key, one without other
    faults stays; which one is the same for every run. A NULL passes a CHECK, but not a key. Rows that were grouped
    by the keys are one_per_key: they have no other row to be compared with, and are not shuffled.
    """
    reason = F.lit(None).cast("string")
    for column, allowed in reversed(list(domains.items())):
        reason = F.when(~F.col(column).isin(*allowed), f"check({column})").otherwise(reason)
    for column in reversed(list(required)):
        reason = F.when(F.col(column).isNull(), f"not_null({column})").otherwise(reason)
    keys, columns = list(keys), df.columns
    if one_per_key:
        judged = df.withColumn("reason", reason)
        return Enforced(judged.where(F.col("reason").isNull()).drop("reason"), judged.where(F.col("reason").isNotNull()))
    rows = df.distinct().withColumns({"reason": reason, "content": F.xxhash64(*columns)})
    good = rows.where(F.col("reason").isNull())
    first = good.groupBy(*[F.col(k).alias(f"first_{k}") for k in keys]).agg(F.min("content").alias("first"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"first_{k}"))
    is_first = F.col("content") == F.col("first")
    judged = rows.join(first, same, "left").withColumn(
        "reason", F.coalesce("reason", F.when(~F.coalesce(is_first, F.lit(False)), f"unique({', '.join(keys)})"))
    )
    return Enforced(
        judged.where(F.col("reason").isNull()).select(*columns),
        judged.where(F.col("reason").isNotNull()).select(*columns, "reason"),
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill missing values, and add the column where the input lacks it."""
    filled = {
        name: F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value))
        if name in df.columns
        else (value if isinstance(value, Column) else F.lit(value))
        for name, value in defaults.items()
    }
    return df.withColumns(filled)
