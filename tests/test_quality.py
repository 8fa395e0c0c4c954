import pytest
from pyspark.sql import functions as F

from tapeloom.operators.quality import constraint_violations, enforce, expect_or_drop, with_defaults
from tapeloom.schemas import TABLES
from tests.helpers import LIVE, by, table


def test_unknown_counts_as_failed(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    assert [r.x for r in expect_or_drop(df, {"positive": "x > 0"}).collect()] == [1]
    assert expect_or_drop(df, {}).count() == 3


def test_constraint_violations(spark):
    spec = TABLES["live_orders"]
    df = table(spark, "live_orders", [
        dict(order_id="a"), dict(order_id="a"), dict(order_id="b", direction="HOLD"),
        dict(order_id="c", qty=None, direction=None), dict(order_id=None),
    ], **LIVE)
    found = by(constraint_violations(df, spec.keys, spec.not_null, spec.domains), "constraint")
    violations = {k: r.violations for k, r in found.items() if r.violations}
    assert violations == {
        "not_null(order_id)": 1, "not_null(qty)": 1, "not_null(direction)": 1,
        "check(direction)": 1, "unique(order_id)": 1,
    }
    assert len(found) == len(spec.not_null) + 2
    with pytest.raises(ValueError):
        constraint_violations(df)


def test_defaults(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a int, b string")
    rows = with_defaults(df, {"a": 7, "b": F.lit("y"), "c": 0.5}).collect()
    assert [tuple(r) for r in rows] == [(1, "y", 0.5), (7, "x", 0.5)]


def test_what_a_table_refuses(spark):
    spec = TABLES["live_orders"]
    df = table(spark, "live_orders", [
        dict(order_id="a"), dict(order_id="a"), dict(order_id="b", direction="HOLD"), dict(order_id="b"),
        dict(order_id="c", qty=1), dict(order_id="c", qty=2), dict(order_id=None), dict(order_id="d", direction="HOLD", qty=None),
    ], **LIVE)
    kept, rejected = enforce(df, spec.keys, spec.required, spec.domains)
    assert sorted(r.order_id for r in kept.collect()) == ["a", "b", "c"]
    assert sorted((str(r.order_id), r.reason) for r in rejected.collect()) == [
        ("None", "not_null(order_id)"), ("b", "check(direction)"), ("c", "unique(order_id)"), ("d", "not_null(qty)")]
