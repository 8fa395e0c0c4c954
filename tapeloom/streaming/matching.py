"""Fills and orders that arrive as two streams, matched over stored parts; either may come first.

A batch stores its fills and its orders as a part each. Its fills are joined with all kept orders, and its
orders with the fills kept before, so every pair meets once, in the batch of its later row. The watermark is `late` behind the
newest row of the stream that is behind. Rows at or before it are late and dropped. A fill without an order goes on in
the batch after which the watermark has passed its time by `within`: no order can come that it belongs to.

The manifest of a batch names the parts that are kept after it. A batch reads the manifest before its own, so a retry starts
from the same parts and replaces what it wrote. FAN parts of one level are merged into one of the next, so a row is written
again as often as there are levels, the logarithm of the number of batches; a part goes as a whole once all its rows are too old to meet others.
"""

from __future__ import annotations

import json
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.quality import EXECUTION_RULES, expect_or_drop
from tapeloom.plans.silver import matched_executions, unmatched_executions
from tapeloom.schemas import TABLES
from tapeloom.sources.layout import Layout, _folder, write_batch

#: Parts of one level that are merged into one.
FAN = 8
TIMES = {"fills": "exec_time", "orders": "created_at"}
_KINDS = {
    "fills": "exec_id string, order_id string, fill_qty int, fill_price double, venue string, exec_time timestamp",
    "orders": "order_id string, created_at timestamp, qty int, arrival_price double, etf_ticker string, trader_id string, direction string",
}


class Part(NamedTuple):
    """What batches first to last stored, how often it was merged, and the newest time in microseconds."""

    first: int
    last: int
    level: int
    top: int


class Manifest(NamedTuple):
    """The kept parts and the newest time of each side, and the watermark that follows."""

    parts: dict[str, list[Part]]
    tops: dict[str, int | None]
    watermark: int | None


EMPTY = Manifest({side: [] for side in TIMES}, dict.fromkeys(TIMES), None)


def _root(layout: Layout) -> str:
    return layout.path("matching")


def _part_path(layout: Layout, side: str, first: int, last: int) -> str:
    return f"{_root(layout)}/{side}/{first}-{last}"


def _numbers(spark: SparkSession, layout: Layout) -> list[int]:
    where, fs = _folder(spark, f"{_root(layout)}/manifests/batch=*")
    return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.globStatus(where) or ())


def manifest_before(spark: SparkSession, layout: Layout, batch: int) -> Manifest:
    numbers = _numbers(spark, layout)
    if numbers and numbers[-1] > batch:
        raise RuntimeError(f"matching already has batch {numbers[-1]}; batch {batch} is of another query")
    older = [n for n in numbers if n < batch]
    if not older:
        return EMPTY
    found = json.loads(spark.read.text(f"{_root(layout)}/manifests/batch={older[-1]}").first()[0])
    return Manifest({side: [Part(*p) for p in parts] for side, parts in found["parts"].items()}, found["tops"], found["watermark"])


def _write_manifest(spark: SparkSession, layout: Layout, batch: int, manifest: Manifest) -> None:
    text = json.dumps(manifest._asdict())
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{_root(layout)}/manifests/batch={batch}")


def _read(spark: SparkSession, layout: Layout, side: str, parts: list[Part]) -> DataFrame:
    paths = [_part_path(layout, side, p.first, p.last) for p in parts]
    return spark.read.schema(_KINDS[side]).parquet(*paths) if paths else spark.createDataFrame([], _KINDS[side])


def _moved(spark: SparkSession, time: int, by: str) -> int:
    """A time in microseconds moved by an interval."""
    return spark.range(1).select(F.unix_micros(F.expr(f"timestamp_micros({time}) {by}"))).first()[0]


def _stored(spark: SparkSession, layout: Layout, side: str, rows: DataFrame, first: int, last: int, level: int = 0) -> Part | None:
    """The rows as a part; none if there are no rows."""
    path = _part_path(layout, side, first, last)
    rows.write.mode("overwrite").parquet(path)
    top = spark.read.schema(_KINDS[side]).parquet(path).agg(F.max(F.unix_micros(TIMES[side]))).first()[0]
    return None if top is None else Part(first, last, level, top)


def _merged(spark: SparkSession, layout: Layout, side: str, parts: list[Part]) -> list[Part]:
    """parts with the last FAN made into one, while they are of one level; levels never ascend along parts."""
    while len(parts) >= FAN and parts[-FAN].level == parts[-1].level:
        few = parts[-FAN:]
        rows = _read(spark, layout, side, few)  # small files are read together, so there are fewer after
        parts = [*parts[:-FAN], _stored(spark, layout, side, rows, few[0].first, few[-1].last, few[0].level + 1)]
    return parts


def _drop_unnamed(spark: SparkSession, layout: Layout, batch: int, *kept: Manifest) -> None:
    """Delete the parts that no manifest names any more, and manifests that no retry reads."""
    for side in TIMES:
        named = {f"{p.first}-{p.last}" for m in kept for p in m.parts[side]}
        where, fs = _folder(spark, f"{_root(layout)}/{side}/*")
        for status in fs.globStatus(where) or ():
            if status.getPath().getName() not in named:
                fs.delete(status.getPath(), True)
    for number in [n for n in _numbers(spark, layout) if n < batch][:-1]:
        where, fs = _folder(spark, f"{_root(layout)}/manifests/batch={number}")
        fs.delete(where, True)


def tagged(fills: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows of both as one shape, a struct of either; also of streams."""
    kinds = {side: f"struct<{', '.join(c.replace(' ', ': ') for c in ddl.split(', '))}>" for side, ddl in _KINDS.items()}
    one = lambda side: F.struct(*(c.split(" ")[0] for c in _KINDS[side].split(", "))).cast(kinds[side])
    fill, order = one("fills").alias("fill"), one("orders").alias("order")
    return fills.select(fill, F.lit(None).cast(kinds["orders"]).alias("order")).unionByName(
        orders.select(F.lit(None).cast(kinds["fills"]).alias("fill"), order)
    )


def match_batch(spark: SparkSession, layout: Layout, fills: DataFrame, orders: DataFrame, batch: int, within: str, late: str) -> None:
    """Write the silver fills that a batch of fills and orders completes; a fill that a rule drops does not
    move the watermark on. Rows without a time or an order's id never meet any."""
    before = manifest_before(spark, layout, batch)
    arrived = {"fills": expect_or_drop(fills, EXECUTION_RULES).where("exec_time IS NOT NULL"), "orders": orders.where("order_id IS NOT NULL AND created_at IS NOT NULL")}
    old = {side: _merged(spark, layout, side, before.parts[side]) for side in TIMES}
    new, tops = {}, dict(before.tops)
    for side, rows in arrived.items():
        if before.watermark is not None:
            rows = rows.where(F.col(TIMES[side]) > F.timestamp_micros(F.lit(before.watermark)))
        part = _stored(spark, layout, side, rows, batch, batch)
        new[side] = [part] if part else []
        if part:
            tops[side] = part.top if tops[side] is None else max(part.top, tops[side])
    watermark = None if None in tops.values() else _moved(spark, min(tops.values()), f"- INTERVAL {late}")
    read = partial(_read, spark, layout)
    orders_now = read("orders", old["orders"] + new["orders"])
    done = []
    if new["fills"]:
        done.append(matched_executions(read("fills", new["fills"]), orders_now, within))
    if new["orders"] and old["fills"]:
        done.append(matched_executions(read("fills", old["fills"]), read("orders", new["orders"]), within))
    if watermark != before.watermark:
        passed = F.col("exec_time") + F.expr(f"INTERVAL {within}")
        waiting = read("fills", old["fills"] + new["fills"]).where(passed <= F.timestamp_micros(F.lit(watermark)))
        if before.watermark is not None:
            waiting = waiting.where(passed > F.timestamp_micros(F.lit(before.watermark)))
        done.append(unmatched_executions(waiting, orders_now, within))
    silver = reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], TABLES["executions_silver"].schema)
    write_batch(silver, layout, "executions_silver", batch)
    parts = {side: old[side] + new[side] for side in TIMES}
    if watermark is not None:
        oldest = _moved(spark, watermark, f"- INTERVAL {within}")
        limits = {"fills": oldest, "orders": _moved(spark, oldest, f"- INTERVAL {within}")}  # a kept fill still asks for orders as much older
        parts = {side: [p for p in parts[side] if p.top > limits[side]] for side in TIMES}
    after = Manifest(parts, tops, watermark)
    _write_manifest(spark, layout, batch, after)
    _drop_unnamed(spark, layout, batch, before, after)
