"""URL filters: host and path rules, and exact membership in a list by a cascade of Bloom filters.

Cascade. Level 0 encodes the listed keys; of all other keys of the corpus, those that pass it by
chance are encoded by level 1; of the listed keys, those that pass level 1 by level 2; and so on
until none passes. A key of this universe is judged by the first level that it does not pass: listed
if that level is odd. The answer is exact for every key of the universe, listed or not.

Building takes one aggregate over the keys (a key that a third of the rows have is reduced before
the shuffle) and then only the keys that still pass; keys travel as 128-bit hashes. Which keys are
listed is a flag in that aggregate, so neither building nor asking joins anything.

Size. A filter goes to all tasks. Keys are split by hash into shards whose filters have at most
SHARD_BITS in all; each shard's filter is broadcast on its own, and each row only meets the
filter of its shard, so no task holds more than that, however long the list is.

A null url, or one without ://, has an empty host and path, fits no rule and is judged by the key "".
Empty tables, repeated rows, very long urls and further columns need no special treatment.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.common import arrow, mixed, stored

#: Bits of the filters of one shard, at most; 16 MB.
SHARD_BITS = 1 << 27
#: After so many levels few keys are left, and lower rates end the cascade at little cost.
FIRST_LEVELS = 7
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# -- hosts, paths and rules ------------------------------------------------------------------


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule that fits, or null. A rule is host/path; it fits the host and its subdomains,
    if the path starts with the rule's."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


# -- the cascade -----------------------------------------------------------------------------


@dataclass
class Level:
    bits: int
    hashes: int
    packed: np.ndarray

    def passes(self, h1: np.ndarray, h2: np.ndarray, depth: int) -> np.ndarray:
        ok = np.ones(len(h1), bool)
        for at in places(h1, h2, depth, self.bits, self.hashes):
            ok &= (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return ok


def places(h1: np.ndarray, h2: np.ndarray, depth: int, bits: int, hashes: int) -> Iterator[np.ndarray]:
    """The bits of keys in a level; every level hashes anew."""
    a = mixed(h1.view(np.uint64) + np.uint64(2 * depth + 1))
    b = mixed(h2.view(np.uint64) + np.uint64(2 * depth + 2)) | np.uint64(1)
    for j in range(hashes):
        yield ((a + np.uint64(j) * b) % np.uint64(bits)).astype(np.int64)


def _pair(h1: pa.Array, h2: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False)


@dataclass
class Cascade:
    """The levels of one shard."""

    levels: list[Level] = field(default_factory=list)

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.full(len(h1), len(self.levels) % 2 == 1)
        todo = np.arange(len(h1))
        for depth, level in enumerate(self.levels):
            ok = level.passes(h1[todo], h2[todo], depth)
            out[todo[~ok]] = depth % 2 == 1
            todo = todo[ok]
        return out


def _level(keys: DataFrame, n: int, rate: float, depth: int) -> Level:
    """A Bloom filter of n keys; what comes to the driver is its words, bits / 64 at most."""
    hashes = max(1, round(math.log2(1 / rate)))
    bits = max(64, -(-int(n * hashes / math.log(2)) // 64) * 64)

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate([np.empty(0, np.int64), *places(*_pair(*batch.columns), depth, bits, hashes)])
            yield pa.RecordBatch.from_arrays([pa.array(at)], ["at"])

    words = (
        keys.select("h1", "h2").mapInArrow(set_bits, "at long")
        .select(F.shiftright("at", 6).alias("word"), F.pmod("at", F.lit(64)).cast("int").alias("b"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toPandas()
    )
    packed = np.zeros(bits // 64, np.int64)
    packed[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return Level(bits, hashes, packed.view(np.uint8))


def _passing(keys: DataFrame, level: Level, depth: int) -> DataFrame:
    sent = keys.sparkSession.sparkContext.broadcast(level)

    def passes(h1: pa.Array, h2: pa.Array) -> pa.Array:
        return pa.array(sent.value.passes(*_pair(h1, h2), depth))

    return keys.where(arrow(passes, "boolean")("h1", "h2"))


def hashed(key: Column) -> list[Column]:
    """128 bits of a key."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def build(keys: DataFrame, shard_bits: int = SHARD_BITS) -> list[Cascade]:
    """The cascades of the shards. keys (key, listed) holds the whole universe, each key once or more;
    a key is listed if any of its rows says so. A key's shard is pmod(h1, number of shards)."""
    universe = stored(
        keys.select(*hashed(F.col("key")), F.coalesce("listed", F.lit(False)).alias("listed"))
        .groupBy("h1", "h2").agg(F.max("listed").alias("listed")),
        "universe",
    )
    counts = universe.groupBy("listed").count().collect()
    n = {r["listed"]: r["count"] for r in counts}
    listed, other = n.get(True, 0), n.get(False, 0)
    # at this rate of the first level, and 1/2 of the others, all levels together are smallest
    rate = min(0.5, math.sqrt(0.5) * listed / max(other, 1)) or 0.5
    total = listed * math.log2(1 / rate) * 1.45 + 8 * listed
    shards = max(1, math.ceil(1.1 * total / shard_bits))
    return [_cascade(universe.where(F.pmod("h1", F.lit(shards)) == s), rate) for s in range(shards)]


def _cascade(universe: DataFrame, rate: float) -> Cascade:
    inside, outside = universe.where("listed"), universe.where("NOT listed")
    cascade = Cascade()
    while n := inside.count():
        depth = len(cascade.levels)
        level = _level(inside, n, (rate, *[0.5] * FIRST_LEVELS)[depth] if depth <= FIRST_LEVELS else 2**-10, depth)
        cascade.levels.append(level)
        inside, outside = stored(_passing(outside, level, depth), "passing"), inside
    return cascade


def _listed(h1: Column, h2: Column, cascade: Cascade, spark: SparkSession) -> Column:
    sent = spark.sparkContext.broadcast(cascade)

    def listed(h1: pa.Array, h2: pa.Array) -> pa.Array:
        return pa.array(sent.value.listed(*_pair(h1, h2)))

    return arrow(listed, "boolean")(h1, h2)


def with_membership(rows: DataFrame, key: str, cascades: list[Cascade], name: str = "listed") -> DataFrame:
    """rows with a column that says whether the key, which is in the universe, is listed."""
    h1, h2 = hashed(F.col(key))
    parts = [
        (rows if len(cascades) == 1 else rows.where(F.pmod(h1, F.lit(len(cascades))) == s))
        .withColumn(name, _listed(h1, h2, cascade, rows.sparkSession))
        for s, cascade in enumerate(cascades)
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def judged(pages: DataFrame, rules: dict[str, str], listed: Column, shard_bits: int = SHARD_BITS) -> DataFrame:
    """(page_id, host, path, rule, verdict) of pages (page_id, url). rules gives each rule's verdict. A page
    that no rule fits is blocked if its key, host and path, is listed; a key is listed if the condition
    `listed` on host and path holds."""
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = rows.withColumn("key", F.concat("host", "path"))
    cascades = build(rows.select("key", listed.alias("listed")), shard_bits)
    rows = with_membership(rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), list(rules))), "key", cascades)
    verdict = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    for rule, says in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(says)).otherwise(verdict)
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
