"""What several operators share: words, hashes, scratch tables, skewed joins, components."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tapeloom.session import scratch_dir

#: A key with at least this share of a side's rows counts as hot; so there are at most PARTS hot keys.
PARTS = 256
#: Bits of a prefilter. Fixed, so what is broadcast never grows with the data.
FILTER_BITS = 1 << 23
#: Ids that are null count as one id, larger than all others.
NO_ID = 2**63 - 1


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ship-"), f"{package.name}.zip")  # Spark copies it from the driver
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def arrow(function: Callable, returns: str) -> Callable:
    """A function of Arrow arrays as a function of columns."""
    code = function.__code__
    function.__annotations__ = dict.fromkeys([*code.co_varnames[: code.co_argcount], "return"], pa.Array)
    return F.arrow_udf(function, returns)


# -- scratch ---------------------------------------------------------------------------------


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once as Parquet to the shared scratch folder, and read again."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunked(df: DataFrame, key: str, order: list[str], label: str) -> DataFrame:
    """df in ascending order of key and order, with the column chunk.

    A key's rows lie in one chunk or in several that follow each other, so what runs along a key runs
    along each chunk first, and then along one row for each of the key's chunks. Stored, since
    the chunks have to stay as they are.
    """
    return stored(df.repartitionByRange(key, *order).withColumn("chunk", F.spark_partition_id()), label)


# -- words and hashes ------------------------------------------------------------------------


def lower_words(text: str | None) -> list[bytes]:
    """Runs of other characters than x20 and x09-x0D, with A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each window of k words; empty if there are fewer words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = mixed(hashes[:n] + np.uint64(k))
    for j in range(1, k):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n + j])
    return out


# -- fixed-size prefilter --------------------------------------------------------------------


class Prefilter:
    """A bitmap of fixed size that holds every key it was built from, and some others.

    What passes is a superset, so an exact join has to follow. It saves shuffling rows that
    surely have no partner; its size doesn't depend on the number of keys.
    """

    def __init__(self, keys: DataFrame, column: str, bits: int = FILTER_BITS):
        spark = keys.sparkSession
        bit = F.pmod(F.col(column), F.lit(bits))
        filled = (
            keys.select(F.shiftright(bit, 6).alias("at"), F.pmod(bit, F.lit(64)).cast("int").alias("b"))
            .groupBy("at")
            .agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("word"))
            .toArrow()
        )  # at most bits / 64 rows, which come as arrays: as rows the driver would hold a hundred bytes for each
        words = np.zeros(bits // 64, np.int64)
        words[filled["at"].to_numpy()] = filled["word"].to_numpy()
        self.bits = bits
        self.packed = spark.sparkContext.broadcast(words.view(np.uint8))

    def test(self, keys: np.ndarray) -> np.ndarray:
        """keys: int64. Which of them may have been among the filter's keys."""
        at = keys.view(np.uint64) & np.uint64(self.bits - 1)
        return (self.packed.value[(at >> np.uint64(3)).astype(np.intp)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def column(self, key):
        """The same test as a column."""
        def may_hold(values: pa.Array) -> pa.Array:
            return pa.array(self.test(values.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)))

        return arrow(may_hold, "boolean")(key)


# -- skew ------------------------------------------------------------------------------------


def _hot_keys(counts: DataFrame, keys: list[str], total: int | None) -> dict[int, int]:
    """The number of shares of each hot key, by the key's hash. At most PARTS keys come to the driver."""
    seen = counts.agg(F.sum("n").alias("total"), F.max("n").alias("most")).first()
    total = max(total or seen["total"] or 0, 1)
    if (seen["most"] or 0) * PARTS < total:
        return {}
    hot = counts.where(F.col("n") * PARTS >= total).select(F.xxhash64(*keys).alias("k"), F.ceil(F.col("n") * PARTS / F.lit(total)).alias("s"))
    return {r["k"]: r["s"] for r in hot.collect()}


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: str,
    how: str = "inner",
    counts: DataFrame | None = None,
    total: int | None = None,
) -> DataFrame:
    """left joined with right, which has a few rows a key; a hot key's rows on the left are dealt out
    by a hash of the column spread, and its rows on the right are repeated for each share.

    A key is hot if it has 1 / PARTS of the rows, so there are PARTS hot keys at most; both sides look
    the shares up by the hash of the key, in a constant. counts (keys, n) are the rows of left by
    key, total their sum or more; what is not given is counted, for which left should be stored.
    The keys have the same types on both sides.
    """
    if counts is None:
        counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = _hot_keys(counts, keys, total)
    shares = F.lit(1)
    if hot:
        table = F.map_from_arrays(F.array(*map(F.lit, hot)), F.array(*map(F.lit, hot.values())))
        shares = F.coalesce(F.try_element_at(table, F.xxhash64(*keys)), F.lit(1)).cast("int")
    known = functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    over = F.when(known, shares).otherwise(F.lit(PARTS))  # rows without a key match nothing and go anywhere
    salt = F.explode(F.sequence(F.lit(0), shares - 1)) if hot else F.lit(0)
    dealt = left.withColumn("salt", F.pmod(F.xxhash64(spread), over).cast("int"))
    return dealt.join(right.withColumn("salt", salt), [*keys, "salt"], how).drop("salt")


# -- components ------------------------------------------------------------------------------


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ids in edges (u, v); component is the smallest id reachable.

    Large-star and small-star steps in turn, until a round changes nothing. A step moves about as
    many rows as there are edges, its result is stored, and a hub's rows are dealt out.
    """
    edges = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before, now = None, _state(edges)
    while now[0] and now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = salted_join(both, least.drop("n"), ["u"], "v", counts=least.drop("m"), total=now[0])
        large = large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large")  # every edge points from the larger id to the smaller
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = salted_join(large, least.drop("n"), ["u"], "v", counts=least.drop("m"), total=now[0])
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        before, now = now, _state(edges)
    nodes = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("id"), "component").distinct())
