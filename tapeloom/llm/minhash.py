"""Near-duplicate documents by circulant MinHash, exact verification and connected components.

Sets. A document's set holds the 64-bit hashes of its distinct 5-word shingles.

Signatures. One permutation scatters the shingles over 2^SLOT_BITS slots; a second one, pi, is
kept as a table, and coordinate k of the signature is the smallest pi[(slot + k) mod slots].
So all coordinates of a shingle are one contiguous slice of the table, and a signature is the
minimum over such slices. ROWS coordinates make a band; two documents of similarity 0.75
share none of the 32 bands with a probability of about 5e-6.

Candidates. Documents with equal sets are one text from here on. In a bucket (texts with the same
band) the pairs are not listed. A round gives every bucket a pivot out of its largest component
and verifies the pivot against the texts of other components; PIVOT_ROUNDS of them, each with
other pivots, the second with the text that has least of its own, leave few texts apart that
belong together. Texts that share a bucket with another component then are joined by their rarest
shingles, which finds every similar pair of them, whatever their buckets; pairs within a component
aren't made. So the result is that of all pairs of all buckets, and no bucket is enumerated.

Verification counts the intersection of the full sets. Only texts that share a bucket are read
again for it. Components are found by star contraction over verified links.

Skew. A bucket with a third of all texts is reduced by a map-side aggregate to its pivot, and the
pivot goes to the texts by a salted join. A pivot's set is repeated for each share of its pairs.
Intermediate tables are stored in the shared scratch folder, so a lost executor costs one step.

A document without text or words has an empty set, is linked with nothing and is kept. Repeated rows
of one doc_id count as one document and give one row, with the set of the largest size; rows
without an id stand alone as one document of id null. Further columns don't matter.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tapeloom.llm.common import (
    NO_ID,
    Prefilter,
    arrow,
    components,
    gram_hashes,
    lower_words,
    mixed,
    salted_join,
    stored,
    word_hashes,
)

SLOT_BITS = 20
BANDS, ROWS = 32, 4
PIVOT_ROUNDS = 3
#: Shingles whose slices of the table are held at a time.
CHUNK = 8192


@functools.cache
def _slices() -> np.ndarray:
    """Row s holds pi[s], pi[s + 1], ... of one signature; a view of one table."""
    n = 1 << SLOT_BITS
    pi = np.random.default_rng(0x5EED).permutation(n).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.r_[pi, pi[: BANDS * ROWS - 1]], BANDS * ROWS)


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """The sorted hashes of the distinct k-word shingles; of fewer words, of all of them as one."""
    words = word_hashes(lower_words(text))
    return np.unique(gram_hashes(words, min(k, len(words)))) if len(words) else np.empty(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    slots = (mixed(shingles ^ np.uint64(0xC1C)) >> np.uint64(64 - SLOT_BITS)).astype(np.intp)
    least = None
    for i in range(0, len(slots), CHUNK):
        part = _slices()[slots[i : i + CHUNK]].min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def band_hashes(shingles: np.ndarray) -> np.ndarray:
    bands = signature(shingles).reshape(BANDS, ROWS).astype(np.uint64)
    out = mixed(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))
    for j in range(ROWS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + bands[:, j])
    return out.view(np.int64)


def signatures(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, n, s1, s2, bands): the size and digest of each document's set and its bands' hashes."""
    kind = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands = [], [], []
            for x in batch.column(1):
                s = shingle_set(x.as_py(), k)
                sizes.append(len(s))
                digests.append(xxh3_128_digest(s.tobytes()))
                bands.append(band_hashes(s) if len(s) else None)
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(bands, pa.list_(pa.int64()))],
                schema=kind,
            )

    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text").mapInArrow(
        signed, "doc_id long, n long, s1 long, s2 long, bands array<long>"
    )


def shingle_sets(docs: DataFrame, wanted: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, shingles) of the documents in wanted (doc_id, s1, s2); read again from their texts.

    Most texts that are not wanted are passed over before the shuffle, by a filter of fixed size.
    """
    kind = pa.schema([("doc_id", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("shingles", pa.binary())])
    maybe = Prefilter(wanted, "doc_id")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(maybe.test(batch.column(0).to_numpy())))
            sets = [shingle_set(x.as_py(), k).tobytes() for x in batch.column(1)]
            both = np.frombuffer(b"".join(map(xxh3_128_digest, sets)), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(sets, pa.binary())], schema=kind)

    found = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text").mapInArrow(
        listed, "doc_id long, s1 long, s2 long, shingles binary"
    )
    own = wanted.select("doc_id", F.col("s1").alias("t1"), F.col("s2").alias("t2"))
    return found.join(own, "doc_id").where("s1 = t1 AND s2 = t2").dropDuplicates(["doc_id"]).select("doc_id", "shingles")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), a stored table, with 100 * intersection >= percent * union of their sets."""

    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right, strict=True):
            both = np.sort(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)]))
            shared = int((both[1:] == both[:-1]).sum())
            out.append(100 * shared >= percent * (len(both) - shared))
        return pa.array(out, pa.bool_())

    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    with_b = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b")), "b")
    of_a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    both = salted_join(with_b, of_a, ["a"], "b", counts=counts)
    return both.where(arrow(similar, "boolean")("of_a", "of_b")).select("a", "b")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (doc_id, comp) after links (a, b) between documents. labels has each document once."""
    at = lambda c: labels.select(F.col("doc_id").alias(c), F.col("comp").alias(c + "_comp"))
    between = links.join(at("a"), "a").join(at("b"), "b").select(F.col("a_comp").alias("u"), F.col("b_comp").alias("v"))
    merged = components(between).select(F.col("id").alias("comp"), F.col("component").alias("to"))
    joined = salted_join(labels, merged, ["comp"], "doc_id", "left")
    return stored(joined.select("doc_id", F.coalesce("to", "comp").alias("comp")), "labels")


def _tokens(ids: DataFrame, sets: DataFrame) -> DataFrame:
    """(doc_id, h): the shingles of the documents in ids, one a row."""
    kind = pa.schema([("doc_id", pa.int64()), ("h", pa.int64())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            ids = np.repeat(batch.column(0).to_numpy(), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate([np.empty(0, np.int64), *own]))], schema=kind)

    return sets.join(ids, "doc_id", "left_semi").select("doc_id", "shingles").mapInArrow(listed, "doc_id long, h long")


def _shared_shingles(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of open_ (band, doc_id, n) with e, the number of the text's shingles that some other text of
    open_ has too: no intersection is larger. Texts with too few of them have no partner and go."""
    open_ = stored(open_, "open")
    holders = _tokens(open_.select("doc_id").distinct(), sets).groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("k"))
    alone = holders.where("k = 1").groupBy("doc_id").agg(F.count(F.lit(1)).alias("q"))
    rows = open_.join(alone, "doc_id", "left").withColumn("e", F.col("n") - F.coalesce("q", F.lit(0))).drop("q")
    return stored(rows.where(100 * F.col("e") >= percent * F.col("n")), "possible")


def _prefix_pairs(texts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of texts (doc_id, n, comp) of different components that can be similar.

    Shingles are ordered by how many of the texts have them, the rarest first. Similar texts share
    one of their first n - ceil(n * percent / 100) + 1, and what follows the first shared one must
    suffice for the rest of the intersection. That is exact and needs no bucket.
    """
    tokens = stored(_tokens(texts.select("doc_id"), sets), "tokens")
    held = stored(tokens.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "held")
    ranked = salted_join(tokens, held.withColumnRenamed("n", "k"), ["h"], "doc_id", counts=held)
    ranked = ranked.withColumn("i", F.row_number().over(Window.partitionBy("doc_id").orderBy("k", "h")))
    ranked = ranked.join(texts, "doc_id").where("k > 1").where(F.col("i") <= F.floor(F.col("n") * (100 - percent) / 100) + 1)
    left = stored(ranked.select("h", "doc_id", "n", "comp", "i"), "prefixes")
    right = left.select("h", *(F.col(c).alias(c + "_") for c in ("doc_id", "n", "comp", "i")))
    rest = 1 + F.least(F.col("n") - F.col("i"), F.col("n_") - F.col("i_"))
    fits = (100 + percent) * rest >= percent * (F.col("n") + F.col("n_"))
    pairs = left.join(right, "h").where("doc_id < doc_id_ AND comp <> comp_").where(fits)
    return pairs.select(F.col("doc_id").alias("a"), F.col("doc_id_").alias("b"))


def _open_buckets(now: DataFrame, order: Column) -> DataFrame:
    """(band, n, at, pivot, pivot_n, pivot_e) of the buckets with several components: the number of texts,
    the largest component and the text of it that is largest by order."""
    top = F.max(F.struct(order.alias("w"), "doc_id", "n", "e")).alias("top")
    groups = now.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("n"), top)
    buckets = groups.groupBy("band").agg(
        F.max(F.struct("n", "top.w", "comp", "top")).alias("p"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n")
    ).where("parts > 1")
    pivot = (F.col("p.comp").alias("at"), *(F.col(f"p.top.{c}").alias(d) for c, d in (("doc_id", "pivot"), ("n", "pivot_n"), ("e", "pivot_e"))))
    return stored(buckets.select("band", "n", *pivot), "buckets")


def linked(members: DataFrame, sets: DataFrame, percent: int, rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """(doc_id, comp) of members (band, doc_id, n, weight): the components of all verified pairs
    that share a bucket."""
    labels = stored(members.select("doc_id").distinct().select("doc_id", F.col("doc_id").alias("comp")), "labels")
    enough = lambda e, f, n, m: (100 + percent) * F.least(e, f) >= percent * (n + m)  # noqa: E731  of what both can share
    members, checked = members.withColumn("e", F.col("n")), None
    for i in range(rounds + 1):
        if i == 1:
            now = members.join(labels, "doc_id")
            open_ = salted_join(now, (b := _open_buckets(now, F.col("weight"))).select("band"), ["band"], "doc_id", counts=b.select("band", "n"))
            members = _shared_shingles(open_.select("band", "doc_id", "n"), sets, percent)
        now = members.join(labels, "doc_id")
        if i < rounds:
            # first a text that meets many others, then one with little of its own, then any
            order = (F.col("weight") if not i else F.floor(F.col("e") * 1_000_000 / F.col("n")) if i == 1 else F.xxhash64("doc_id", "band", F.lit(i)))
            buckets = _open_buckets(now, order)
            open_ = salted_join(now, buckets.drop("n"), ["band"], "doc_id", counts=buckets.select("band", "n"))
            fits = enough(F.col("e"), F.col("pivot_e"), F.col("n"), F.col("pivot_n"))
            pairs = open_.where(F.col("comp") != F.col("at")).where(fits).select(F.col("pivot").alias("a"), F.col("doc_id").alias("b"))
        else:
            pairs = _prefix_pairs(stored(now.select("doc_id", "n", "comp").distinct(), "open"), sets, percent)
        pairs = pairs.distinct()
        if checked is not None:
            turned = checked.select(F.col("b").alias("a"), F.col("a").alias("b"))
            pairs = pairs.join(checked.unionByName(turned), ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        checked = pairs if checked is None else checked.unionByName(pairs)
        links = stored(verified(pairs, sets, percent), "links")
        labels = _relabelled(labels, links)
    return labels


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest doc_id reachable over links."""
    signed = stored(signatures(docs, k), "signatures")
    per_doc = signed.groupBy("doc_id").agg(F.max(F.struct("n", "s1", "s2")).alias("s")).select("doc_id", "s.*")
    per_doc = stored(per_doc, "documents")
    classes = per_doc.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = stored(classes, "classes")
    texts = signed.join(classes.select(F.col("rep").alias("doc_id"), F.col("s1").alias("t1"), F.col("s2").alias("t2")), "doc_id")
    texts = texts.where("s1 = t1 AND s2 = t2").dropDuplicates(["doc_id"])
    buckets = stored(texts.select("doc_id", "n", "s1", "s2", F.explode("bands").alias("band")), "buckets")
    sizes = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = stored(sizes, "sizes")
    # few bands are in several texts; most of the others needn't be shuffled
    buckets = stored(buckets.where(Prefilter(sizes, "band").column(F.col("band"))), "shared-buckets")
    members = salted_join(buckets, sizes.select("band", F.col("n").alias("size")), ["band"], "doc_id", counts=sizes)
    # a text that meets many others is likely their middle: the first pivot
    members = stored(members.withColumn("weight", F.sum("size").over(Window.partitionBy("doc_id"))), "members")
    sets = stored(shingle_sets(docs, members.select("doc_id", "s1", "s2").distinct(), k), "sets")
    labels = linked(members.select("band", "doc_id", "n", "weight"), sets, percent)
    reps = salted_join(per_doc, classes.select("s1", "s2", "rep"), ["s1", "s2"], "doc_id", "left", counts=classes.select("s1", "s2", "n"))
    reps = stored(reps.select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "reps")
    found = salted_join(reps, labels.select(F.col("doc_id").alias("rep"), "comp"), ["rep"], "doc_id", "left")
    real = lambda c: F.when(c != NO_ID, c)
    return found.select(
        real(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), real(F.coalesce("comp", "rep")).alias("component_id")
    )


def minhash_components(docs: DataFrame) -> DataFrame:
    """One row for each document: the size of its set, its component, and whether it stays."""
    return near_duplicates(docs).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that are the smallest doc_id of their component, with all their columns."""
    kept = minhash_components(docs).where("kept").select("doc_id")
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
