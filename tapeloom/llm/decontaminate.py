"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters, digits and underscores, lower-cased; of scripts written without spaces, each
character is one. Every window of MIN_MATCH tokens of an item is a seed, and an item of fewer tokens
is one seed as a whole. Documents are read once: windows that may be seeds, by a bitmap of fixed size,
are kept together with the tokens they cover, and joined with the seeds. A (document, item) pair
that shares a seed is tiled: a common run of MIN_MATCH tokens or more consists of shared seeds, so
the tokens kept of the document are enough and its text is not needed again.

Tiling runs Karp-Rabin with search lengths from long to short: windows of the current length of the
item's untiled tokens are hashed, the document's untiled windows are looked up, matches are compared
token by token, extended to both sides, and marked longest first, so tiles never overlap. Passages
of an item are found in whatever order the document has them. An item is leaked if tiles
cover THRESHOLD percent of its tokens. An item of fewer than MIN_MATCH tokens is leaked by documents that
have all of them in a row.

Pairs are dealt out by document and item, so neither an item that a third of the documents hold nor a
document with many items ends up in one task; an item's tokens go to its pairs by a salted join.
The work on a pair is bounded by the lengths of the two texts. Seeds and pairs are stored in the
shared scratch folder, so a lost executor costs the tasks it ran.

Null or empty texts and items share nothing. Repeated rows of a doc_id or item_id, if their texts are
equal, count once; texts that differ under one id are each compared, and the best coverage counts.
Rows with a null id are compared like others and come out with a null id. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tapeloom.llm.common import Prefilter, arrow, gram_hashes, salted_join, stored

#: Thai to Lao, Burmese, Khmer, kana, Chinese characters.
SPACELESS = "\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF"
TOKEN = re.compile(r"\w+").findall
TOKEN_OR_CHARACTER = re.compile(rf"(?=\w)[{SPACELESS}]|[^\W{SPACELESS}]+").findall
HAS_SPACELESS = re.compile(f"[{SPACELESS}]").search
MIN_MATCH = 6
#: Percent of an item's tokens that have to be in tiles.
THRESHOLD = 50
#: Length of the first search; longer matches are found by it and sought first.
FIRST_SEARCH = 32
#: Bits of the bitmap that holds the seeds.
SEED_BITS = 1 << 25
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def token_hashes(text: str | None) -> np.ndarray:
    text = text.lower() if text else ""
    tokens = TOKEN(text) if text.isascii() or not HAS_SPACELESS(text) else TOKEN_OR_CHARACTER(text)
    return np.fromiter((xxh64_intdigest(t) for t in tokens), np.uint64, len(tokens))


# -- tiling ----------------------------------------------------------------------------------


def _rolled(tokens: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(position, hash) of the windows whose tokens are all free; the hash rolls along a run."""
    drop = pow(BASE, size, MASK + 1)
    run = value = 0
    for i, t in enumerate(tokens):
        if not free[i]:
            run = value = 0
            continue
        run += 1
        value = (value * BASE + t) & MASK
        if run > size:
            value = (value - tokens[i - size] * drop) & MASK
        if run >= size:
            yield i - size + 1, value


def _matches(item: list[int], doc: list[int], free_item: list[bool], free_doc: list[bool], size: int):
    """(length, item position, document position) of the runs of size or more free tokens that agree
    and can't be extended to the right."""
    places = defaultdict(list)
    for p, h in _rolled(item, free_item, size):
        places[h].append(p)
    found, reached = [], {}  # of a diagonal, the end of its last match
    for q, h in _rolled(doc, free_doc, size):
        for p in places.get(h, ()):
            if q + size <= reached.get(q - p, 0) or item[p : p + size] != doc[q : q + size]:
                continue
            n = size
            while p + n < len(item) and q + n < len(doc) and free_item[p + n] and free_doc[q + n] and item[p + n] == doc[q + n]:
                n += 1
            reached[q - p] = q + n
            found.append((n, p, q))
    return found


def tiles(item: list[int], doc: list[int], free_doc: list[bool], least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """(item position, document position, length) of the tiles, none of which overlap in the item or the
    document; free_doc is False where no tile may lie, and is changed. Of equally long matches,
    the first in the item and then in the document is marked."""
    free_item, out = [True] * len(item), []
    size = max(least, min(FIRST_SEARCH, len(item)))
    while True:
        found = _matches(item, doc, free_item, free_doc, size)
        if found and max(found)[0] > 2 * size:  # much longer than sought: those first
            size = max(found)[0]
            continue
        heap = [(-n, p, q) for n, p, q in found]
        heapq.heapify(heap)
        while heap:
            n, p, q = heapq.heappop(heap)
            run = 0
            open_ = [free_item[p + i] and free_doc[q + i] for i in range(-n)]
            if all(open_):
                out.append((p, q, -n))
                free_item[p : p - n] = free_doc[q : q - n] = [False] * -n
                continue
            for i, x in enumerate([*open_, False]):  # what longer tiles left of it
                if x:
                    run += 1
                elif run:
                    if run >= size:
                        heapq.heappush(heap, (-run, p + i - run, q + i - run))
                    run = 0
        if size == least:
            return out
        size = max(least, size // 2)


# -- the join --------------------------------------------------------------------------------


def _keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, digest, text): the digest tells apart rows that share an id."""
    return df.select(F.col(key).alias("id"), F.xxhash64(text).alias("digest"), F.coalesce(text, F.lit("")).alias("text"))


def item_tokens(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_digest, tokens) of the items, each once."""
    kind = pa.list_(pa.int64())

    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([token_hashes(x.as_py()).view(np.int64) for x in texts], kind)

    items = _keyed(benchmark, "item_id", "text").dropDuplicates(["id", "digest"])
    tokens = arrow(hashed, "array<long>")("text")
    return items.select(F.col("id").alias("item_id"), F.col("digest").alias("item_digest"), tokens.alias("tokens"))


def item_seeds(items: DataFrame, k: int = MIN_MATCH) -> DataFrame:
    """(seed, item_id, item_digest, n, places): the windows of each item, or all of a shorter one, and how
    often it has them."""
    kind = pa.list_(pa.int64())

    def seeds(tokens: pa.Array) -> pa.Array:
        every = (np.asarray(x.values).view(np.uint64) for x in tokens)
        return pa.array([gram_hashes(x, min(k, len(x)) or k).view(np.int64) for x in every], kind)

    rows = items.select("item_id", "item_digest", F.size("tokens").alias("n"), F.explode(arrow(seeds, "array<long>")("tokens")).alias("seed"))
    return rows.groupBy("seed", "item_id", "item_digest", "n").agg(F.count(F.lit(1)).alias("places"))


def seeded(docs: DataFrame, seeds: DataFrame, sizes: list[int]) -> DataFrame:
    """(doc_id, digest, seeds, tokens) of the documents that may have a seed: their distinct seeds, and
    the tokens that these cover, with a 0 after each run of them. Seeds are of the given sizes."""
    maybe = Prefilter(seeds, "seed", SEED_BITS)
    lists = pa.list_(pa.int64())
    kind = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("seeds", lists), ("tokens", lists)])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, digest, text in zip(*batch.columns, strict=True):
                tokens = token_hashes(text.as_py())
                own, covered = [], np.zeros(len(tokens) + 1, np.int32)
                for k in sizes:
                    grams = gram_hashes(tokens, k).view(np.int64)
                    at = np.flatnonzero(maybe.test(grams))
                    own.append(grams[at])
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + k, -1)
                found = np.unique(np.concatenate(own))
                if not len(found):
                    continue
                steps = np.diff(np.r_[0, np.cumsum(covered) > 0].astype(np.int8))  # runs that touch or overlap are one
                runs = [np.r_[tokens[a:b], np.uint64(0)] for a, b in zip(np.flatnonzero(steps > 0), np.flatnonzero(steps < 0), strict=True)]
                rows.append((doc.as_py(), digest.as_py(), found, np.concatenate(runs).view(np.int64)))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    return _keyed(docs, "doc_id", "text").mapInArrow(kept, "doc_id long, digest long, seeds array<long>, tokens array<long>")


def tiled(item: Column, doc: Column) -> Column:
    """(n_covered, n_tiles) of an item's tokens and the tokens kept of a document."""
    kind = pa.struct([("n_covered", pa.int64()), ("n_tiles", pa.int64())])

    def tile(items: pa.Array, docs: pa.Array) -> pa.Array:
        rows = []
        for x, y in zip(items, docs, strict=True):
            tokens = y.as_py()
            item = x.as_py()
            found = tiles(item, tokens, [t != 0 for t in tokens], min(MIN_MATCH, len(item)))
            rows.append({"n_covered": sum(n for _, _, n in found), "n_tiles": len(found)})
        return pa.array(rows, kind)

    return arrow(tile, "n_covered long, n_tiles long")(item, doc)


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_tokens, n_covered, n_tiles) of the documents that hold an item."""
    items = stored(item_tokens(benchmark), "items")
    seeds = stored(item_seeds(items), "seeds")
    short = items.select(F.size("tokens").alias("n")).where(f"n BETWEEN 1 AND {MIN_MATCH - 1}").distinct()
    sizes = [*(r["n"] for r in short.collect()), MIN_MATCH]  # MIN_MATCH at most
    hits = stored(seeded(docs, seeds, sizes).dropDuplicates(["doc_id", "digest"]), "hits")
    rows = stored(hits.select("doc_id", "digest", F.explode("seeds").alias("seed")), "hit-seeds")
    shared = salted_join(rows, seeds, ["seed"], "digest")
    # tiles of MIN_MATCH tokens have one seed each, and short items one; with fewer places the threshold is out of reach
    enough = F.col("places") * (MIN_MATCH * 100) >= F.col("n") * threshold
    pair = ["doc_id", "digest", "item_id", "item_digest"]
    pairs = stored(shared.groupBy(*pair, "n").agg(F.sum("places").alias("places")).where(enough), "pairs")
    null_safe = lambda a, b, names: [a[c].eqNullSafe(b[c + "_"]) for c in names]
    own = hits.select(F.col("doc_id").alias("doc_id_"), F.col("digest").alias("digest_"), F.col("tokens").alias("kept"))
    with_doc = pairs.join(own, null_safe(pairs, own, ["doc_id", "digest"])).drop("doc_id_", "digest_")
    counts = pairs.groupBy("item_digest").agg(F.count(F.lit(1)).alias("n"))
    texts = items.select("item_digest", "tokens").dropDuplicates(["item_digest"])
    both = salted_join(with_doc, texts, ["item_digest"], "digest", counts=counts)
    done = both.select("doc_id", "item_id", F.col("n").cast("long").alias("n_tokens"), tiled(F.col("tokens"), F.col("kept")).alias("t"))
    done = done.select("doc_id", "item_id", "n_tokens", "t.*").where(F.col("n_covered") * 100 >= F.col("n_tokens") * threshold)
    best = F.max(F.struct((F.col("n_covered") / F.col("n_tokens")).alias("share"), "n_tokens", "n_covered", "n_tiles"))
    return done.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.n_tokens", "b.n_covered", "b.n_tiles")


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    leaked = leaks(docs, benchmark).select("doc_id").distinct()
    return docs.join(leaked, docs["doc_id"].eqNullSafe(leaked["doc_id"]), "left_anti")
