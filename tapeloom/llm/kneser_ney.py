"""Language-model scores: an interpolated modified Kneser-Ney n-gram model.

Counting. A first pass over the training texts counts words, a second one n-grams of word numbers. Each task
adds up what it has read before anything is shuffled and sends it on as compressed arrays, one row for each
shard that it has something for. Words are sharded by the range of their hash, n-grams by the hash of
their context, so a context's numbers meet in one shard. A shard's task writes sorted arrays of 64-bit
hashes with their counts into the shared folder, and sends the distinct n-grams without their first word to the
next lower order, whose counts are thus continuation counts (n-grams at the start of a text keep their own
counts, as nothing can precede them). The number of shards follows the size of the training texts, so a shard
holds about SHARD_TOKENS tokens at any size.

Scoring. Workers map the arrays into memory and look up the n-grams of some MB of text at a time in the order of
their hashes; nothing is shuffled. The shared folder must be mounted as a file path on all machines.

Probabilities. With the discounts D1, D2, D3+ of each order from its counts of counts (0.5, 1 and 1.5 if one of
them is zero or a discount falls out of range), p(w | h) = max(c(hw) - D, 0) / c(h) + (D1 n1(h) + D2 n2(h) + D3 n3(h)) / c(h)
p(w | shorter h), and below one word 1 / (V + 1): V training tokens, and all unknown words as one more.

Hot words and contexts: a word or n-gram with any share of the corpus is one entry for each task that met it. A
context has as many entries as there are distinct words after it, which is bounded by the vocabulary. The driver gets
one row of numbers for each shard. Files are written whole under another name and then renamed, and their content does
not depend on the order in which rows arrive, so a task that runs again changes nothing; a lost executor costs tasks only.

Null text counts as empty, and an empty text is one end token. Documents without an id belong to the training part.
Repeated rows count as often as they occur. Without training tokens all scores are 0. Texts of any length are read whole;
further columns are left out.
"""

from __future__ import annotations

import functools
import itertools
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tapeloom.llm.common import mixed, stored
from tapeloom.session import scratch_dir

#: Words of an n-gram.
ORDER = 2
#: Training tokens for each shard of the model.
SHARD_TOKENS = 4_000_000
#: Characters of text that are counted or scored at a time.
PART_CHARS = 8_000_000
#: Entries that a task gathers before it sends them on.
GATHERED = 6_000_000
#: The end of a text, as a word; no word holds a space.
END = b" "
ROWS = "shard int, size long, blob binary"


def local_path(folder: str) -> str:
    """The path that workers open."""
    scheme, colon, path = folder.partition(":")
    if not colon:
        return folder
    if scheme != "file":
        raise ValueError(f"workers map the model into memory, so spark.checkpoint.dir has to be a mounted folder, not {folder}")
    return "/" + path.lstrip("/")


# -- arrays ----------------------------------------------------------------------------------


def _packed(arrays: list[np.ndarray]) -> bytes:
    raw = b"".join(np.ascontiguousarray(a, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays)  # bytes of equal weight together
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, size: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob, size * 8 * columns, codec="zstd", asbytes=True), np.uint8).reshape(columns, 8, size)
    return [np.ascontiguousarray(c.T).view(np.int64).reshape(-1) for c in raw]


def summed(columns: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns (none below 0) in ascending order, and the sums of their weights."""
    code, top = columns[0], int(columns[0].max(initial=0)) + 1
    for c in columns[1:]:
        width = int(c.max(initial=0)) + 1
        if top * width >= 2**62:
            known, code = np.unique(code, return_inverse=True)
            top = len(known)
        if top * width >= 2**62:  # too many of both: order by all columns
            break
        code, top = code * width + c, top * width
    else:
        order = np.argsort(code)
        code = code[order]
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
        first = order[starts]
        return [c[first] for c in columns], np.add.reduceat(weights[order], starts) if len(starts) else weights[:0]
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    starts = np.flatnonzero(np.r_[True, functools.reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])])
    return [c[starts] for c in columns], np.add.reduceat(weights[order], starts)


def hashed(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row."""
    out = mixed(columns[0].astype(np.uint64) + np.uint64(len(columns)))
    for c in columns[1:]:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64))
    return out


def _save(path: str, array: np.ndarray) -> None:
    whole = f"{path}.{uuid.uuid4().hex}"
    with open(whole, "wb") as f:
        np.save(f, array)
    os.replace(whole, path)


@functools.lru_cache(maxsize=1024)
def _mapped(path: str) -> np.ndarray | None:
    return np.load(path, mmap_mode="r") if os.path.exists(path) else None


def _save_counts(path: str, counts: np.ndarray) -> None:
    """Counts as bytes; those that do not fit go to a list of places."""
    big = np.flatnonzero(counts > 254)
    _save(f"{path}.npy", np.where(counts > 254, 255, counts).astype(np.uint8))
    _save(f"{path}-big.npy", np.stack([big, counts[big]]))


def _counts_at(path: str, at: np.ndarray) -> np.ndarray:
    out = _mapped(f"{path}.npy")[at].astype(np.int64)
    big = _mapped(f"{path}-big.npy")
    over = np.flatnonzero(out == 255)
    if len(over):
        out[over] = big[1][np.searchsorted(big[0], at[over])]
    return out


def _found(keys: np.ndarray | None, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of wanted are among the sorted keys, and where."""
    if keys is None or not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(wanted)
    at = np.searchsorted(keys, wanted[order])
    hit = keys[np.minimum(at, len(keys) - 1)] == wanted[order]
    return order[hit], at[hit]


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard.astype(np.uint16) if shard.max(initial=0) < 2**16 else shard, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0][: len(order)])
    for a, b in zip(starts, [*starts[1:], len(order)], strict=True):
        yield int(shard[order[a]]), order[a:b]


# -- words -----------------------------------------------------------------------------------


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes (63 bits) of the words of some texts, the number among them of each token, an end after each text, and
    the tokens of each text."""
    words = [[*t.encode().lower().split(), END] if t else [END] for t in texts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    hashes = np.fromiter(map(xxh64_intdigest, itertools.chain.from_iterable(words)), np.uint64, int(lengths.sum()))
    codes, distinct = pd.factorize((hashes >> np.uint64(1)).view(np.int64))
    return distinct, codes, lengths


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str | None]]]:
    """Rows of batches (text last), some MB at a time, as columns before the text and texts."""
    for batch in batches:
        others, texts = batch.columns[:-1], batch.columns[-1].to_pylist()
        start = size = 0
        sizes = [len(x) if x else 0 for x in texts]
        for i, n in enumerate([*sizes, None]):
            if n is None or size > PART_CHARS:
                if i > start:
                    yield [c.slice(start, i - start) for c in others], texts[start:i]
                start, size = i, 0
            size += n or 0


def _word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of hashes, so that a word's number is its place among all."""
    return (hashes >> 31) * shards >> 32


def _context_shard(columns: list[np.ndarray], shards: int) -> np.ndarray:
    return _word_shard((hashed(columns) >> np.uint64(1)).view(np.int64), shards)


def _sent(shard: np.ndarray, columns: list[np.ndarray], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = [(s, len(at), _packed([*(c[at] for c in columns), weights[at]])) for s, at in _by_shard(shard)]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary()), strict=True)], ["shard", "size", "blob"])


def _gathered(steps: Iterator[tuple[list[np.ndarray], np.ndarray]], shard_of) -> Iterator[pa.RecordBatch]:
    """Adds up rows of columns with weights, and sends them on whenever there are GATHERED of them."""
    held: list[tuple[list[np.ndarray], np.ndarray]] = []
    for step in itertools.chain(steps, [None]):
        if step is not None:
            held.append(summed(*step))
        if held and (step is None or sum(len(w) for _, w in held) > GATHERED):
            columns = [np.concatenate(c) for c in zip(*(c for c, _ in held), strict=True)]
            columns, weights = summed(columns, np.concatenate([w for _, w in held]))
            if step is not None and 2 * len(weights) < GATHERED:
                held = [(columns, weights)]
                continue
            yield from _sent(shard_of(columns), columns, weights)
            held = []


def _merged(table: pa.Table, columns: int) -> tuple[list[np.ndarray], np.ndarray]:
    parts = [_unpacked(b.as_py(), n.as_py(), columns + 1) for b, n in zip(table["blob"], table["size"], strict=True)]
    *ids, weights = (np.concatenate(c) for c in zip(*parts, strict=True))
    return summed(list(ids), weights)


class Model:
    """The numbers of a model; its arrays lie in the folder path."""

    def __init__(self, path: str, shards: int, order: int):
        self.path, self.shards, self.order = path, shards, order
        self.offsets = np.zeros(shards + 1, np.int64)
        self.tokens = 0
        self.total = 0  # of continuation counts of single words
        self.discounts: dict[int, np.ndarray] = {}  # by order: none, D1, D2, D3+
        self.classes = np.zeros(4, np.int64)  # words by continuation count 1, 2, 3 or more

    @property
    def vocabulary(self) -> int:
        return int(self.offsets[-1])

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, V for unknown ones, and its count in the training texts."""
        ids, counts = np.full(len(hashes), self.vocabulary, np.int64), np.zeros(len(hashes), np.int64)
        for s, at in _by_shard(_word_shard(hashes, self.shards)):
            hit, where = _found(_mapped(f"{self.path}/words-{s}.npy"), hashes[at])
            if len(hit):
                ids[at[hit]] = self.offsets[s] + where
                counts[at[hit]] = _counts_at(f"{self.path}/counts-{s}", where)
        return ids, counts

    def grams(self, ids: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
        """The words of the n-gram that ends at each token, the first in the first array; V + 1 before the text."""
        place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return [np.where(place >= back, np.r_[np.zeros(back, np.int64), ids[: len(ids) - back]], self.vocabulary + 1) if back else ids for back in range(order - 1, -1, -1)]

    def _discount(self, counts: np.ndarray, order: int) -> np.ndarray:
        return self.discounts[order][np.minimum(counts, 3)]

    def probabilities(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """p of each token after those before it in its text."""
        columns = self.grams(ids, lengths, self.order)
        p = np.full(len(ids), 1 / (self.vocabulary + 1))
        if self.total:
            p *= (self.discounts[1][1:] * self.classes[1:]).sum() / self.total
            known = np.flatnonzero(ids < self.vocabulary)
            shard = np.searchsorted(self.offsets, ids[known], side="right") - 1
            for s, at in _by_shard(shard):
                c = _counts_at(f"{self.path}/grams1-{s}", ids[known[at]] - self.offsets[s])
                p[known[at]] += np.maximum(c - self._discount(c, 1), 0) / self.total
        for k in range(2, self.order + 1):
            own = columns[-k:]
            for s, at in _by_shard(_context_shard(own[:-1], self.shards)):
                contexts = _mapped(f"{self.path}/contexts{k}-{s}.npy")
                hit, where = _found(contexts, hashed([c[at] for c in own[:-1]]))
                if not len(hit):
                    continue
                at, stats = at[hit], _mapped(f"{self.path}/stats{k}-{s}.npy")[where].astype(np.float64)
                total = stats[:, 0]
                p[at] *= stats[:, 1:] @ self.discounts[k][1:] / total
                hit, where = _found(_mapped(f"{self.path}/grams{k}-{s}-keys.npy"), hashed([c[at] for c in own]))
                c = _counts_at(f"{self.path}/grams{k}-{s}", where) if len(hit) else where
                p[at[hit]] += np.maximum(c - self._discount(c, k), 0) / total[hit]
        return p

    def scores(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        """n_tokens, n_known, base_score and score of each text."""
        distinct, codes, lengths = _tokens(texts)
        ids, counts = self.numbers(distinct)
        ids, counts = ids[codes], counts[codes]
        starts = np.cumsum(lengths) - lengths
        base = np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1)))
        return {
            "n_tokens": lengths,
            "n_known": np.add.reduceat((counts > 0).astype(np.int64), starts),
            "base_score": np.add.reduceat(base, starts),
            "score": np.add.reduceat(np.log10(self.probabilities(ids, lengths)), starts),
        }


def discounts(n: list[int]) -> np.ndarray:
    """none, D1, D2, D3+ from the numbers of n-grams that count 1, 2, 3 and 4."""
    if all(n):
        y = n[0] / (n[0] + 2 * n[1])
        found = [0.0, *(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))]
        if all(0 <= d <= k for k, d in enumerate(found)):
            return np.array(found)
    return np.array([0.0, 0.5, 1.0, 1.5])


# -- training --------------------------------------------------------------------------------

#: What a shard's task returns: one row of numbers without a blob, and rows for the next lower order.
RESULT = "shard int, size long, blob binary, total long, n1 long, n2 long, n3 long, n4 long, more long"
_KINDS = [pa.int32(), pa.int64(), pa.binary(), *[pa.int64()] * 6]
_NAMES = [c.split(" ")[0] for c in RESULT.split(", ")]


def _result(shard: int, size: int, counts: np.ndarray, sent: Iterator[pa.RecordBatch] = ()) -> pa.Table:
    own = [shard, size, None, int(counts.sum()), *(int((counts == k).sum()) for k in (1, 2, 3, 4)), int((counts > 2).sum())]
    tables = [pa.Table.from_arrays([pa.array([x], t) for x, t in zip(own, _KINDS, strict=True)], _NAMES)]
    for batch in sent:
        empty = [pa.nulls(batch.num_rows, t) for t in _KINDS[3:]]
        tables.append(pa.Table.from_arrays([*batch.columns, *empty], _NAMES))
    return pa.concat_tables(tables)


def _write_words(model: Model, texts: DataFrame) -> None:
    """Words and their counts, sorted by hash; the number of the first word of each shard."""
    path, shards = model.path, model.shards

    def count(batches):
        def steps():
            for _, part in _parts(batches):
                distinct, codes, _ = _tokens(part)
                yield [distinct], np.bincount(codes, minlength=len(distinct)).astype(np.int64)

        yield from _gathered(steps(), lambda columns: _word_shard(columns[0], shards))

    def write(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        (keys,), counts = _merged(table, 1)
        _save(f"{path}/words-{shard}.npy", keys)
        _save_counts(f"{path}/counts-{shard}", counts)
        return _result(shard, len(keys), counts)

    sizes = np.zeros(shards + 1, np.int64)
    for r in stored(texts.mapInArrow(count, ROWS).groupBy("shard").applyInArrow(write, RESULT), "words").collect():
        sizes[r["shard"] + 1] = r["size"]
        model.tokens += r["total"]
    model.offsets = np.cumsum(sizes)


def _counted(model: Model, texts: DataFrame) -> DataFrame:
    """The n-grams of the model's order with their counts, as blobs by shard."""

    def count(batches):
        def steps():
            for _, part in _parts(batches):
                distinct, codes, lengths = _tokens(part)
                ids = model.numbers(distinct)[0][codes]
                yield model.grams(ids, lengths, model.order), np.ones(len(ids), np.int64)

        yield from _gathered(steps(), lambda columns: _context_shard(columns[:-1], model.shards))

    return texts.mapInArrow(count, ROWS)


def _write_grams(model: Model, sent: DataFrame, order: int) -> DataFrame:
    """Writes the n-grams of an order and what is known of their contexts. Returns what they
    add to the next lower order."""
    path, shards, offsets, start = model.path, model.shards, model.offsets, model.vocabulary + 1

    def write(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        columns, counts = _merged(table, order)
        keys = hashed(columns)
        by_key = np.argsort(keys)
        _save(f"{path}/grams{order}-{shard}-keys.npy", keys[by_key])
        _save_counts(f"{path}/grams{order}-{shard}", counts[by_key])
        context = columns[:-1]
        new = functools.reduce(np.logical_or, [c[1:] != c[:-1] for c in context])
        starts = np.flatnonzero(np.r_[True, new])
        stats = np.stack([np.add.reduceat(x.astype(np.int64), starts) for x in (counts, counts == 1, counts == 2, counts > 2)], axis=1)
        keys = hashed([c[starts] for c in context])
        by_key = np.argsort(keys)
        _save(f"{path}/contexts{order}-{shard}.npy", keys[by_key])
        _save(f"{path}/stats{order}-{shard}.npy", stats[by_key].astype(np.min_scalar_type(int(stats.max()))))
        rest = columns[1:]
        if order > 2:
            rest, weights = summed(rest, np.where(rest[0] == start, counts, 1))
            to = _context_shard(rest[:-1], shards)
        else:
            rest, weights = summed(rest, np.ones_like(counts))
            to = np.searchsorted(offsets, rest[0], side="right") - 1
        return _result(shard, len(counts), counts, _sent(to, rest, weights))

    return stored(sent.groupBy("shard").applyInArrow(write, RESULT), f"grams{order}")


def _write_unigrams(model: Model, sent: DataFrame) -> DataFrame:
    path, offsets = model.path, model.offsets

    def write(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        (ids,), weights = _merged(table, 1)
        counts = np.zeros(offsets[shard + 1] - offsets[shard], np.int64)
        counts[ids - offsets[shard]] = weights
        _save_counts(f"{path}/grams1-{shard}", counts)
        return _result(shard, len(counts), counts)

    return stored(sent.groupBy("shard").applyInArrow(write, RESULT), "grams1")


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """A model of the column text of texts, of order 2 or more."""
    spark = texts.sparkSession
    texts = texts.select("text")
    size = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    shards = 1 + ((size[0] or 0) // 6 + size[1]) // SHARD_TOKENS  # about six bytes a token
    model = Model(local_path(scratch_dir(spark, "kneser-ney")), shards, order)
    os.makedirs(model.path)
    _write_words(model, texts)
    sent = _counted(model, texts)
    for k in range(order, 0, -1):
        written = _write_grams(model, sent, k) if k > 1 else _write_unigrams(model, sent)
        numbers = written.where("blob IS NULL").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "n1", "n2", "n3", "n4", "more"))).first()
        model.discounts[k] = discounts([numbers["n1"], numbers["n2"], numbers["n3"], numbers["n4"]])
        sent = written.where("blob IS NOT NULL").select("shard", "size", "blob")
    model.total = numbers["total"]
    model.classes = np.array([0, numbers["n1"], numbers["n2"], numbers["more"]])
    return model


# -- scoring ---------------------------------------------------------------------------------

SCORES = (("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()))


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns keep of docs, and of each text n_tokens, n_known (tokens that the training texts have),
    base_score and score (log10 probabilities under single words and under the model) and perplexity."""

    def score(batches):
        for others, texts in _parts(batches):
            found = model.scores(texts)
            yield pa.RecordBatch.from_arrays([*others, *(pa.array(found[c], t) for c, t in SCORES)], [*keep, *(c for c, _ in SCORES)])

    rows = docs.select(*keep, F.col("text").alias("_text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    out = rows.mapInArrow(score, ", ".join([*kinds, "n_tokens long, n_known long, base_score double, score double"]))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by their ids; those without an id are not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def document_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """All documents scored by a model of those that are not held out."""
    docs = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    model = train(docs.where(~F.col("held_out")), order)
    rows = scored(docs, model, ["doc_id", "held_out"])
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity"
    )
