"""Spelling variants grouped under their most frequent form, by a trie of letter counts.

A word is arranged by successive counts: its length, then how many letters it has of each group of
LETTER_GROUPS. Words with the same counts are a leaf of a trie over these numbers. A word that differs by one inserted,
deleted or replaced character has at most one letter more in one group and one less in one group; so a
search goes down the trie depth-first with a budget of one surplus and one deficit, and only the words of
the leaves that it reaches are compared.

The trie is cut at its largest nodes of at most NODE_WORDS words. Down to the cut Spark takes one level a round, in
which every search is sent to the children that exist and are within its budget; below it each
part is searched in one task. Searches of a node beyond SEARCHES are dealt out to several parts, each with the
node's words; a leaf of more than NODE_WORDS words (all of the same counts) is split, and each search asks all its parts.
So a task holds at most NODE_WORDS words and SEARCHES searches, whatever the vocabulary.

A word has few near words (bounded by its length times the alphabet), and they come back as one row for each search of a
part: their number and the best of them. Nothing lists pairs, and only counts of nodes go to the driver. Runs are
counted by the task that read them before anything is shuffled, so a word with any share of the text is one
row for each task. Intermediate tables lie in the shared scratch folder; a lost executor costs one step.

Nulls, empty texts and texts without letters give no words; a null id counts as an empty one. Repeated rows count as often as they
occur. Equal counts are settled by code-point order. An empty table gives no rows; words of any length are
taken whole; further columns are left out.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import salted_join, stored

#: By character of Latin-1: letters a-z and U+00C0 to U+00FF stay, A-Z are lower-cased, the rest are spaces.
LETTERS = bytes(c if 97 <= c <= 122 or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: One run in so many has a letter deleted.
DAMAGED = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: Groups of one letter each, frequent ones first; all others are one more. Any other choice gives the same result.
LETTER_GROUPS = tuple("eainrstoludcmpgbhvf")
#: Levels of the trie: the length, the groups, the rest.
DEPTH = len(LETTER_GROUPS) + 2
NODE_WORDS = 20_000
SEARCHES = 60_000
#: Distinct runs that a task counts before it sends them on.
GATHERED = 1_000_000
_GROUP = {letter: i for i, group in enumerate(LETTER_GROUPS) for letter in group}


# -- words -----------------------------------------------------------------------------------


def runs(text: str | None) -> list[bytes]:
    """The lower-cased runs of a text as Latin-1, in which all their letters have one byte; others become spaces."""
    return text.encode("latin-1", "replace").translate(LETTERS).split() if text else []


def damaged(run: bytes, start: int) -> bytes:
    """The run, or what is left of it. start: the checksum of what comes before it."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    return run if h % DAMAGED else run[: h % len(run)] + run[h % len(run) + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sent() -> pa.RecordBatch:
        words = [(w.decode("latin-1"), n) for w, n in held.items() if n and len(w) >= LEAST_LENGTH]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in words], pa.string()), pa.array([n for _, n in words], pa.int64())], ["word", "n"])

    held: Counter[bytes] = Counter()
    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            start, found = crc32(b":" if doc_id is None else b"%d:" % doc_id), runs(text)
            held.update(found)
            for run in set(found):
                if (left := damaged(run, start)) is not run:
                    n = found.count(run)
                    held[run] -= n
                    held[left] += n
            if len(held) > GATHERED:
                yield sent()
                held.clear()
    yield sent()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least LEAST_LENGTH letters that occur at least LEAST_COUNT times."""
    counted = docs.select("doc_id", "text").mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letter_count(word: Column, level: int) -> Column:
    """A word's count at a level of the trie: its length, its letters of a group, or those of none."""
    length = F.char_length(word)
    if level == 0:
        return length
    if level == DEPTH - 1:
        return F.char_length(F.translate(word, "".join(LETTER_GROUPS), ""))
    return length - F.char_length(F.translate(word, LETTER_GROUPS[level - 1], ""))


def counts_of(word: str) -> tuple[int, ...]:
    """All counts of one word."""
    out = [len(word)] + [0] * (DEPTH - 1)
    for letter in word:
        out[_GROUP.get(letter, DEPTH - 2) + 1] += 1
    return tuple(out)


# -- the upper levels, one a round -----------------------------------------------------------


def _steps(depth: int) -> Column:
    """The children that a search may go to at the level depth, with what is left of its budget."""
    count, surplus, deficit = letter_count(F.col("word"), depth), F.col("surplus"), F.col("deficit")
    step = lambda c, s, d: F.struct(c.alias("count"), s.alias("surplus"), d.alias("deficit"))
    if depth == 0:  # a longer word has a surplus and no deficit
        zero, one = F.lit(0), F.lit(1)
        return F.array(step(count, one, one), step(count + 1, one, zero), step(count - 1, zero, one))
    return F.filter(
        F.array(step(count, surplus, deficit), step(count + 1, surplus - 1, deficit), step(count - 1, surplus, deficit - 1)),
        lambda x: (x["surplus"] >= 0) & (x["deficit"] >= 0) & (x["count"] >= 0),
    )


def _cut(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words of each node of the cut, and the searches that reach it: (node, depth, words of the node, ...)."""
    members = words.select("word", "n", F.lit("").alias("node"))
    searches = words.select("word", F.lit("").alias("node"), F.lit(1).alias("surplus"), F.lit(1).alias("deficit"))
    cut_members, cut_searches = [], []
    for depth in range(DEPTH):
        below = F.concat_ws(",", "node", letter_count(F.col("word"), depth))
        members = stored(members.withColumn("node", below), "trie-words")
        nodes = members.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
        nodes = stored(nodes.withColumn("depth", F.lit(depth + 1)), "trie-nodes")
        steps = searches.select("word", "node", F.inline(_steps(depth)))
        steps = stored(steps.select("word", F.concat_ws(",", "node", "count").alias("node"), "surplus", "deficit"), "trie-steps")
        searches = stored(salted_join(steps, nodes, ["node"], "word"), "trie-searches")
        members = stored(salted_join(members, nodes, ["node"], "word"), "trie-words")
        done = F.lit(True) if depth == DEPTH - 1 else F.col("size") <= NODE_WORDS
        cut_members.append(members.where(done))
        cut_searches.append(searches.where(done))
        if depth == DEPTH - 1 or not nodes.where(~done).head(1):
            break
        members, searches = (x.where(~done).drop("size", "depth") for x in (members, searches))
    return functools.reduce(DataFrame.unionByName, cut_members), functools.reduce(DataFrame.unionByName, cut_searches)


# -- below the cut ---------------------------------------------------------------------------


def one_edit(a: str, b: str) -> bool:
    """Whether one character inserted, deleted or replaced makes a to b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def trie_of(words: list[tuple[str, int]], depth: int) -> dict:
    """The trie of (word, n) below the level depth: dicts by count, then the list of a leaf."""
    root: dict = {}
    for word, n in words:
        *path, last = counts_of(word)[depth:] or (0,)
        node = root
        for count in path:
            node = node.setdefault(count, {})
        node.setdefault(last, []).append((word, n))
    return root


def leaves(root: dict, counts: tuple[int, ...], surplus: int, deficit: int) -> list[list[tuple[str, int]]]:
    """The leaves within a budget of letters more and letters less, depth first."""
    found, stack, last = [], [(root, 0, surplus, deficit)], len(counts)
    while stack:
        node, level, s, d = stack.pop()
        if level == last:
            found.append(node)
            continue
        count = counts[level]
        if (child := node.get(count)) is not None:
            stack.append((child, level + 1, s, d))
        if s and (child := node.get(count + 1)) is not None:
            stack.append((child, level + 1, 0, d))
        if d and (child := node.get(count - 1)) is not None:
            stack.append((child, level + 1, s, 0))
    return found


FOUND = "word string, n_near long, best_n long, best string"


def _search(searches: pa.Table, members: pa.Table) -> pa.Table:
    """The number of near words of each search in this part, and the best of them."""
    out: list[tuple[str, int, int, str]] = []
    if searches.num_rows and members.num_rows:
        depth = searches["depth"][0].as_py()
        root = trie_of(list(zip(members["word"].to_pylist(), members["n"].to_pylist(), strict=True)), depth)
        reached: dict[tuple, list[tuple[str, int]]] = {}
        for word, s, d in zip(*(searches[c].to_pylist() for c in ("word", "surplus", "deficit")), strict=True):
            counts = counts_of(word)[depth:] or (0,)
            if (key := (counts, s, d)) not in reached:
                reached[key] = [x for leaf in leaves(root, counts, s, d) for x in leaf]
            half = len(word) // 2  # one edit leaves one half as it is
            head, tail = word[:half], word[half:]
            near = [(-n, x) for x, n in reached[key] if (x.startswith(head) or x.endswith(tail)) and one_edit(word, x)]
            if near:
                n, best = min(near)
                out.append((word, len(near), -n, best))
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["word", "n_near", "best_n", "best"])


def nearest(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near words."""
    members, searches = _cut(words)
    splits = F.expr(f"(size - 1) div {NODE_WORDS} + 1")  # more than one for a large leaf
    shares = searches.groupBy("node").agg(F.count(F.lit(1)).alias("searches"))
    shares = stored(shares.select("node", F.expr(f"(searches - 1) div {SEARCHES} + 1").alias("shares")), "trie-shares")
    dealt = lambda df: salted_join(df, shares, ["node"], "word")
    each = lambda column: F.explode(F.sequence(F.lit(0).cast("long"), column - 1))
    searches = dealt(searches).select(
        "node", "depth", "word", "surplus", "deficit", F.pmod(F.xxhash64("word"), "shares").alias("share"), each(splits).alias("split")
    )
    members = dealt(members).withColumn("split", F.pmod(F.xxhash64("word"), splits))
    members = members.select("node", "word", "n", "split", each(F.col("shares")).alias("share"))
    key = ["node", "share", "split"]
    found = searches.groupBy(*key).cogroup(members.groupBy(*key)).applyInArrow(_search, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("best")))
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return best.select("word", "n_near", (-F.col("b.n")).alias("best_n"), "b.best")


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where the links (word, form) of words lead in the end. A form occurs at least twice as often as its word,
    so there are no circles, and the number of steps is that of the binary digits of a count; each round doubles them."""
    state = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(salted_join(state, ahead, ["root"], "word", "left"), "roots")
        state = further.select("word", F.coalesce("next", "root").alias("root"))
        if not further.where(F.col("next").isNotNull()).head(1):
            return state


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of the documents."""
    words = stored(vocabulary(docs), "words")
    near = words.join(stored(nearest(words), "near"), "word", "left")
    formed = F.col("best_n") >= 2 * F.col("n")
    rows = stored(
        near.select(
            "word", F.when(formed, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best_n")).alias("form_n")
        ),
        "forms",
    )
    ends = roots(rows.where("form IS NOT NULL").select("word", "form"))
    rows = rows.join(ends, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
