"""The manifest, language-model scores and spelling variants against brute force, with odd inputs."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapeloom.llm import kneser_ney, merkle, spelling
from tapeloom.llm.common import ship
from tapeloom.llm.queries import queries
from tests.llm.test_queries import DIRECTORY

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, as columns of the input.
CLASHES = ("tree", "hash", "pos", "chunk", "own", "before", "block", "node", "path", "word", "n", "held_out", "shard", "blob", "size", "counts")
LONG = " ".join(f"wort{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}x" for i in range(60_000))


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def documents():
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in pq.read_table(f"{DIRECTORY}/documents.parquet").to_pylist()]


ODD = [
    (1, "Some words, some Words\nand a line", "en", "a", 10), (2, None, None, "a", None), (3, "", "en", None, 0), (4, "a\nb\n", "de", None, 4),
    (5, LONG, "de", "b", len(LONG)), (5, LONG, "de", "b", len(LONG)), (5, "other", "de", "b", 5), (None, "words some", "en", "a", 1),
    (None, None, None, None, None), (6, "Größe große größe ÄÖ ×÷ straße\nstraße", "de", "ü", 9), (7, " \t\n", "en", "é", 3),
    *[(10 + i, f"falten falten falten falter walten {'x' * i}", "de", "a", i) for i in range(30)],
]


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in CLASHES if extra else ():
        df = df.withColumn(name, F.lit("x"))
    return df


def checksum(text):
    return crc32(text.encode())


# -- manifest --------------------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climbed(level):
    """The root of a list of nodes, and each node's siblings by level."""
    paths, width, start = [[] for _ in level], 1, len(level)
    while len(level) > 1:
        for i in range(start):
            at = i // width
            first = at // 3 * 3
            paths[i].append(("".join(level[first:at]), "".join(level[at + 1 : first + 3])))
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
        width *= 3
    return level[0], paths


def brute_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    trees = {}
    for source, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[source] = climbed([leaf(*r) for r in own])
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    if not order:
        return []
    root, above = climbed([trees[s][0] for s in order])
    out = []
    for source, upper in zip(order, above, strict=True):
        for r, lower in zip(by[source], trees[source][1], strict=True):
            text = r[1].replace("\n", "") if r[1] is not None and r[0] is not None and checksum(str(r[0])) % 2 == 0 else r[1]
            now = leaf(r[0], text, *r[2:])
            for left, right in lower + upper:
                now = h(left, now, right)
            proof = h(*(x for run in lower + upper for x in run))
            out.append((r[0], leaf(*r), trees[source][0], root, proof, now, now == root))
    return out


def manifest(df):
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.verified(df, F.when(chosen, F.translate("text", "\n", "")))


key = lambda rows: sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)  # blocks of 3, 9 and 729 leaves: many rounds, some, none
    rows = [(d, t, g, "one" if d % 2 else s, n) for d, t, g, s, n in documents()]
    assert key(manifest(frame(spark, rows)).collect()) == key(brute_manifest(rows))


def test_manifest_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    assert key(manifest(frame(spark, ODD, extra=True)).collect()) == key(brute_manifest(ODD))
    assert manifest(frame(spark, [])).collect() == []
    assert key(manifest(frame(spark, ODD[:1])).collect()) == key(brute_manifest(ODD[:1]))


def test_proofs_fold_to_the_root(spark):
    rows = merkle.manifest(frame(spark, ODD)).select("leaf", "root", "path", merkle.folded(F.col("leaf"), F.col("path")).alias("to")).collect()
    assert len(rows) == len(ODD) and all(r.to == r.root for r in rows)


# -- language model --------------------------------------------------------------------------


class Brute:
    """The model of the module's docstring, in dicts."""

    def __init__(self, texts, order):
        self.order = order
        docs = [self.tokens(t) for t in texts]
        self.counts = Counter(w for d in docs for w in d)
        self.n, self.v = sum(self.counts.values()), len(self.counts)
        grams = Counter(tuple(p[i : i + order]) for d in docs for p in [self.padded(d)] for i in range(len(d)))
        self.levels = {}
        for k in range(order, 0, -1):
            contexts = defaultdict(lambda: [0, 0, 0, 0])
            for g, c in grams.items():
                contexts[g[:-1]][0] += c
                contexts[g[:-1]][min(c, 3)] += 1
            self.levels[k] = grams, contexts, kneser_ney.discounts([sum(c == j for c in grams.values()) for j in (1, 2, 3, 4)])
            lower = Counter()
            for g, c in grams.items():
                lower[g[1:]] += c if k > 2 and g[1] == b"<" else 1
            grams = lower

    def tokens(self, text):
        return [*(text or "").encode().lower().split(), b" "]

    def padded(self, words):
        return [b"<"] * (self.order - 1) + words

    def p(self, context, word):
        k = len(context) + 1
        low = self.p(context[1:], word) if k > 1 else 1 / (self.v + 1)
        grams, contexts, discount = self.levels[k]
        if context not in contexts:
            return low
        total, *ones = contexts[context]
        c = grams.get((*context, word), 0)
        return max(c - discount[min(c, 3)], 0) / total + sum(d * n for d, n in zip(discount[1:], ones, strict=True)) / total * low

    def scores(self, text):
        words = self.tokens(text)
        p = self.padded(words)
        base = sum(math.log10((self.counts[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in words)
        score = sum(math.log10(self.p(tuple(p[i : i + self.order - 1]), w)) for i, w in enumerate(words))
        return len(words), sum(w in self.counts for w in words), base, score


def is_held_out(doc_id):
    return doc_id is not None and checksum(str(doc_id)) % 5 == 1


def check_scores(df, rows, order):
    model = Brute([r[1] for r in rows if not is_held_out(r[0])], order)
    got = sorted(kneser_ney.document_scores(df, order).drop("perplexity").collect(), key=repr)
    expected = sorted(
        ((r[0], is_held_out(r[0]), *(s := model.scores(r[1]))[:2], model.n, *s[2:]) for r in rows), key=lambda r: repr(r)
    )
    exact = lambda r: (r[0] is not None, r[0] or 0, *r[1:5])
    near = lambda r: (exact(r), round(r[5], 3), round(r[6], 3))
    got, expected = sorted(got, key=near), sorted(expected, key=near)
    assert [exact(r) for r in got] == [exact(r) for r in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[5] == pytest.approx(e[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(e[6], rel=1e-9, abs=1e-9)
    return model, got


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores(spark, monkeypatch, order):
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 20_000)  # several shards
    monkeypatch.setattr(kneser_ney, "PART_CHARS", 50_000)
    monkeypatch.setattr(kneser_ney, "GATHERED", 10_000)
    rows = documents()
    model, got = check_scores(frame(spark, rows), rows, order)
    for context in random.Random(1).sample(sorted(model.levels[order][1]), 5):  # probabilities sum to 1
        assert sum(model.p(context, w) for w in [*model.counts, b"unknown"]) == pytest.approx(1)
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_odd_rows(spark):
    rows = [r for r in ODD if r[1] is not LONG] + [(50, " ".join(LONG.split()[:3000]), "de", "b", 1)]
    check_scores(frame(spark, rows, extra=True), rows, 2)
    assert kneser_ney.document_scores(frame(spark, [])).collect() == []
    only = next(i for i in range(100) if is_held_out(i))
    (row,) = kneser_ney.document_scores(frame(spark, [(only, "no training at all", "en", "a", 1)])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (5, 0, 0, 0.0, 0.0)


def test_counts_beyond_a_byte_and_wide_rows(tmp_path):
    import numpy as np

    counts = np.array([1, 254, 255, 256, 70_000, 3], np.int64)
    kneser_ney._save_counts(f"{tmp_path}/c", counts)
    assert kneser_ney._counts_at(f"{tmp_path}/c", np.array([4, 0, 2, 2, 3])).tolist() == [70_000, 1, 255, 255, 256]
    r = random.Random(5)
    rows = [(r.randrange(3) << 40, r.randrange(3) << 41, r.randrange(4)) for _ in range(500)]
    columns, sums = kneser_ney.summed([np.array(c, np.int64) for c in zip(*rows, strict=True)], np.ones(500, np.int64))
    assert dict(zip(zip(*(c.tolist() for c in columns), strict=True), sums.tolist(), strict=True)) == Counter(rows)
    with pytest.raises(ValueError, match="mounted"):
        kneser_ney.local_path("hdfs://cluster/shared")


# -- spelling --------------------------------------------------------------------------------


def brute_variants(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            c = checksum(f"{'' if doc_id is None else doc_id}:{run}")
            counts[run[: c % len(run)] + run[c % len(run) + 1 :] if c % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            x = w[:i] + w[i + 1 :]
            holes[i, x].add(w)
            if x in words:
                near[w].add(x)
                near[x].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


@pytest.mark.parametrize("words,searches", [(20_000, 60_000), (30, 40), (1, 2)])
def test_variants(spark, monkeypatch, words, searches):
    monkeypatch.setattr(spelling, "NODE_WORDS", words)  # cut at once, further down, and at the leaves, which are split
    monkeypatch.setattr(spelling, "SEARCHES", searches)
    rows = documents() if words > 1 else documents()[:40]
    got = [tuple(r) for r in spelling.variants(frame(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_variants(rows)


def test_variants_of_odd_rows(spark):
    got = {tuple(r) for r in spelling.variants(frame(spark, ODD, extra=True)).collect()}
    assert got == brute_variants(ODD) and any(r[1] for r in got)
    assert spelling.variants(frame(spark, [])).collect() == []
    assert spelling.variants(frame(spark, [(1, "no word often", "en", "a", 1)])).collect() == []


def test_chains_of_forms_lead_to_the_last(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(20)] + [("a", "b")]
    got = dict(map(tuple, spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()))
    assert got == {f"w{i}": "w20" for i in range(20)} | {"a": "b"}


def test_one_edit():
    near = lambda a, b: b in {a[:i] + c + a[i + d :] for i in range(len(a) + 1) for d in (0, 1) for c in ("", *"abc")} and a != b
    r = random.Random(2)
    for _ in range(3000):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(1, 5))) for _ in range(2))
        assert spelling.one_edit(a, b) == near(a, b), (a, b)
    assert spelling.counts_of("façade")[0] == 6


def test_registered(spark):
    assert {"op11_merkle", "op12_lm_scores", "op13_spelling"} <= queries().keys()
