"""Registered queries over whole tables, against their DuckDB twins or a brute-force version."""

import hashlib
import os
import re
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapeloom.llm import decontaminate, line_dedup, minhash, pii, quality_rules, substring
from tapeloom.llm.common import gram_hashes, lower_words, table, word_hashes
from tapeloom.llm.queries import oracle_sql, queries, tokenizer_path
from tests.compare import connect, differences

DIRECTORY = os.environ.get("CORPUS_SF_DIR", "/root/testdata/sf0.001")


def rows(table):
    return pq.read_table(f"{DIRECTORY}/{table}.parquet").to_pylist()


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_twin(spark, con, name):
    assert differences(queries()[name](spark, DIRECTORY), con, oracle_sql()[name]) == []


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def reference_tokens(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    out = {}
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        out[doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(back))
    return out


def test_bpe_agrees_with_the_tokenizers_library(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries()["op10_bpe"](spark, DIRECTORY).collect()}
    assert got == reference_tokens((r["doc_id"], r["text"]) for r in rows("documents"))


def brute_leaks(docs, items):
    """(doc_id, item_id) by repeatedly taking the longest common run of free tokens."""
    k, out = decontaminate.MIN_MATCH, set()
    token = lambda t: re.findall(r"\w+", (t or "").lower())
    texts = {r["doc_id"]: token(r["text"]) for r in docs}
    grams = {d: {tuple(t[i : i + k]) for i in range(len(t) - k + 1)} for d, t in texts.items()}
    for item in items:
        x = token(item["text"])
        own = {tuple(x[i : i + k]) for i in range(len(x) - k + 1)}
        for d, t in texts.items():
            if own & grams[d] and 100 * sum(n for _, _, n in brute_tiles(x, t, k)) >= decontaminate.THRESHOLD * len(x):
                out.add((d, item["item_id"]))
    return out


def brute_tiles(item, doc, least):
    free_i, free_d, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for q in range(len(doc)):
                n = 0
                while p + n < len(item) and q + n < len(doc) and free_i[p + n] and free_d[q + n] and item[p + n] == doc[q + n]:
                    n += 1
                best = max(best, (n, -p, -q))
        n, p, q = best[0], -best[1], -best[2]
        if n < least:
            return out
        out.append((p, q, n))
        free_i[p : p + n] = free_d[q : q + n] = [False] * n


def test_leaks_agree_with_brute_force(spark):
    got = {(r["doc_id"], r["item_id"]) for r in queries()["op1_decontaminate"](spark, DIRECTORY).collect()}
    assert got == brute_leaks(rows("documents"), rows("benchmark")) and got


# the contract's own patterns, as Python reads them
BASE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                True, kind != 1 or all(int(x) <= 255 for x in m[0].split(".")),
                12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15,
            )[kind]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def check_spans(got, text):
    base = base_spans(text)
    joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
    assert got["base_sha256"] == sha(joined)
    assert [got[f"n_{k}"] for k in pii.KINDS] == [sum(x == i for _, x, _ in base) for i in range(4)]
    assert set(filter(None, joined.split(","))) <= set(filter(None, got["spans"].split(",")))


def test_personal_data_agrees_with_python(spark):
    texts = {r["doc_id"]: r["text"] for r in rows("documents")}
    for r in queries()["op7_pii"](spark, DIRECTORY).collect():
        check_spans(r, texts.pop(r["doc_id"]))
    assert not texts


def hidden_seeds(spark, directory):
    """(hidden, right, wrong) of a third of the seeds, taken for unknown, by the kind that contexts give back."""
    seen = pii.mentions(pii.located(table(spark, directory, "documents"))).cache()
    hide = F.crc32("instance") % 3 == 0
    part = pii.edges(seen.withColumn("kind", F.when(~hide, F.col("kind"))))
    truth = pii.seeded(pii.edges(seen)).where(hide)
    back = truth.join(pii.discovered(part).withColumnRenamed("kind", "found"), "instance", "left")
    counts = back.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(F.col("found") == F.col("kind")).alias("r"), F.count_if(F.col("found") != F.col("kind")).alias("w")).collect()
    seen.unpersist()
    return {pii.NAMES[x["kind"]]: (x["n"], x["r"], x["w"]) for x in counts}


def test_hidden_seeds_come_back(spark):
    """Secrets have a context of their own and all come back; words around the other kinds are random."""
    got = hidden_seeds(spark, "/root/testdata/sf0.1")
    print("hidden seeds", got)
    n, right, wrong = got["secret"]
    assert n >= 20 and right >= 0.95 * n and wrong == 0, got
    assert sum(w for _, _, w in got.values()) <= 0.05 * sum(r for _, r, _ in got.values()), got


def test_every_document_that_shares_a_passage_is_found(spark):
    """A window of MIN_WORDS equal words in two documents lies in a passage of each."""
    holders, covered = defaultdict(set), defaultdict(list)
    for r in rows("documents"):
        for i, g in enumerate(gram_hashes(word_hashes(lower_words(r["text"])), substring.MIN_WORDS).tolist()):
            holders[g].add((r["doc_id"], i))
    for r in queries()["op4_substring_dedup"](spark, DIRECTORY).collect():
        covered[r["doc_id"]].append((r["start"], r["stop"]))
        covered[r["partner_id"]].append((r["partner_start"], r["partner_stop"]))
        assert min(r["stop"] - r["start"], r["partner_stop"] - r["partner_start"]) >= substring.MIN_WORDS
    shared = [p for g in holders.values() if len({d for d, _ in g}) > 1 for p in g]
    lost = [(d, i) for d, i in shared if not any(s <= i and i + substring.MIN_WORDS <= e for s, e in covered[d])]
    assert shared and not lost
    assert {d for d, _ in shared} == {d for d, _ in shared if covered[d]}


def brute_components(texts, percent=75):
    sets = {d: set(minhash.shingle_set(t).tolist()) for d, t in texts.items()}
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {d: root(d) for d in ids}


def brute_pipeline(docs, items):
    """Ids and texts that the first four stages keep, in plain Python."""
    rules = quality_rules.RULES
    texts = {}
    for r in docs:
        t = quality_rules.Text(r["text"])
        n = len(t.words)
        if n >= 50 and 100 * t.repeated_words() <= 50 * n and not any(x.rejects(t) for x in rules):
            texts[r["doc_id"]] = r["text"]
    first = {}
    for d in sorted(texts):
        for line in texts[d].split("\n"):
            first.setdefault(line_dedup.line_key(line.encode()), d)
    for d, text in texts.items():
        stays = lambda x, d=d: len(x.decode()) < 10 or first[x] == d
        texts[d] = "\n".join(x for x in text.split("\n") if stays(line_dedup.line_key(x.encode())))
    groups = brute_components(texts)
    texts = {d: t for d, t in texts.items() if groups[d] == d}
    leaked = {d for d, _ in brute_leaks([{"doc_id": d, "text": t} for d, t in texts.items()], items)}
    return {d: t for d, t in texts.items() if d not in leaked}


def test_pipeline_agrees_with_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in corpus_pipeline.run(spark, DIRECTORY).collect()}
    assert got == reference_tokens(brute_pipeline(rows("documents"), rows("benchmark")).items())


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), DIRECTORY).columns == docs.columns
