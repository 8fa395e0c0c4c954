"""Personal data: four base kinds by pattern and check, and more, with secrets, by bootstrapped contexts.

Base. A kind's matches are leftmost and don't overlap; a match whose check fails is dropped. Spark has no
function for the positions of all matches, so a text is split by the pattern too, and the lengths of
pieces and matches add up to offsets in code points. The patterns are written so that a text of
any length takes linear time and no recursion.

Bootstrapping. Mentions are base spans and other tokens with an @ or several digits, but for those that are
an address, phone or number of 12 to 19 digits whose check fails. A mention's patterns are the two words before it, the words
around it, and its own shape with the word before it or behind it; a shape has a for a run of letters, 0 for each
digit, and x for a run of both. Seeds are the base spans and, of the further kind secret, quoted
lower-case hex digests. Secrets count neither as base spans nor in the counts. Patterns and
instances (the mentioned strings) form a graph. A round scores each pattern by the share of its
instances that are believed to be of a kind, those of unknown kind counting UNKNOWN, and each instance by the
patterns that hold it: the chance that at least one of them is right. Patterns need SUPPORT believed instances and a share of PRECISION,
instances a score of BELIEF, to count in the next round. Rounds end when one adds and takes nothing. Mentions of believed instances and
of seeds that overlap no base span are the spans that the method adds.

All of it are DataFrame functions. Edges are distinct pairs; a pattern or string that a third of the
mentions have is aggregated before the shuffle, and its edges are dealt out in joins. What is known of a
document's spans is stored once in the shared scratch folder, without the text; so is each round.

A null text counts as empty. Repeated rows each get their spans; further columns are ignored; an
empty table gives no rows. Spans that start together are in the order email, ip, card, phone, secret.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import salted_join, stored

KINDS = ("email", "ip", "card", "phone")
NAMES = (*KINDS, "secret")
SECRET = NAMES.index("secret")
#: A run that a match could start in is tried at its start only, or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Tokens that are seeds of the kind secret.
DIGEST = r"""^["'`](?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})["'`][.,;]?$"""
EDGE, INNER = "[^A-Za-z0-9@+]", "[A-Za-z0-9@+]"
#: Matches whose offsets are summed up one by one.
BLOCK = 256
#: Characters on either side of a mention that its patterns are taken from.
CONTEXT = 80
DIGITS = 5
SUPPORT, PRECISION, BELIEF = 3, 0.6, 0.8
#: What an instance of unknown kind counts against a pattern; one of another kind counts 1.
UNKNOWN = 0.5


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    turned = F.split(F.reverse(digits), "")
    doubled = F.transform(turned, lambda c, i: (lambda v: F.when(v > 9, v - 9).otherwise(v))(c.cast("int") * (i % 2 + 1)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, s: Column) -> Column:
    """Whether a match is of the kind."""
    if kind == "ip":
        parts = F.transform(F.split(s, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    if kind == "card":
        n = F.length(_digits(s))
        return F.when((n >= 12) & (n <= 19), _luhn(_digits(s))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def _found(rows: DataFrame, name: str, pattern: str, condition: Column) -> DataFrame:
    """rows with the column name: (start, stop, surface, left, right) of the pattern's matches in texts
    that meet the condition; left and right are what stands next to a match.

    Offsets are summed up within blocks of matches and over blocks, so that the work on a text
    with very many matches doesn't grow with their square.
    """
    none = F.expr("cast(array() AS array<string>)")
    rows = rows.withColumns({
        "pieces": F.when(condition, F.split("text", pattern, -1)).otherwise(none),
        "matches": F.when(condition, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none),
    })
    n = F.size("matches")
    before = F.concat(F.array(F.lit("")), F.col("matches"))  # the match in front of each piece
    leads = F.zip_with(before, "pieces", lambda m, p: F.right(F.concat(F.right(m, F.lit(CONTEXT)), F.right(p, F.lit(CONTEXT))), F.lit(CONTEXT)))
    follows = F.zip_with("pieces", F.concat(F.col("matches"), F.array(F.lit(""))), lambda p, m: F.left(F.concat(F.left(p, F.lit(CONTEXT)), F.left(m, F.lit(CONTEXT))), F.lit(CONTEXT)))
    sides = F.zip_with(F.slice(leads, 1, n), F.slice(follows, 2, n), lambda x, y: F.struct(x.alias("left"), y.alias("right")))
    own = F.zip_with(F.slice("pieces", 1, n), "matches", lambda p, m: F.struct(F.length(p).alias("a"), F.length(m).alias("b"), m.alias("surface")))
    item = F.zip_with(own, sides, lambda x, y: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["surface"].alias("surface"), y["left"].alias("left"), y["right"].alias("right")))
    rows = rows.withColumn("items", F.when(n > 0, item)).drop("pieces", "matches")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("items") - 1) / BLOCK)), lambda k: F.slice("items", (k * BLOCK + 1).cast("int"), F.lit(BLOCK)))
    rows = rows.withColumn("blocks", F.when(F.size("items") > 0, blocks)).drop("items")
    sums = F.transform("blocks", lambda c: F.aggregate(c, F.lit(0), lambda x, i: x + i["a"] + i["b"]))
    start = F.expr("struct(0 AS at, cast(array() AS array<int>) AS out)")
    rows = rows.withColumn("offsets", F.aggregate(sums, start, lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"]))
    empty = F.expr("cast(array() AS array<struct<start: int, stop: int, surface: string, left: string, right: string>>)")

    def step(s, i):
        first = s["at"] + i["a"]
        span = F.struct(first.alias("start"), (first + i["b"]).alias("stop"), i["surface"].alias("surface"), i["left"].alias("left"), i["right"].alias("right"))
        return F.struct((first + i["b"]).alias("at"), F.concat(s["out"], F.array(span)).alias("out"))

    placed = F.zip_with("blocks", "offsets", lambda c, at: F.aggregate(c, F.struct(at.alias("at"), empty.alias("out")), step, lambda s: s["out"]))
    return rows.withColumn(name, F.coalesce(F.flatten(placed), empty)).drop("blocks", "offsets")


def _words(left: Column, right: Column) -> Column:
    """(left2, left1, right1): the words next to a span, in lower case, digits as 0."""
    plain = lambda s: F.split(F.trim(F.regexp_replace(F.translate(F.lower(s), "123456789", "000000000"), r"\s+", " ")), " ")
    turned = F.reverse(plain(left))
    return F.struct(F.coalesce(F.get(turned, 1), F.lit("")).alias("left2"), F.get(turned, 0).alias("left1"), F.get(plain(right), 0).alias("right1"))


def located(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, base, tokens): the base spans (start, kind, stop, surface, words) in order, kind being
    the index in NAMES, and the tokens (start, stop, kind, surface, words) that may be identifiers, of kind
    secret or null."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"), text.alias("text"), text.rlike("[0-9]").alias("numbers"))
    asks = {"email": F.col("text").contains("@"), "phone": F.col("numbers") & F.col("text").contains("+")}
    for kind in KINDS:
        rows = _found(rows, kind, PATTERNS[kind], asks.get(kind, F.col("numbers")))
    rows = _found(rows, "tokens", TOKEN, asks["email"] | F.col("numbers")).drop("text", "numbers")

    def base(kind):
        kept = F.filter(kind, lambda s: _holds(kind, s["surface"]))
        return F.transform(kept, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["stop"].alias("stop"), s["surface"].alias("surface"),
            _words(s["left"], s["right"]).alias("words"),
        ))

    def trimmed(s):
        lead = F.length(s["surface"]) - F.length(F.regexp_replace(s["surface"], f"^{EDGE}+", ""))
        core = F.regexp_replace(s["surface"], f"^{EDGE}+|(?<={INNER}){EDGE}+$", "")
        start = s["start"] + lead
        kind = F.when(s["surface"].rlike(DIGEST), F.lit(SECRET))
        return F.struct(
            start.alias("start"), (start + F.length(core)).alias("stop"), kind.alias("kind"), core.alias("surface"),
            _words(s["left"], s["right"]).alias("words"),
        )

    def shaped(s):
        whole = {k: s["surface"].rlike(f"^(?:{PATTERNS[k]})$") & ~_holds(k, s["surface"]) for k in ("ip", "card", "phone")}
        whole["card"] &= F.length(_digits(s["surface"])).between(12, 19)  # other numbers are no cards, but may be something else
        refused = functools.reduce(Column.__or__, whole.values())
        return (s["surface"].contains("@") & (F.length(s["surface"]) > 2) | (F.length(_digits(s["surface"])) >= DIGITS)) & ~refused

    return rows.select(
        "doc_id", "digest", F.array_sort(F.concat(*(base(k) for k in KINDS))).alias("base"),
        F.filter(F.transform("tokens", trimmed), shaped).alias("tokens"),
    )


def mentions(spans: DataFrame) -> DataFrame:
    """(doc_id, digest, start, stop, kind, instance, words): base spans, and the tokens, of kind secret or
    null, that overlap none of them."""
    plain = lambda s, kind: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), kind.alias("kind"), F.lower(s["surface"]).alias("instance"), s["words"].alias("words"))
    every = F.concat(F.transform("base", lambda s: plain(s, s["kind"])), F.transform("tokens", lambda s: plain(s, s["kind"])))
    rows = spans.select("doc_id", "digest", F.explode(every).alias("m")).select("doc_id", "digest", "m.*")
    is_base = F.coalesce(F.col("kind") < SECRET, F.lit(False))
    text = Window.partitionBy("doc_id", "digest").orderBy("start", ~is_base, "stop")
    reached = F.max(F.when(is_base, F.col("stop"))).over(text.rowsBetween(Window.unboundedPreceding, -1))
    # the next base span is the first from here backwards
    back = Window.partitionBy("doc_id", "digest").orderBy(F.desc("start"), is_base, F.desc("stop"))
    ahead = F.min(F.when(is_base, F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"reached": F.coalesce(reached, F.lit(0)), "ahead": F.coalesce(ahead, F.lit(2**31 - 1))})
    return rows.where(is_base | (F.col("reached") <= F.col("start")) & (F.col("ahead") >= F.col("stop"))).drop("reached", "ahead")


# -- bootstrapping ---------------------------------------------------------------------------


def _shape(instance: Column) -> Column:
    """a for a run of letters, 0 for each digit, x for a run of both."""
    both = F.regexp_replace(instance, r"(?<![\p{L}0-9])(?:\p{L}++[0-9]|[0-9]++\p{L})[\p{L}0-9]*+", "X")
    return F.translate(F.regexp_replace(both, r"[\p{L}&&[^X]]++", "a"), "X123456789", "x000000000")


def edges(mentions: DataFrame) -> DataFrame:
    """(pattern, instance, kind): the graph; kind is that of a seed, or null."""
    shape = F.concat(F.lit("shape "), _shape(F.col("instance")))
    patterns = F.array(
        F.concat(F.lit("before "), "words.left2", F.lit(" "), "words.left1"),
        F.concat(F.lit("around "), "words.left1", F.lit(" "), "words.right1"),
        F.concat(shape, F.lit(" after "), "words.left1"),
        F.concat(shape, F.lit(" before "), "words.right1"),
    )
    return mentions.select(F.explode(patterns).alias("pattern"), "instance", "kind").distinct()


def scored_patterns(graph: DataFrame, believed: DataFrame, support: int = SUPPORT, precision: float = PRECISION) -> DataFrame:
    """(pattern, kind, share) of the patterns to trust. graph (pattern, instance), believed (instance, kind)."""
    sizes = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    hits = salted_join(graph, believed, ["instance"], "pattern").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("hits"))
    hits = stored(hits, "hits")
    known = hits.groupBy("pattern").agg(F.sum("hits").alias("known"))
    trusted = hits.where(F.col("hits") >= support).join(known, "pattern").join(sizes, "pattern")
    weight = F.col("known") + UNKNOWN * (F.col("n") - F.col("known"))
    return trusted.select("pattern", "kind", (F.col("hits") / weight).alias("share")).where(F.col("share") >= precision)


def scored_instances(graph: DataFrame, patterns: DataFrame, belief: float = BELIEF) -> DataFrame:
    """(instance, kind) of the instances to believe: the likeliest kind, of equals the first."""
    wrong = F.exp(F.sum(F.log(F.greatest(1 - F.col("share"), F.lit(1e-9)))))
    odds = salted_join(graph, patterns, ["pattern"], "instance").groupBy("instance", "kind").agg((1 - wrong).alias("score"))
    best = odds.where(F.round("score", 9) >= belief).groupBy("instance").agg(F.max(F.struct(F.round("score", 9), -F.col("kind"))).alias("b"))
    return best.select("instance", (-F.col("b.col2")).cast("int").alias("kind"))


def seeded(graph: DataFrame) -> DataFrame:
    """(instance, kind) of the seeds in a graph."""
    return graph.where("kind IS NOT NULL").groupBy("instance").agg(F.min("kind").alias("kind"))


def discovered(graph: DataFrame) -> DataFrame:
    """(instance, kind) that patterns of high confidence add to the seeds, after as many rounds as it takes
    until one leaves them as they were. Instances whose kind goes to and fro could repeat several
    states in turn; then the first that comes again is taken."""
    seeds = stored(seeded(graph), "seeds")
    graph = stored(graph.select("pattern", "instance").distinct(), "graph")
    added, now, before = None, (0, None), set()
    while now not in before:
        before.add(now)
        believed = seeds if added is None else seeds.unionByName(added)
        patterns = stored(scored_patterns(graph, believed), "patterns")
        found = scored_instances(graph, patterns)
        added = stored(found.join(seeds, "instance", "left_anti"), "added")
        now = tuple(added.agg(F.count(F.lit(1)), F.sum(F.xxhash64("instance", "kind").cast("decimal(38,0)"))).first())
    return added


def _joined(spans: Column) -> Column:
    """kind:start:stop of spans (start, kind, stop), joined by commas."""
    name = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row for each document: base counts, the digest of the base spans, and all spans."""
    spans = stored(located(docs), "spans")
    seen = stored(mentions(spans), "mentions")
    graph = stored(edges(seen), "edges")
    others = seen.where(F.coalesce("kind", F.lit(SECRET)) == SECRET)
    others = stored(others.select("doc_id", "digest", "start", "stop", "instance").distinct(), "others")
    believed = discovered(graph).unionByName(seeded(graph).where(F.col("kind") == SECRET))
    new = salted_join(others, believed, ["instance"], "digest")
    new = new.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("new"))
    new = new.select(F.col("doc_id").alias("id"), F.col("digest").alias("of"), "new")
    rows = spans.select("doc_id", "digest", F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))).alias("base"))
    both = rows.join(new, rows["doc_id"].eqNullSafe(new["id"]) & (rows["digest"] == new["of"]), "left")
    of_kind = lambda k: F.filter("base", lambda s: s["kind"] == k)
    counts = (F.size(of_kind(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS))
    every = F.array_sort(F.concat("base", F.coalesce("new", F.expr("cast(array() AS array<struct<start: int, kind: int, stop: int>>)"))))
    return both.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"))
