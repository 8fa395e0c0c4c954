"""Merkle manifest of a dataset, with the proof of every row, by a butterfly exchange.

Rows are leaves. The leaves of a tree (here: a source) ascend by an order; every FANOUT nodes in a row
have a parent, the last run of a level may have fewer. The roots of the trees are the leaves of one
more tree, whose root stands for the dataset.

A tree's leaves are dealt out to blocks of FANOUT ** HEIGHT, so a block is one whole subtree and is
hashed on its own. Blocks then exchange: in round r, those whose numbers differ only in digit r (base
FANOUT) form a group, each asks the others for the root of the subtree it has so far, and hashes
the parent for itself. So all blocks of a group hash the same ancestor, and after the last round
each has the tree's root and its own upper siblings; nothing is passed down again. A partner that would
lie beyond the last block is stood in for by another block of the same subtree. The top tree
goes the same way.

What a row's proof costs: its block is read once more and joined with the block's upper path, one row
for FANOUT ** HEIGHT leaves. A round moves FANOUT - 1 small rows for each block that still has partners.
Numbers within a tree come from chunks of a range partitioning by tree and order, so a tree with any share
of the rows is dealt out; partners that many blocks ask are salted. Nothing but the largest number of
blocks goes to the driver. Intermediate tables are in the shared scratch folder, so a lost executor costs one
step.

Nulls: a null value hashes as `-`; the tree of null keys comes first, null ids come first in their tree.
Equal ids are ordered by their hash, and equal rows are leaves each. An empty table gives no rows. Further
columns are left out, whatever their names; texts of any length are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import chunked, salted_join, stored

FANOUT = 3
#: Levels that a block hashes on its own: 729 leaves.
HEIGHT = 6
#: The columns of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(**values: Column) -> Column:
    """The hash of a row: each value as `-`, or as its length in bytes, `:` and itself."""
    parts = []
    for value in values.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(*parts)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda node, run: digest(run.left, node, run.right))


def proof_digest(path: Column) -> Column:
    """The hash of all siblings of a path, level by level, from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(run.left, run.right)), ""), 256)


def _blocks(leaves: DataFrame, order: list[str], label: str) -> DataFrame:
    """leaves (tree, hash, further columns) as blocks: tree, block, blocks of the tree, the block's rows
    in order, the nodes of each level below its root, and its root."""
    rows = chunked(leaves, "tree", order, f"{label}-chunks")
    counts = rows.groupBy("tree", "chunk").agg(F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    before = counts.select(
        "tree", "chunk", (F.sum("n").over(tree.orderBy("chunk")) - F.col("n")).alias("before"), F.sum("n").over(tree).alias("size")
    )
    own = F.row_number().over(Window.partitionBy("chunk", "tree").orderBy(*order)) - 1
    rows = rows.withColumn("own", own).join(before, ["chunk", "tree"]).withColumn("pos", F.col("before") + F.col("own"))
    payload = [c for c in leaves.columns if c != "tree"]
    width = FANOUT**HEIGHT
    blocks = (
        rows.withColumn("block", F.expr(f"pos div {width}"))
        .groupBy("tree", "block", "size")
        .agg(F.sort_array(F.collect_list(F.struct("pos", *payload))).alias("rows"))
        .withColumn("level0", F.transform("rows", lambda r: r.hash))
    )
    runs = lambda nodes: F.transform(
        F.sequence(F.lit(0), F.expr(f"(size({nodes}) - 1) div {FANOUT}")),
        lambda i: F.sha2(F.array_join(F.slice(F.col(nodes), i * FANOUT + 1, F.lit(FANOUT)), ""), 256),
    )
    for k in range(HEIGHT):  # a tree that is down to one node stays
        parents = F.when(F.col("size") > FANOUT**k, runs(f"level{k}")).otherwise(F.col(f"level{k}"))
        blocks = blocks.withColumn(f"level{k + 1}", parents)
    height = sum((F.col("size") > FANOUT**k).cast("int") for k in range(HEIGHT))
    return stored(
        blocks.select(
            "tree", "block", F.expr(f"(size - 1) div {width} + 1").alias("blocks"), "rows",
            F.slice(F.array(*(f"level{k}" for k in range(HEIGHT))), F.lit(1), height).alias("levels"),
            F.col(f"level{HEIGHT}")[0].alias("node"),
        ),
        f"{label}-blocks",
    )


def _round(state: DataFrame, width: int) -> DataFrame:
    """Blocks of a group of FANOUT swap the roots of their subtrees of width blocks and hash the parent."""
    asked = state.select("tree", F.col("block").alias("partner"), F.col("node").alias("other"))
    slot = F.expr(f"block div {width} % {FANOUT}")
    for t in range(1, FANOUT):
        first = F.expr(f"(block div {width * FANOUT} * {FANOUT} + (block div {width} + {t}) % {FANOUT}) * {width}")
        there = F.least(F.lit(width), F.col("blocks") - first)
        partner = F.when(there > 0, first + F.col("block") % width % there)
        state = salted_join(state.withColumn("partner", partner), asked, ["tree", "partner"], "block", "left")
        state = state.withColumnRenamed("other", f"other{t}").drop("partner")
    others = F.sort_array(F.array(*(F.struct(((slot + t) % FANOUT).alias("slot"), F.col(f"other{t}").alias("node")) for t in range(1, FANOUT))))
    side = lambda keep: F.array_join(F.transform(F.filter(others, keep), lambda x: x.node), "")
    return state.select(
        "tree", "block", "blocks", "path", "node",
        side(lambda x: x.slot < slot).alias("left"), side(lambda x: x.slot > slot).alias("right"),
    ).select(
        "tree", "block", "blocks", digest(F.col("left"), F.col("node"), F.col("right")).alias("node"),
        F.array_append("path", F.struct("left", "right")).alias("path"),
    )


def _exchanged(blocks: DataFrame, label: str) -> DataFrame:
    """(tree, block, node: the tree's root, path: the siblings above the block)."""
    state = blocks.select("tree", "block", "blocks", "node", F.array().cast(PATH).alias("path"))
    most, width = blocks.agg(F.max("blocks")).first()[0] or 0, 1
    over = state.where(F.col("blocks") <= width)
    while width < most:
        state = stored(_round(state.where(F.col("blocks") > width), width), f"{label}-round")
        width *= FANOUT
        over = over.unionByName(state.where(F.col("blocks") <= width))
    return over.drop("blocks")


def _spread(blocks: DataFrame, upper: DataFrame) -> DataFrame:
    """The rows of all blocks, each with its path. upper: tree, block, path and further columns."""
    further = [c for c in upper.columns if c not in ("tree", "block", "path")]
    widths = F.array(*(F.lit(FANOUT**k) for k in range(HEIGHT)))

    def siblings(i: Column) -> Column:
        def level(nodes: Column, k: Column) -> Column:
            at = F.floor(i / widths[k]).cast("int")
            slot = at % FANOUT
            return F.struct(
                F.array_join(F.slice(nodes, at - slot + 1, slot), "").alias("left"),
                F.array_join(F.slice(nodes, at + 2, F.lit(FANOUT - 1) - slot), "").alias("right"),
            )

        return F.transform("levels", level)

    rows = F.transform("rows", lambda r, i: F.struct(r.alias("r"), F.concat(siblings(i), F.col("path")).alias("path")))
    joined = blocks.select("tree", "block", "rows", "levels").join(upper, ["tree", "block"])
    return joined.select("tree", *further, F.inline(rows)).select("tree", *further, "r.*", "path").drop("pos")


def proofs(leaves: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """leaves (with the column hash) with subroot, root and path, the siblings of each level from the leaf to the
    root of all trees. tree: the column whose values have a tree each, null first, the others bytewise."""
    key = F.coalesce(F.concat(F.lit("="), F.col(tree)), F.lit(""))
    low = _blocks(stored(leaves.withColumn("tree", key), "merkle-leaves"), [*order, "hash"], "merkle")
    upper = stored(_exchanged(low, "merkle"), "merkle-upper")
    roots = upper.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("node").alias("hash"))
    top_low = _blocks(roots, ["key"], "merkle-top")
    top = _spread(top_low, _exchanged(top_low, "merkle-top"))
    top = top.select(F.col("key").alias("tree"), F.col("hash").alias("subroot"), F.col("node").alias("root"), F.col("path").alias("above"))
    upper = salted_join(upper.drop("node"), top, ["tree"], "block")
    upper = upper.withColumn("path", F.concat("path", "above")).drop("above")
    return _spread(low, stored(upper, "merkle-upper")).drop("tree")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root and path of every document; the trees are its sources."""
    values = {c: F.col(c) for c in FIELDS}
    leaves = docs.select("doc_id", "source", leaf_hash(**values).alias("hash"))
    return proofs(leaves, "source", ["doc_id"]).select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", "path")


def verified(docs: DataFrame, tampered: Column) -> DataFrame:
    """The manifest as digests, with the root that each leaf folds to. tampered: the text where it has been
    tampered with, else null; it replaces the text in that leaf, whose siblings are the original ones."""
    values = {c: F.col(c) for c in FIELDS}
    leaves = docs.select(
        "doc_id", "source", leaf_hash(**values).alias("hash"),
        F.when(tampered.isNotNull(), leaf_hash(**values | {"text": tampered})).alias("now"),
    )
    rows = proofs(leaves, "source", ["doc_id"])
    return rows.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("now", "hash"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
