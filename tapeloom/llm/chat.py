"""Chat formatting of logged conversations, after collapse of cumulative snapshots.

A log that writes a conversation anew after each turn holds every prefix of it. The rolling hash of
a turn covers the conversation up to that turn: the exclusive or of 128-bit hashes of position,
role and text. A conversation's last rolling hash is its own; a rolling hash that has more turns than
conversations ending there continues somewhere. Conversations whose hash continues are prefixes of
longer ones and are removed by an anti-join; of equal ones the smallest conv_id stays. What stays is
rendered turn by turn.

Hot keys. Many conversations may share their first turns, or be equal: hashes are aggregated before the
shuffle, and the anti-join has each of them once on either side. One conversation may have a third of
all turns: positions and rolling hashes run along chunks of a range partitioning, then along one row
for each chunk. The result has one row a turn, so no conversation is gathered anywhere. Texts are
shuffled once; intermediate tables are stored in the shared scratch folder.

Turns are ordered by number (null first), then role, then a hash of the text. A repeated row counts
once. Null roles and texts count as empty; rows without conv_id are one conversation of id null.
Further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import NO_ID, chunked, salted_join, stored

KEYS = ["conv_id", "turn", "role", "t1", "t2"]
HASH = ["position", "p1", "p2"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, t1, t2, text) without nulls but in turn."""
    text = F.coalesce("text", F.lit(""))
    return conversations.select(
        F.coalesce("conv_id", F.lit(NO_ID)).alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2"), text.alias("text"),
    )


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(keys, position, p1, p2): of each turn its position from 1 and the hash of all up to it."""
    rows = chunked(turns.select(*KEYS).distinct(), "conv_id", KEYS[1:], "turns")
    inside = Window.partitionBy("conv_id", "chunk").orderBy(*KEYS[1:])
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("conv_id", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = rows.withColumn("i", F.row_number().over(inside)).join(starts, ["conv_id", "chunk"])
    placed = placed.withColumn("position", F.col("start") + F.col("i"))
    own = [F.xxhash64("position", F.lit(seed), "role", "t1", "t2").alias(f"h{seed}") for seed in (1, 2)]
    placed = stored(placed.select(*KEYS, "chunk", "position", *own), "placed")
    parts = placed.groupBy("conv_id", "chunk").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    so_far = [F.coalesce(F.bit_xor(f"x{k}").over(before), F.lit(0)).alias(f"b{k}") for k in (1, 2)]
    along = [F.bit_xor(f"h{k}").over(inside).alias(f"a{k}") for k in (1, 2)]
    rolled = placed.select("*", *along).join(parts.select("conv_id", "chunk", *so_far), ["conv_id", "chunk"])
    return rolled.select(*KEYS, "position", *(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}")).alias(f"p{k}") for k in (1, 2)))


def maximal(hashes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that are no prefix of another; of equal ones
    the smallest conv_id, with their number."""
    ends = hashes.groupBy("conv_id").agg(F.max(F.struct(*HASH)).alias("end")).select("conv_id", "end.*")
    ends = ends.groupBy(*HASH).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    passed = hashes.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"))
    both = passed.unionByName(ends.select(*HASH, (-F.col("n_copies")).alias("n")))
    continued = both.groupBy(*HASH).agg(F.sum("n").alias("n")).where("n > 0").select(*HASH)
    return ends.join(continued, HASH, "left_anti").select("conv_id", F.col("position").alias("n_turns"), "n_copies")


def chat_markup(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, n_turns, n_copies, rendered): the turns of the maximal conversations. Those of a
    conversation, in order of position, are its text."""
    own = turns(conversations)
    hashes = stored(prefix_hashes(own), "prefixes")
    kept = stored(maximal(hashes), "maximal")
    rows = salted_join(hashes, kept, ["conv_id"], "t1").select(*KEYS, "position", "n_turns", "n_copies")
    texts = own.dropDuplicates(KEYS)
    same = [texts[k].eqNullSafe(rows[k]) for k in KEYS]
    joined = rows.join(texts, same)
    return joined.select(
        F.when(rows["conv_id"] != NO_ID, rows["conv_id"]).alias("conv_id"), "position", "n_turns", "n_copies",
        chat_markup(rows["role"], texts["text"]).alias("rendered"),
    )
