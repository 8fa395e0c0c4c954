"""Line dedup against levelled sorted runs of line hashes.

The index is a set of runs. A run is a table of (h1, h2, doc_id): 128 bits of a line's key and
the document that keeps it; it is bucketed and sorted by the hash, so a batch is shuffled once and
then merge-joined with one run after another, none of which is shuffled. A batch of documents keeps
its lines that no run holds, in the batch's smallest document, and adds them as a run of level 0.
When a level has FANOUT runs, they are merged into one of the next level, so there are about
FANOUT * log(batches) runs.

Batches come in ascending order of doc_id, so a line stays in the smallest document that holds it.
All joins are on keys that are unique on both sides; a line that a third of the documents hold is
reduced before the shuffle and then counts as one row. Texts are shuffled once, to meet the list
of the lines that they lose. Runs and dropped lines are written under the shared scratch folder,
so a lost executor costs the tasks it ran.

A null or empty text is one empty line. Documents with a null id count as one document after all
others; rows that repeat an id count as one document, whose lines don't count twice, and each row
keeps or loses the same lines. Further columns are kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tapeloom.llm.common import NO_ID, arrow, stored
from tapeloom.session import scratch_dir

#: Runs of a level before they are merged into the next.
FANOUT = 2
HASH = ("h1", "h2")


def line_key(line: bytes) -> bytes:
    """The line without x20 and x09-x0D at both ends, A-Z lower-cased."""
    return line.strip().lower()


def is_long(key: bytes, least: int) -> bool:
    return len(key) >= 4 * least or len(key) >= least and len(key.decode()) >= least


def line_hashes(docs: DataFrame, least: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h1, h2): the keys of each document, once each."""
    kind = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, counts = batch.column(0).to_numpy(), [], []
            for x in batch.column(1):
                keys = set(map(line_key, (x.as_py() or "").encode().split(b"\n")))
                digests += (own := [xxh3_128_digest(k) for k in keys if is_long(k, least)])
                counts.append(len(own))
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, counts)), pa.array(both[:, 0]), pa.array(both[:, 1])], schema=kind)

    return docs.select(F.coalesce(F.col(id_col), F.lit(NO_ID)).alias("doc_id"), text).mapInArrow(
        hashed, "doc_id long, h1 long, h2 long"
    )


class LineIndex:
    """Levelled runs of the lines seen so far."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, run: DataFrame) -> str:
        path = scratch_dir(self.spark, "run")
        name = "run_" + path.rpartition("-")[2]
        run.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).saveAsTable(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The rows whose hash no run holds."""
        for run in self.runs():
            lines = lines.join(run.select(*HASH).hint("merge"), [*HASH], "left_anti")
        return lines

    def add(self, lines: DataFrame) -> DataFrame:
        """Adds (h1, h2, doc_id), unique by hash and unseen, as a run; returns the run."""
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(name := self._write(lines))
        run = self.spark.table(name)
        for i, level in enumerate(self.levels):
            if len(level) < self.fanout:
                break
            merged = self.spark.table(level[0])
            for other in level[1:]:
                merged = merged.unionByName(self.spark.table(other))
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(self._write(merged))
            self.levels[i] = []
        return run

    def close(self) -> None:
        """Forgets the runs' names; their files go with the scratch folder."""
        for name in (n for level in self.levels for n in level):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []


def batched(lines: DataFrame, batches: int) -> list[DataFrame]:
    """The lines in ascending ranges of doc_id, of about equal size."""
    at = [i / batches for i in range(1, batches)]
    bounds = sorted(set(lines.approxQuantile("doc_id", at, 0.01))) if at else []
    low, parts = None, []
    for high in [*bounds, None]:
        part = lines if low is None else lines.where(F.col("doc_id") > low)
        parts.append(part if high is None else part.where(F.col("doc_id") <= int(high)))
        low = None if high is None else int(high)
    return parts


def dropped_lines(docs: DataFrame, least: int = 10, batches: int = 4, index: LineIndex | None = None) -> DataFrame:
    """(doc_id, h1, h2) of the lines that documents lose, batch after batch."""
    own = index is None
    index = index or LineIndex(docs.sparkSession)
    lines = stored(line_hashes(docs, least).repartitionByRange("doc_id"), "lines")
    out = []
    for batch in batched(lines, batches):
        firsts = batch.groupBy(*HASH).agg(F.min("doc_id").alias("doc_id"))
        kept = index.add(index.unseen(firsts))
        out.append(stored(batch.join(kept, ["doc_id", *HASH], "left_anti"), "dropped"))
    if own:
        index.close()
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def without_lines(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the struct column `deduped`: n_lines, n_dropped, kept (the text that stays)."""
    kind = pa.struct([("n_dropped", pa.int64()), ("kept", pa.string())])

    def rebuilt(texts: pa.Array, lost: pa.Array) -> pa.Array:
        rows = []
        for t, gone in zip(texts, lost, strict=True):
            if not gone.is_valid:  # stays as it is, and was not sent here
                rows.append({"n_dropped": 0, "kept": None})
                continue
            known = np.asarray(gone.values).tobytes()
            known = {known[i : i + 16] for i in range(0, len(known), 16)}
            lines = (t.as_py() or "").encode().split(b"\n")
            stay = [x for x in lines if xxh3_128_digest(line_key(x)) not in known]
            rows.append({"n_dropped": len(lines) - len(stay), "kept": b"\n".join(stay).decode()})
        return pa.array(rows, kind)

    rebuild = arrow(rebuilt, "n_dropped long, kept string")
    lost = dropped.groupBy("doc_id").agg(F.flatten(F.collect_list(F.array(*HASH))).alias("lost"))
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.coalesce(F.col(f"row.{id_col}"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(f"row.{text}", F.lit("")).alias("whole")
    )
    joined = rows.join(lost, "doc_id", "left").select(
        "row", "whole", rebuild(F.when(F.col("lost").isNotNull(), F.col("whole")), "lost").alias("new")
    )
    return joined.select(
        "row",
        F.struct(
            (F.length("whole") - F.length(F.replace("whole", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
            F.col("new.n_dropped").alias("n_dropped"),
            F.coalesce("new.kept", "whole").alias("kept"),
        ).alias("deduped"),
    )


def deduped(docs: DataFrame) -> DataFrame:
    """One row for each document: its line counts and the digest of the text that stays."""
    done = without_lines(docs, dropped_lines(docs))
    return done.select(
        "row.doc_id", "deduped.n_lines", "deduped.n_dropped", F.sha2(F.col("deduped.kept"), 256).alias("kept_sha256")
    )


def drop_lines(docs: DataFrame) -> DataFrame:
    """The documents with the text that stays, and n_chars counted anew where there is such a column."""
    done = without_lines(docs, dropped_lines(docs))
    new = {"text": F.col("deduped.kept"), "n_chars": F.length("deduped.kept").cast("long")}
    return done.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
