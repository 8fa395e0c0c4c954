"""documents -> training tokens: quality rules, line dedup, near-duplicate removal, benchmark
decontamination, tokens. Every stage works on all that the one before kept, written as Parquet.

All stages but the last return the columns of documents. Line dedup writes the text that stays and
counts n_chars anew; the other filters drop whole documents. The last returns one row for each
document with the number and the digests of its tokens.

An empty table passes through all stages. Null texts and ids, repeated rows, ties and further columns
are treated as each operator's module says; the quality rules drop null and short texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm import bpe, decontaminate, line_dedup, minhash, quality_rules
from tapeloom.llm.common import ship, stored, table
from tapeloom.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return line_dedup.drop_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return minhash.drop_near_duplicates(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.token_digests(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash", near),
    ("decontaminate", leaks),
    ("bpe", tokens),
]

#: Tiling and merges by rank are not expressible in SQL; a test compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
