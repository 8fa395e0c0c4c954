"""The registered queries of this folder: each operator over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import (
    bpe, chat, decontaminate, kneser_ney, line_dedup, merkle, minhash, pii, quality_rules, revisits, spelling, substring, url_filter,
)
from tapeloom.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Rules of the URL filter and their verdicts.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
#: Hosts with a label that starts or ends with one of these words are listed with all their paths.
LISTED = r"(^|[.])((adult|casino|free|spam|cheap|ads)-[^.]*|[^.]*-(bets|pills|track))([.]|$)"


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), RULES, F.col("host").rlike(LISTED))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduped(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


#: A crawl log made of `pages`, as SQL for either engine: each page as fetched, some with status 404; a
#: not-modified revisit a day later, of the URL with another fragment; for some an early revisit that
#: nothing precedes. A seventh of the revisits have another entity tag.
CRAWL = """
SELECT concat('r-', page_id) AS record_id, 'response' AS kind, url, page_id * 10 AS ts,
       CASE WHEN page_id % 11 = 0 THEN 404 ELSE 200 END AS status,
       concat('ETag: "', substr(md5(html), 1, 16), '"', chr(13), chr(10), 'Last-Modified: day ', page_id % 1000, chr(13), chr(10),
              'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', length(html), chr(13), chr(10),
              'Cache-Control: max-age=60') AS headers,
       md5(html) AS payload_digest
FROM pages
UNION ALL
SELECT concat('v-', page_id), 'revisit', concat(url, '#again'), page_id * 10 + 86400, 304,
       concat('etag: W/"', substr(CASE WHEN page_id % 7 = 0 THEN md5(url) ELSE md5(html) END, 1, 16), '"', chr(13), chr(10),
              'content-length: 0', chr(13), chr(10), 'cache-control: max-age=', page_id % 100, chr(13), chr(10), 'date: day ', page_id),
       NULL
FROM pages
UNION ALL
SELECT concat('e-', page_id), 'revisit', url, page_id * 10 - 1, 304, NULL, md5(html) FROM pages WHERE page_id % 3 = 0
"""


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.resolved(spark.sql(CRAWL.replace("FROM pages", "FROM {pages}"), pages=table(spark, sf_dir, "pages")))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_components(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.verified(docs, F.when(chosen, F.translate("text", "\n", "")))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.document_scores(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_url_filter": op2_url_filter,
        "op3_chat_format": op3_chat_format,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_quality_rules": op5_quality_rules,
        "op6_line_dedup": op6_line_dedup,
        "op7_pii": op7_pii,
        "op8_warc_revisits": op8_warc_revisits,
        "op9_minhash": op9_minhash,
        "op10_bpe": op10_bpe,
        "op11_merkle": op11_merkle,
        "op12_lm_scores": op12_lm_scores,
        "op13_spelling": op13_spelling,
    }


def oracle_sql() -> dict[str, str]:
    from tapeloom.llm import oracles

    return oracles.SQL
