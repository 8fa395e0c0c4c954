"""WARC records: bodies of not-modified revisits.

A revisit record says that a resource was as before. It is resolved by an as-of join: the latest
full response (status 200) of the same canonical URL with an earlier time. Validators have to agree:
entity tags, compared weakly, if both sides have one, else the time of last modification, if both have
it, else the payload digest that the revisit may carry. The headers of the answer are those of the stored
response, replaced by those of the revisit that a not-modified answer is permitted to update.

Hot URLs. The as-of join is no window over a URL: full responses are reduced to one row for each URL and
time, whose order is split into chunks by a range partitioning; the last response is carried along each
chunk, and then along one row for each chunk of a URL. Revisits get it by joins on (URL, time) and on
the response's id that deal out hot keys. Bodies take no part; with_bodies joins them at the end.
Tables between the steps are stored in the shared scratch folder.

Of full responses with equal URL and time the largest record_id counts. A record repeated under one
record_id is taken once; rows without a record_id count as one record. Records with a null time or URL are never resolved and never an answer. Null
headers are none. Further columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import chunked, salted_join, stored

#: Headers that describe the body or the connection, which a not-modified answer doesn't update.
NOT_UPDATED = (
    "connection content-encoding content-length content-location content-range content-type keep-alive "
    "proxy-authenticate proxy-authorization te trailer transfer-encoding upgrade"
).split()
#: Query parameters that don't choose the resource.
IGNORED_PARAMETERS = "utm_[^=]*|ref|fbclid|gclid"


def canonical_url(url: Column) -> Column:
    """The URL without scheme, user, default port, fragment and ignored parameters; host in lower case,
    parameters in order, an empty path as /. Null if there is no ://."""
    host = F.lower(F.regexp_extract(url, "://(?:[^/?#@]*@)?([^/?#]*)", 1))
    host = F.regexp_replace(host, ":(80|443)$", "")
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({IGNORED_PARAMETERS})(=|$)"))
    joined = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(F.lit("")))
    return F.when(F.instr(url, "://") > 0, whole)


def headers(block: Column) -> Column:
    """A map of the lines `Name: value` of a header block, names in lower case; of a repeated name the last
    value counts, and lines without a colon are passed over."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), "\r?\n"), lambda x: F.instr(x, ":") > 1)
    pairs = F.transform(lines, lambda x: F.struct(
        F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"),
        F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value"),
    ))
    last = F.aggregate(
        pairs, F.expr("cast(map() as map<string, string>)"),
        lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["name"]), F.map_from_arrays(F.array(p["name"]), F.array(p["value"]))),
    )
    return last


def merged(stored_headers: Column, update: Column) -> Column:
    """The stored headers with those of the update that it may replace or add."""
    permitted = F.map_filter(update, lambda k, _: ~k.isin(NOT_UPDATED))
    kept = F.map_filter(stored_headers, lambda k, _: ~F.map_contains_key(permitted, k))
    return F.map_concat(kept, permitted)


def header_lines(headers: Column) -> Column:
    """`name: value` in order of names, joined by newlines."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def verdict(stored_headers: Column, stored_digest: Column, update: Column, digest: Column) -> Column:
    """matched, changed or unverified: by the strongest validator that both sides have."""
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    a, b = tag(stored_headers), tag(update)
    t, u = stored_headers["last-modified"], update["last-modified"]
    equal = (
        F.when(a.isNotNull() & b.isNotNull(), a == b)
        .when(t.isNotNull() & u.isNotNull(), t == u)
        .when(stored_digest.isNotNull() & digest.isNotNull(), stored_digest == digest)
    )
    return F.when(equal.isNull(), "unverified").when(equal, "matched").otherwise("changed")


def latest_response(records: DataFrame) -> DataFrame:
    """(url, ts, answer): of each URL and time the id of the latest earlier full response, or null.
    records has record_id, url, ts and full."""
    full = F.max(F.when(F.col("full"), F.col("record_id"))).alias("record_id")
    times = records.where("url IS NOT NULL AND ts IS NOT NULL").groupBy("url", "ts").agg(full)
    times = chunked(times, "url", ["ts"], "times")
    inside = Window.partitionBy("url", "chunk").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("url").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    last = times.groupBy("url", "chunk").agg(F.max_by("record_id", F.when(F.col("record_id").isNotNull(), F.col("ts"))).alias("last"))
    carried = last.select("url", "chunk", F.last("last", ignorenulls=True).over(before).alias("carried"))
    here = times.select("url", "ts", "chunk", F.last("record_id", ignorenulls=True).over(inside).alias("own"))
    return here.join(carried, ["url", "chunk"]).select("url", "ts", F.coalesce("own", "carried").alias("answer"))


def resolved(records: DataFrame) -> DataFrame:
    """One row for each revisit: record_id, url, ts, answer (the id of the response it stands for), status
    (matched, changed, unverified, or missing without an earlier response), headers and payload_digest,
    which are null unless matched.

    records: record_id, kind (response or revisit), url, ts, status, headers (a block), payload_digest.
    """
    one = stored(
        records.select("record_id", "kind", canonical_url(F.col("url")).alias("url"), "ts", "status", "headers", "payload_digest")
        .groupBy("record_id").agg(F.max(F.struct("kind", "url", "ts", "status", "headers", "payload_digest")).alias("r")).select("record_id", "r.*"),
        "records",
    )
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    answers = stored(latest_response(one.select("record_id", "url", "ts", F.coalesce(full, F.lit(False)).alias("full"))), "answers")
    asked = one.where("kind = 'revisit'").select("record_id", "url", "ts", "headers", "payload_digest")
    found = salted_join(asked, answers, ["url", "ts"], "record_id", "left")
    found = stored(found, "found")
    responses = one.where(full).select(
        F.col("record_id").alias("answer"), F.col("headers").alias("of_answer"), F.col("payload_digest").alias("digest_of_answer")
    )
    joined = salted_join(found, responses, ["answer"], "record_id", "left")
    joined = joined.withColumns({"h": headers(F.col("of_answer")), "u": headers(F.col("headers"))})
    status = F.when(F.col("answer").isNull(), "missing").otherwise(
        verdict(F.col("h"), F.col("digest_of_answer"), F.col("u"), F.col("payload_digest"))
    )
    matched = F.col("status") == "matched"
    return joined.withColumn("status", status).select(
        "record_id", "url", "ts", "answer", "status",
        F.when(matched, header_lines(merged(F.col("h"), F.col("u")))).alias("headers"),
        F.when(matched, F.col("digest_of_answer")).alias("payload_digest"),
    )


def with_bodies(done: DataFrame, bodies: DataFrame) -> DataFrame:
    """The matched rows of `resolved` with the body of their answer; bodies has record_id and body."""
    matched = stored(done.where("status = 'matched'"), "matched")
    return salted_join(matched, bodies.select(F.col("record_id").alias("answer"), "body"), ["answer"], "record_id")
