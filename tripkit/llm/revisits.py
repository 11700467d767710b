"""Resolve not-modified revisit records of web archives to the responses they refer to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripkit.llm.common import slices_for

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[^=]*|gclid|fbclid)(=|$)"
# Fields of a 304 that never replace stored ones: they describe the message or the connection, not the resource.
NOT_MERGED = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
]


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, path without a closing slash, sorted query without tracking, no
    scheme and fragment. Null for null and for text without ``://``."""
    part = lambda k: F.regexp_extract(url, r"(?s)^[^/?#]*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?", k)
    host = F.regexp_replace(F.translate(part(1), UPPER, LOWER), r":(80|443)$", "")
    path = F.regexp_replace(part(2), r"/+$", "")
    args = F.array_sort(F.filter(F.split(part(3), "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    query = F.when(F.size(args) > 0, F.concat(F.lit("?"), F.array_join(args, "&"))).otherwise("")
    return F.when(url.rlike(r"(?s)^[^/?#]*?://"), F.concat(host, path, query))


def named_headers(headers: Column) -> Column:
    """Headers with names in lower case; the first of equal names stays; null becomes empty."""
    empty = F.create_map().cast("map<string,string>")
    entries = F.map_entries(F.coalesce(headers, empty))
    lowered = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(lowered, lambda e: e["key"])
    return F.map_from_entries(F.filter(lowered, lambda e, i: F.array_position(names, e["key"]) == i + 1))


def latest_earlier(asked: DataFrame, found: DataFrame, key: str, time: str, payload: str) -> DataFrame:
    """For each distinct (``key``, ``time``) of ``asked`` the payload of ``found`` with the latest earlier time.

    ``found`` holds one payload per key and time. Each key's events are cut into time slices; windows run inside
    one slice and the last payload of earlier slices carries over, so a key with most of the events is spread out.
    """
    events = (
        found.select(key, time, F.col(payload).alias("__found"), F.lit(False).alias("__asked"))
        .unionByName(asked.select(key, time, F.lit(None).cast(found.schema[payload].dataType).alias("__found"), F.lit(True).alias("__asked")))
        .groupBy(key, time).agg(F.max("__found").alias("__found"), F.bool_or("__asked").alias("__asked"))
    )
    low, high, rows = events.agg(F.min(time), F.max(time), F.count("*")).first()
    n, span = slices_for(rows), float((high or 0) - (low or 0) + 1)
    events = events.withColumn("__part", F.floor((F.col(time) - F.lit(low or 0)) * (n / span)))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        events.filter("__found IS NOT NULL").groupBy(key, "__part").agg(F.max_by("__found", time).alias("__last"))
        .unionByName(events.filter("__asked").select(key, "__part").distinct().withColumn("__last", F.lit(None).cast(found.schema[payload].dataType)))
        .groupBy(key, "__part").agg(F.max("__last").alias("__last"))
        .withColumn("__carry", F.last("__last", ignorenulls=True).over(before(Window.partitionBy(key).orderBy("__part"))))
        .select(key, "__part", "__carry")
    )
    inside = before(Window.partitionBy(key, "__part").orderBy(time))
    local = events.withColumn("__local", F.last("__found", ignorenulls=True).over(inside)).filter("__asked")
    return local.join(carried, [key, "__part"], "left").select(key, time, F.coalesce("__local", "__carry").alias(payload))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit record with the response it stands for, the outcome and the merged headers.

    ``records``: ``record_id`` long, ``record_type`` (``response`` or ``revisit``; others are ignored), ``url`` string,
    ``time`` long, ``headers`` map, ``digest`` string; other columns are ignored. The response is the latest one with
    the same canonical URL and a strictly smaller time (at equal times the largest record id). It is accepted when
    each validator that the revisit carries (entity tag by weak comparison, else modification date; payload digest)
    equals the response's; a revisit without any needs a response without validators.

    ``outcome``: ``resolved``, ``validator_mismatch`` or ``no_earlier_response`` (also for null URLs and times).
    ``merged_headers``: the response's, updated by the revisit's permitted ones; null unless resolved. Records that
    repeat are answered each.
    """
    named = records.select(
        "record_id", "record_type", canonical_url(F.col("url")).alias("url_key"), "time",
        named_headers(F.col("headers")).alias("headers"), "digest",
    )
    response = F.struct("record_id", F.to_json("headers").alias("headers"), "digest")
    usable = named.filter("url_key IS NOT NULL AND time IS NOT NULL")
    found = usable.filter("record_type = 'response'").groupBy("url_key", "time").agg(F.max(response).alias("found"))
    revisits = named.filter("record_type = 'revisit'")
    asked = usable.filter("record_type = 'revisit'").select("url_key", "time").distinct()
    answered = latest_earlier(asked, found, "url_key", "time", "found").select("url_key", "time", "found")
    joined = revisits.join(answered, ["url_key", "time"], "left").withColumn(
        "stored", F.from_json("found.headers", "map<string,string>")
    )
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    sent, kept = F.col("headers"), F.col("stored")
    by_validator = (
        F.when(sent["etag"].isNotNull(), F.coalesce(tag(sent) == tag(kept), F.lit(False)))
        .when(sent["last-modified"].isNotNull(), F.coalesce(sent["last-modified"] == kept["last-modified"], F.lit(False)))
        .when(F.col("digest").isNull(), kept["etag"].isNull() & kept["last-modified"].isNull())
        .otherwise(True)
    )
    by_digest = F.col("digest").isNull() | F.col("found.digest").isNull() | (F.col("digest") == F.col("found.digest"))
    outcome = (
        F.when(F.col("found").isNull(), "no_earlier_response")
        .when(by_validator & by_digest, "resolved").otherwise("validator_mismatch")
    )
    # Fields that the revisit's own Connection header names are bound to that connection too.
    bound = F.transform(F.split(F.lower(F.coalesce(sent["connection"], F.lit(""))), ","), lambda x: F.trim(x))
    barred = F.concat(F.array(*map(F.lit, NOT_MERGED)), bound)
    fresh = F.map_filter(sent, lambda k, _: ~F.array_contains(barred, k))
    merged = F.map_concat(F.map_filter(kept, lambda k, _: ~F.map_contains_key(fresh, k)), fresh)
    return joined.withColumn("outcome", outcome).select(
        "record_id", "url_key", "time", "outcome",
        F.when(F.col("outcome") == "resolved", F.col("found.record_id")).alias("response_id"),
        F.when(F.col("outcome") == "resolved", F.coalesce("found.digest", "digest")).alias("payload_digest"),
        F.when(F.col("outcome") == "resolved", merged).alias("merged_headers"),
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records of crawled pages: a response per page and a later revisit of the same page, some with other
    validators, with few or none, or made before the response."""
    p = F.col("page_id")
    etag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    day = F.concat(F.lit("day "), (p % 1000).cast("string"))
    of = lambda *pairs: F.map_filter(F.map_from_arrays(F.array(*(F.lit(k) for k, _ in pairs)), F.array(*(v for _, v in pairs))), lambda _, v: v.isNotNull())
    response = pages.select(
        (p * 2).alias("record_id"), F.lit("response").alias("record_type"), "url", p.alias("time"),
        of(("ETag", etag), ("Last-Modified", day), ("Content-Type", F.lit("text/html")),
           ("Content-Length", F.length("html").cast("string")), ("Cache-Control", F.lit("max-age=60"))).alias("headers"),
        F.md5("html").alias("digest"),
    )
    sent_tag = F.when(p % 7 == 0, None).when(p % 5 == 0, '"changed"').when(p % 5 == 1, None).otherwise(F.concat(F.lit("W/"), etag))
    sent_day = F.when(p % 7 == 0, None).otherwise(day)
    revisit = pages.select(
        (p * 2 + 1).alias("record_id"), F.lit("revisit").alias("record_type"), "url",
        F.when(p % 11 == 0, p - 1).otherwise(p + 1 + (p * 7919) % 5000).alias("time"),
        of(("etag", sent_tag), ("last-modified", sent_day), ("Content-Length", F.lit("0")), ("Age", (p % 60).cast("string")),
           ("cache-control", F.lit("max-age=3600"))).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return response.unionByName(revisit)
