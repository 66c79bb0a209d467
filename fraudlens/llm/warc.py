"""Resolution of not-modified revisit records in web archives.

A revisit record of a 304 answer has headers and no body.  An as-of join finds the latest earlier full
response of the same canonical URL; if a validator that both have (``etag``, else ``last-modified``)
agrees, the revisit gets that response's body, and its stored headers updated by those of the
revisit that a 304 answer may update.

The as-of join never gathers a URL in one task: captures are range-partitioned by (URL, time, id),
filled forward within each part, and each part takes over from the parts of the same URL before
it, of which only the last response counts.

Records have ``record_id`` (long), ``type`` (``response`` or ``revisit``), ``url``, ``at`` (long; any order of
time), ``headers`` (map, names in any case) and ``body``.  Defined cases: a revisit whose URL or time is
null, or without an earlier response, is ``unmatched``; no common validator, or a different one, is
``mismatch`` and names the response it was compared with, without body; records of the same time are in
order of ``record_id``; of responses that share a ``record_id`` one is taken; repeated revisits
are resolved one by one; null headers count as none; empty tables give empty tables.  Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fraudlens.session import fresh_path

#: Headers that a 304 answer sends to update a stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that name where a visit came from, not what it shows.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)"
_URL = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and usual port, path without closing slash, other parameters in order."""
    host = F.lower(F.regexp_extract(url, _URL, 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(url, _URL, 2), "/+", "/"), "/$", "")
    kept = F.filter(F.split(F.regexp_extract(url, _URL, 3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(kept), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def lower_names(headers: Column) -> Column:
    """Header names in lower case; of names that then clash the first in order stays."""
    entries = F.array_sort(F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    return F.map_from_entries(F.aggregate(
        entries, F.filter(entries, lambda e: F.lit(False)),
        lambda acc, e: F.when(F.exists(acc, lambda x: x["key"] == e["key"]), acc).otherwise(F.concat(acc, F.array(e))),
    ))


def latest_response(captures: DataFrame) -> DataFrame:
    """Adds ``refers_to``: the id of the latest earlier row with ``full`` of the same ``key``.

    ``captures`` has ``key, at, record_id, full`` and more; rows without key or time get null.
    """
    spark = captures.sparkSession
    path = fresh_path(spark, "captures")
    order = ["key", "at", "record_id"]
    dated = captures.where(F.col("key").isNotNull() & F.col("at").isNotNull())
    dated.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    response = F.when(F.col("full"), F.col("record_id"))
    before = Window.partitionBy("key", "part").orderBy("at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    filled = stored.withColumn("within", F.last(response, ignorenulls=True).over(before))
    ends = stored.where("full").groupBy("key", "part").agg(F.max_by("record_id", F.struct("at", "record_id")).alias("last"))
    parts = stored.select("key", "part").distinct().join(ends, ["key", "part"], "left")
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    taken = parts.select("key", "part", F.last("last", ignorenulls=True).over(earlier).alias("taken"))
    found = filled.join(taken, ["key", "part"]).withColumn("refers_to", F.coalesce("within", "taken")).drop("part", "within", "taken")
    rest = captures.where(F.col("key").isNull() | F.col("at").isNull()).withColumn("refers_to", F.lit(None).cast("long"))
    return found.unionByName(rest)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id, url_key, refers_to, outcome, headers, body``."""
    named = records.select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("key"),
        F.col("at").cast("long").alias("at"), (F.col("type") == "response").alias("full"),
        F.col("type").alias("type"), lower_names(F.col("headers")).alias("own"), "body",
    ).where(F.col("type").isin("response", "revisit"))
    captures = named.select("key", "at", "record_id", "full", F.when(~F.col("full"), F.col("own")).alias("own"))
    revisits = latest_response(captures).where(~F.col("full"))
    responses = named.where("full").select(
        F.col("record_id").alias("response_id"), F.col("own").alias("stored"), F.col("body").alias("stored_body")
    ).dropDuplicates(["response_id"])
    both = revisits.join(responses, F.col("refers_to") == F.col("response_id"), "left")
    field = lambda side, name: F.col(side)[name]
    agrees = F.coalesce(
        field("own", "etag") == field("stored", "etag"),
        field("own", "last-modified") == field("stored", "last-modified"),
        F.lit(False),
    )
    outcome = F.when(F.col("response_id").isNull(), "unmatched").when(agrees, "resolved").otherwise("mismatch")
    update = F.map_filter("own", lambda name, value: name.isin(*PERMITTED))
    kept = F.map_filter("stored", lambda name, value: ~F.array_contains(F.map_keys(update), name))
    resolved = F.col("outcome") == "resolved"
    return both.withColumn("outcome", outcome).select(
        "record_id", F.col("key").alias("url_key"), F.col("response_id").alias("refers_to"), "outcome",
        F.when(resolved, F.map_concat(kept, update)).otherwise(F.col("own")).alias("headers"),
        F.when(resolved, F.col("stored_body")).alias("body"),
    )
