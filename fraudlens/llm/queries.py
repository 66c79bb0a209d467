"""The corpus operators over the provided tables, each with its check query where SQL has one.

The queries are thin: rows come from the operator, digest columns are derived from them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens.llm import (
    bpe, centroids, filter_audit, kneser_ney, line_dedup, line_quality, packing, pii, simhash, suffix_array, suffix_tree, warc,
    winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_packed_rows")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed rows themselves."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op2_kneser_ney_scores")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    model = kneser_ney.fit(documents.where(~held_out), order=3)
    return kneser_ney.score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )


@query("op3_simhash_components")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("bits")).alias("fingerprint"), "component_id")


_WORD = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op4_suffix_tree_dedup", f"""
WITH doc AS (
  SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {_WORD} AS w FROM documents)
), win AS (
  SELECT doc_id, pos, array_to_string(list_slice(w, pos, pos + 19), ' ') AS gram
  FROM (SELECT *, unnest(range(1, n - 18)) AS pos FROM doc)
), ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) AS r FROM win
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps, count(DISTINCT p) AS n_removed
  FROM (SELECT doc_id, unnest(range(pos, pos + 20)) AS p FROM ranked WHERE r > 1) GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM doc) x
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(ps) AS p FROM gone) g WHERE g.doc_id = x.doc_id AND g.p = x.p)
  GROUP BY doc_id
)
SELECT doc_id, n AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM doc LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_tree.remove_repeated_windows(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n_tokens").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_suffix_array_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_array.remove_repeated_windows(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.col("n_tokens").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


#: How many capture times lie between a page and the repeated visit that found it unchanged.
REVISIT_AFTER = 5000


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two captures of each page: its response, and a later visit that got a 304 answer to its validator."""
    page = table(spark, sf_dir, "pages")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    length = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    response = page.select(
        (2 * F.col("page_id")).alias("record_id"), F.lit("response").alias("type"), "url", F.col("page_id").alias("at"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), length, F.lit("ETag"), tag,
            F.lit("Date"), F.concat(F.lit("t"), F.col("page_id").cast("string")),
        ).alias("headers"),
        F.col("html").alias("body"),
    )
    revisit = page.select(
        (2 * F.col("page_id") + 1).alias("record_id"), F.lit("revisit").alias("type"), "url",
        (F.col("page_id") + REVISIT_AFTER).alias("at"),
        F.create_map(
            F.lit("Content-Length"), F.lit("0"), F.lit("etag"), tag, F.lit("X-Cache"), F.lit("HIT"),
            F.lit("Date"), F.concat(F.lit("t"), (F.col("page_id") + REVISIT_AFTER).cast("string")),
        ).alias("headers"),
        F.lit(None).cast("string").alias("body"),
    )
    return response.unionByName(revisit)


_PARTS = r"'^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?'"


@query("op6_warc_revisits", rf"""
WITH part AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url, {_PARTS}, 1)), ':(80|443)?$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_replace(regexp_extract(url, {_PARTS}, 2), '/+', '/', 'g'), '/$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(url, {_PARTS}, 3), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)'))), '&') AS q
  FROM pages
), page AS (
  SELECT page_id, coalesce(html, '') AS html, '"' || md5(coalesce(html, '')) || '"' AS tag,
         CASE WHEN host <> '' THEN host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS url_key
  FROM part
), paired AS (
  SELECT v.*, r.page_id AS r_id, r.html AS r_html, r.tag AS r_tag
  FROM page v LEFT JOIN page r ON r.url_key = v.url_key AND r.page_id <= v.page_id + {REVISIT_AFTER}
  QUALIFY row_number() OVER (PARTITION BY v.page_id ORDER BY
    (r.page_id < v.page_id + {REVISIT_AFTER} OR 2 * r.page_id < 2 * v.page_id + 1) DESC, r.page_id DESC) = 1
)
SELECT 2 * page_id + 1 AS record_id, url_key, 2 * r_id AS refers_to,
       CASE WHEN r_id IS NULL THEN 'unmatched' WHEN r_tag = tag THEN 'resolved' ELSE 'mismatch' END AS outcome,
       CASE WHEN r_tag = tag
         THEN 'content-length=' || strlen(r_html) || ';content-type=text/html;date=t' || (page_id + {REVISIT_AFTER}) || ';etag=' || tag
         ELSE 'content-length=0;date=t' || (page_id + {REVISIT_AFTER}) || ';etag=' || tag || ';x-cache=HIT' END AS headers,
       CASE WHEN r_tag = tag THEN sha256(r_html) END AS body_sha256
FROM paired
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(warc_records(spark, sf_dir))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select(
        "record_id", "url_key", "refers_to", "outcome", F.array_join(lines, ";").alias("headers"), F.sha2("body", 256).alias("body_sha256")
    )


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_FOLDED = f"translate(coalesce(text, ''), {_LOWER})"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op7_winnowing_contamination", f"""
WITH item AS (
  SELECT item_id, w, len(w) AS n, least(len(w), 10) AS l FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), item_window AS (
  SELECT DISTINCT item_id, l, array_to_string(list_slice(w, pos, pos + l - 1), ' ') AS gram
  FROM (SELECT *, unnest(range(1, n - l + 2)) AS pos FROM item)
), doc AS (
  SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {_WORDS} AS w FROM documents)
), doc_window AS (
  SELECT doc_id, l, pos, array_to_string(list_slice(w, pos, pos + l - 1), ' ') AS gram
  FROM (SELECT doc.*, l, unnest(range(1, n - l + 2)) AS pos FROM doc CROSS JOIN (SELECT DISTINCT l FROM item))
), found AS (
  SELECT doc_id, d.l, pos, item_id FROM doc_window d JOIN item_window i ON d.gram = i.gram AND d.l = i.l
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + l)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, n AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = winnowing.words_hit(F.col("spans"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


_BLANK = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))


@query("op8_line_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    field = line_quality.fit(documents, table(spark, sf_dir, "labels"))
    return line_quality.judge(documents, field).drop("content_lines")


@query("op9_bpe_round_trip")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("tokens", 256).alias("decoded_sha256"),
    )


@query("op10_line_dedup", f"""
WITH l AS (
  SELECT doc_id, n_lines, pos, line, translate(trim(line, {_BLANK}), {_LOWER}) AS key
  FROM (SELECT doc_id, len(parts) AS n_lines, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), hot AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.*, hot.key IS NOT NULL AND l.doc_id <> hot.keeper AS gone FROM l LEFT JOIN hot ON l.key = hot.key
)
SELECT doc_id, first(n_lines) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.mark_repeated_lines(table(spark, sf_dir, "documents"))
    return marked.select(
        "doc_id", F.size(line_dedup.lines_of(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped_lines"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


@query("op11_filter_audit", f"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_WORD} AS w FROM documents
), flag AS (
  SELECT doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
         100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS f FROM doc
), rated AS (
  SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY 1
), cell AS (
  SELECT part, f, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM flag LEFT JOIN rated USING (doc_id) GROUP BY 1, 2
), i AS (SELECT unnest(range(1, 6)) AS x), orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM i a, i b, i c, i d, i e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT o, s, o[s] AS own, list_transform(o, lambda k: substr('ABCDE', k::BIGINT, 1)) AS names FROM orders, (SELECT x AS s FROM i)
), seen AS (
  SELECT part, o, s, own, names, n, good, toxic, f[own] AS fails,
         len(list_filter(o[1:s - 1], lambda k: f[k])) > 0 AS gone, len(list_filter(f, lambda x: x)) AS n_fails
  FROM cell, steps
), figure AS (
  SELECT part, array_to_string(any_value(names), '') AS filter_order, s, own,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE fails AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS toxic_lost
  FROM seen GROUP BY part, o, s, own
)
SELECT part, filter_order, s::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM figure
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(counts)


@query("op12_personal_data")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = pii.find(documents, pii.fit(documents))
    listed = lambda name: F.array_join(
        F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def _clustering_sql(k: int, rounds: int) -> str:
    gap = "list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = [
        """x AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda e: CAST(floor(64 * e::DOUBLE) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v
  FROM x ORDER BY sha256('1:' || vec_id), v LIMIT {k})""",
    ]
    for t in range(rounds + 1):
        parts.append(f"""a{t} AS MATERIALIZED (SELECT r, vec_id, x.v, c, {gap} AS d FROM x, c{t} c
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if t < rounds:
            parts.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT c, coalesce(any_value(m.v), any_value(c{t}.v)) AS v FROM c{t} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT c, i, sum(e)::BIGINT AS s, count(*) AS n
      FROM (SELECT c, unnest(v) AS e, generate_subscripts(v, 1) AS i FROM a{t}) GROUP BY c, i) GROUP BY c) m USING (c) GROUP BY c)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)"""


@query("op13_centroid_clusters", _clustering_sql(centroids.CENTROIDS, centroids.ROUNDS))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, final = centroids.cluster(table(spark, sf_dir, "embeddings"))
    digest = F.lit(None).cast("string")
    for number, text in enumerate(centroids.digests(final)):
        digest = F.when(F.col("cluster") == number, F.lit(text)).otherwise(digest)
    return found.withColumn("centroid_sha256", digest)
