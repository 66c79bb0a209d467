"""Indexes beside the stored alerts: by id, and by place in the newest-first order.

* ``alerts_by_id`` and ``suspicious_transactions`` lie in hash buckets of the alert's id.  The folder of a bucket names how many
  there are (``of=64/bucket=17``), so a lookup computes its bucket from the folders themselves and opens that one; tables
  written at different sizes can lie side by side.  Within a bucket rows are sorted by id.
* ``alert_pages`` has the number of alerts by range of (last_seen, id), domain and severity.  Adding these up says in which
  range a page begins, so a page reads its own range of alerts, however deep it lies.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fraudlens.operators.alerts import alert_detail, alert_summary, filter_alerts, newest_first

# Rows of a bucket of ids, rows of a range of the page index.
BUCKET_ROWS, RANGE_ROWS, MOST_BUCKETS = 1_000_000, 100_000, 1 << 14


def bucket_count(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """A power of two."""
    return min(1 << max(ceil(rows / bucket_rows) - 1, 0).bit_length(), MOST_BUCKETS)


def bucket_of(alert_id: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(alert_id), buckets).cast("int")


def write_by_id(rows: DataFrame, path: str, tie: list[str], bucket_rows: int = BUCKET_ROWS) -> None:
    """Rows in buckets of ``alert_id``, sorted by it and ``tie``.

    ``rows`` should be a stored table, it is read twice.  Buckets are cut by ranges of (id, tie), so an
    alert that has a large share of the rows is spread over several tasks and files.
    """
    count = bucket_count(rows.count(), bucket_rows)
    order = ["bucket", "alert_id", *tie]
    placed = rows.withColumns({"of": F.lit(count), "bucket": bucket_of(F.col("alert_id"), F.lit(count))})
    if not tie:  # ids are unique, so a bucket fits a task
        placed = placed.repartition(count, "bucket")
    else:
        placed = placed.repartitionByRange(*order)
    placed.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("of", "bucket").parquet(path)


def with_id(rows: DataFrame, alert_id: str) -> DataFrame:
    """The rows of one alert; only its bucket's folder is opened."""
    own = F.col("bucket") == bucket_of(F.lit(alert_id), F.col("of"))
    return rows.filter(own & (F.col("alert_id") == alert_id)).drop("of", "bucket")


def lookup(spark: SparkSession, path: str, alert_id: str) -> DataFrame:
    """One alert in full shape with its transactions, one row each (see ``alert_detail``)."""
    alert = with_id(spark.read.parquet(f"{path}/alerts_by_id"), alert_id)
    return alert_detail(alert, with_id(spark.read.parquet(f"{path}/suspicious_transactions"), alert_id))


def write_page_index(alerts: DataFrame, path: str, range_rows: int = RANGE_ROWS) -> None:
    """Counts by range, domain and severity of a stored table of alerts; ``last_seen`` and ``alert_id`` have no nulls."""
    ranges = max(1, ceil(alerts.count() / range_rows))
    order = ["last_seen", "alert_id"]
    ranged = alerts.select(*order, "domain", "severity").repartitionByRange(ranges, *order)
    (
        ranged.withColumn("range", F.spark_partition_id())
        .groupBy("range", "domain", "severity")
        .agg(F.count("*").alias("rows"), F.min(F.struct(*order)).alias("oldest"), F.max(F.struct(*order)).alias("newest"))
        .write.mode("overwrite").parquet(path)
    )


def place_of_page(index: DataFrame, domain: str | None, severity: str | None, page: int, limit: int) -> dict:
    """Total under the filters, the bounds of the ranges a page lies in, and how many of their rows come before it."""
    offset = (page - 1) * limit
    chosen = filter_alerts(index, domain, severity)
    ranges = chosen.groupBy("range").agg(
        F.sum("rows").alias("rows"), F.min("oldest").alias("oldest"), F.max("newest").alias("newest")
    )
    before = F.sum("rows").over(Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1))
    placed = ranges.withColumn("before", F.coalesce(before, F.lit(0)))
    hit = (F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset)
    own = lambda column: F.when(hit, F.col(column))
    row = placed.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"), F.min(own("oldest")).alias("oldest"),
        F.max(own("newest")).alias("newest"), F.min(own("before")).alias("before"),
    ).first()  # one row, of counts and bounds
    return {**row.asDict(), "skip": None if row["before"] is None else offset - row["before"]}


def page_by_number(
    alerts: DataFrame, index: DataFrame, domain: str | None = None, severity: str | None = None, page: int = 1, limit: int = 10
) -> DataFrame:
    """The same page as ``alerts_page``, from the ranges it lies in alone."""
    place = place_of_page(index, domain, severity, page, limit)
    matching = filter_alerts(alerts, domain, severity)
    if place["skip"] is None:  # past the end
        rows = matching.limit(0)
    else:
        low, high = place["oldest"], place["newest"]
        seen, pair = F.col("last_seen"), F.struct("last_seen", "alert_id")
        bound = lambda b: F.struct(F.lit(b["last_seen"]).alias("last_seen"), F.lit(b["alert_id"]).alias("alert_id"))
        inside = (seen >= F.lit(low["last_seen"])) & (seen <= F.lit(high["last_seen"]))
        rows = newest_first(matching.filter(inside & (pair >= bound(low)) & (pair <= bound(high)))).offset(place["skip"]).limit(limit)
    return alert_summary(rows).select("*", F.lit(place["total"]).alias("total"), F.lit(page).alias("page"))
