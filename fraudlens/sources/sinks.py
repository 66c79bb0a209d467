"""Batch sinks and the replay-safe alert sink."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from fraudlens.functions.parsing import JSON_OPTIONS, TIMESTAMP_FORMAT, to_snake_json
from fraudlens.session import prepare
from fraudlens.sources.alert_index import BUCKET_ROWS, RANGE_ROWS, write_by_id, write_page_index


def write_by_domain(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("domain").parquet(path)


def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_labels_csv(labels: DataFrame, path: str) -> None:
    labels.write.mode("overwrite").option("header", True).option("quote", '"').option(
        "escape", '"'
    ).option("timestampFormat", TIMESTAMP_FORMAT).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**JSON_OPTIONS).json(path)


def write_events(df: DataFrame, target: str, sink: str = "kafka", topic: str = "all-transactions") -> None:
    """One snake_case JSON record per event, keyed by actor on a topic."""
    records = df.select(F.col("actor_id").alias("key"), to_snake_json(df).alias("value"))
    if sink == "kafka":
        (
            records.write.format("kafka")
            .option("kafka.bootstrap.servers", target)
            .option("kafka.acks", "all")
            .option("topic", topic)
            .save()
        )
    else:
        records.select("value").write.mode("overwrite").text(target)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One small JSON document (a single aggregated row)."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


# --- Alerts and their transactions ---------------------------------------------


def flat_patterns(alerts: DataFrame) -> DataFrame:
    """Patterns as comma-joined text, for stores without arrays."""
    return alerts.withColumn("patterns_detected", F.array_join("patterns_detected", ","))


def write_alerts(alerts: DataFrame, path: str, file_rows: int = RANGE_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The alerts of a batch job in files that each hold a stretch of time of one domain, which is what the
    alert queries filter and order by, with their indexes (see ``alert_index``); returns the stored table."""
    spark, order = prepare(alerts.sparkSession), ["domain", "last_seen", "alert_id"]
    ranged = alerts.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").option("maxRecordsPerFile", file_rows).partitionBy("domain").parquet(f"{path}/fraud_alerts")
    stored = spark.read.schema(alerts.schema).parquet(f"{path}/fraud_alerts").select(*alerts.columns)
    write_by_id(stored, f"{path}/alerts_by_id", [], bucket_rows)
    write_page_index(stored, f"{path}/alert_pages", file_rows)
    return stored


def write_alert_transactions(children: DataFrame, path: str, bucket_rows: int = BUCKET_ROWS) -> None:
    """The transactions of alerts in buckets of the alert's id."""
    write_by_id(children, f"{path}/suspicious_transactions", ["transaction_id"], bucket_rows)


def write_alert_tables(alerts: DataFrame, children: DataFrame, path: str) -> None:
    """Both alert tables from a batch job."""
    write_alerts(alerts, path)
    write_alert_transactions(children, path)


def split_alert_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of (alert_id, alert, txn) to the parent and the child table.

    ``alert`` is set on at least one row of each alert; a null ``txn`` is an alert
    without transactions.
    """
    parents = rows.filter(F.col("alert").isNotNull()).select("alert.*").dropDuplicates(["alert_id"])
    children = rows.filter(F.col("txn").isNotNull()).select("alert_id", "txn.*")
    return parents, children


def write_alert_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """Write one batch into its own ``batch_id`` folder of both tables.

    A replay of the batch overwrites what the first attempt left, whichever of the two
    writes it failed in.
    """
    rows = rows.persist()
    try:
        parents, children = split_alert_rows(rows)
        parents.write.mode("overwrite").parquet(f"{path}/fraud_alerts/batch_id={batch_id}")
        children.write.mode("overwrite").parquet(f"{path}/suspicious_transactions/batch_id={batch_id}")
    finally:
        rows.unpersist()


def parquet_alert_sink(path: str) -> Callable[[DataFrame, int], None]:
    return lambda rows, batch_id: write_alert_batch(rows, batch_id, path)


def not_yet_stored(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(stored.select(*keys).distinct(), keys, "left_anti")


def stored_keys(table: str, keys: list[str], time_column: str, low: datetime, high: datetime) -> str:
    """The subquery for the keys a database holds between two times, ends included."""
    times = [f"'{t.isoformat(sep=' ', timespec='microseconds')}'" for t in (low, high)]
    return f"(SELECT {', '.join(keys)} FROM {table} WHERE {time_column} BETWEEN {times[0]} AND {times[1]}) stored"


def jdbc_alert_sink(
    url: str, properties: dict[str, str], arrays: bool = True
) -> Callable[[DataFrame, int], None]:
    """Append parents and children that the database does not hold yet.

    Each table is checked on its own key, so a failure between the two writes is
    repaired by the replay.  Only keys between the first and last time of the batch are read back.
    ``arrays=False`` stores patterns as text.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows = rows.persist()
        try:
            parents, children = split_alert_rows(rows)
            if not arrays:
                parents = flat_patterns(parents)
            for table, part, keys, time in (
                ("fraud_alerts", parents, ["alert_id"], "last_seen"),
                ("suspicious_transactions", children, ["alert_id", "transaction_id"], "timestamp"),
            ):
                # as text in the session's zone, as the columns are stored
                low, high = part.agg(*(f(time).cast("timestamp_ntz") for f in (F.min, F.max))).first()
                if low is None:
                    continue
                stored = spark.read.jdbc(url, stored_keys(table, keys, time, low, high), properties=properties)
                new = not_yet_stored(part, stored, keys)
                new.write.option("batchsize", 1000).jdbc(url, table, "append", properties)
        finally:
            rows.unpersist()

    return write
