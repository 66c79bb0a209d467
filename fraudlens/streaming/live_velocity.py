"""Velocity kept up to date by the stream, so that asking for it does not read the alerts.

Each batch adds the counts of its alerts by domain and second, ``velocity_cells/origin=.../batch_id=...``; a batch that is run again
overwrites its own.  Seconds are counted from the first alert of all (``origin``), in microseconds exact, so buckets of any
whole number of seconds are sums of them.  A batch with an earlier alert moves the origin: the cells are then made
again from the stored alerts, below the new origin, and readers take the earliest origin there is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraudlens.operators.analytics import velocity_series
from fraudlens.sources.alert_store import ALERTS, chosen_folders, file_system, read_table, stored_folders
from fraudlens.sources.sinks import write_alert_batch

SECOND = 1_000_000


def cells_of(alerts: DataFrame, origin: int, *keys: Column | str) -> DataFrame:
    """Alerts by domain and second since ``origin``."""
    elapsed = F.unix_micros("created_at") - F.lit(origin)
    return alerts.groupBy(*keys, "domain", ((elapsed - F.pmod(elapsed, F.lit(SECOND))) / SECOND).cast("long").alias("second")).agg(
        F.count("*").alias("alerts"),
        F.sum(F.col("fraud_score").cast("long")).alias("score_sum"),
        F.min("created_at").alias("first_created"),
        F.max("created_at").alias("last_created"),
    )


def origins(spark: SparkSession, path: str) -> list[int]:
    files, root = file_system(spark, f"{path}/velocity_cells")
    if not files.exists(root):
        return []
    names = [s.getPath().getName() for s in files.listStatus(root)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("origin="))


def add_batch(alerts: DataFrame, batch_id: int, path: str) -> None:
    """Add a batch's alerts, which the store below ``path`` holds already."""
    spark = alerts.sparkSession
    first = alerts.agg(F.unix_micros(F.min("created_at")).alias("first")).first()["first"]
    known = origins(spark, path)
    if first is None:
        if known:  # a batch that is run again may have had alerts before
            cells_of(alerts, known[0]).write.mode("overwrite").parquet(_folder(path, known[0], batch_id))
        return
    if known and first < known[0]:
        for folder in chosen_folders(stored_folders(spark, f"{path}/{ALERTS}")):
            rows = spark.read.parquet(f"{path}/{ALERTS}/{folder.name}")
            cells_of(rows, first).write.mode("overwrite").parquet(_folder(path, f"{first}.new", folder.first))
        files, made = file_system(spark, f"{path}/velocity_cells/next={first}.new")
        files.rename(made, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/velocity_cells/origin={first}"))
        return
    origin = known[0] if known else first
    cells_of(alerts, origin).write.mode("overwrite").parquet(_folder(path, origin, batch_id))


def _folder(path: str, origin: int | str, batch_id: int) -> str:
    kind = "origin" if isinstance(origin, int) else "next"
    return f"{path}/velocity_cells/{kind}={origin}/batch_id={batch_id}"


def alert_sink_with_velocity(path: str) -> Callable[[DataFrame, int], None]:
    """Stores a batch's alerts, then its counts; both are overwritten if the batch is run again."""
    def write(rows: DataFrame, batch_id: int) -> None:
        write_alert_batch(rows, batch_id, path)
        add_batch(rows.sparkSession.read.parquet(f"{path}/{ALERTS}/batch_id={batch_id}"), batch_id, path)

    return write


def velocity_now(spark: SparkSession, path: str, bucket_seconds: int = 5, trend_rows: int = 1) -> DataFrame:
    """The same series as ``analytics.velocity`` over all alerts, from the counts alone."""
    known = origins(spark, path)
    if not known:
        return velocity_series(_buckets(cells_of(read_table(spark, path), 0), bucket_seconds), bucket_seconds, trend_rows)
    cells = spark.read.parquet(f"{path}/velocity_cells/origin={known[0]}").drop("batch_id")
    return velocity_series(_buckets(cells, bucket_seconds), bucket_seconds, trend_rows)


def _buckets(cells: DataFrame, bucket_seconds: int) -> DataFrame:
    x = (F.col("second") - F.pmod(F.col("second"), F.lit(bucket_seconds))).cast("double")
    return (
        cells.groupBy("domain", x.alias("x"))
        .agg(
            F.sum("alerts").alias("y1_velocity"), F.sum("score_sum").alias("_score_sum"),
            F.min("first_created").alias("bucket_start"), F.max("last_created").alias("bucket_end"),
        )
        .withColumn("y2_avg_score", F.expr("((20 * _score_sum + y1_velocity) div (2 * y1_velocity)) / 10"))
        .drop("_score_sum")
    )
