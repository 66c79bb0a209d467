"""The stream's alert tables as a store: generated keys, and compaction of closed batches.

Below ``path`` each table has a folder a batch (``batch_id=7``) and folders that hold closed batches together
(``batches=0-99``).  A folder counts once Spark's commit marker is in it, and a reader takes each batch from one folder only, so
it sees every row once before, during and after a compaction.  Folders that are covered go later (``vacuum``), when no
reader still uses them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens.operators.positions import numbered
from fraudlens.sources.sinks import split_alert_rows

ALERTS, TRANSACTIONS = "fraud_alerts", "suspicious_transactions"
FOLDER = re.compile(r"^(?:batch_id=(\d+)|batches=(\d+)-(\d+))$")
# Keys of a batch begin at its number times this.
KEYS_OF_A_BATCH = 1 << 36


# --- Generated keys ---------------------------------------------------------------


def with_generated_keys(alerts: DataFrame, batch_id: int, out: str = "alert_key") -> DataFrame:
    """A positive whole number for each alert of a batch, in the order of ids.

    It follows from the batch's number and its rows alone, so a batch that is run again gives the same keys, and
    no two batches share one.  ``alert_id`` is unique within the batch.
    """
    placed = numbered(alerts, [], "_place", "alert_id", "alert_id")
    key = (F.lit(batch_id) * KEYS_OF_A_BATCH + F.col("_place") + 1).cast("long")
    return placed.withColumn(out, key).drop("_place")


def write_keyed_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """Write one batch of (alert_id, alert, txn) rows; alerts have ``alert_key`` and their transactions refer to it."""
    spark = rows.sparkSession
    rows = rows.persist()
    try:
        parents, children = split_alert_rows(rows)
        target = f"{path}/{ALERTS}/batch_id={batch_id}"
        with_generated_keys(parents, batch_id).write.mode("overwrite").parquet(target)
        keys = spark.read.parquet(target).select("alert_id", "alert_key")
        children.join(keys, "alert_id").write.mode("overwrite").parquet(f"{path}/{TRANSACTIONS}/batch_id={batch_id}")
    finally:
        rows.unpersist()


def keyed_alert_sink(path: str) -> Callable[[DataFrame, int], None]:
    return lambda rows, batch_id: write_keyed_batch(rows, batch_id, path)


# --- Folders ----------------------------------------------------------------------


class Stored(NamedTuple):
    name: str
    first: int
    last: int


def file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def stored_folders(spark: SparkSession, table: str) -> list[Stored]:
    """The committed folders of a table."""
    files, root = file_system(spark, table)
    if not files.exists(root):
        return []
    found = []
    for status in files.listStatus(root):
        match = FOLDER.match(status.getPath().getName())
        if match and files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            one, low, high = match.groups()
            found.append(Stored(match.group(), int(one or low or 0), int(one or high or 0)))
    return found


def chosen_folders(folders: Iterable[Stored]) -> list[Stored]:
    """The widest folders that together hold each batch once.

    Compactions are made of whole folders, so two folders are apart or one covers the other.
    """
    chosen: list[Stored] = []
    for folder in sorted(folders, key=lambda f: (f.first, -f.last)):
        if not chosen or folder.first > chosen[-1].last:
            chosen.append(folder)
    return chosen


def read_table(spark: SparkSession, path: str, name: str = ALERTS) -> DataFrame:
    """A table of the store as it is now: a later compaction does not change what this frame reads."""
    table = f"{path}/{name}"
    folders = chosen_folders(stored_folders(spark, table))
    if not folders:
        raise FileNotFoundError(f"no batches in {table}")
    return spark.read.parquet(*[f"{table}/{f.name}" for f in folders])


# --- Compaction --------------------------------------------------------------------


def compact(spark: SparkSession, path: str, name: str = ALERTS, through: int | None = None, order: str = "alert_id") -> Stored | None:
    """Write the batches up to ``through`` (all but the newest if None) as one folder, in ranges of ``order``.

    Only the newest batch of a stream can still be written again.  Readers go on with the old folders until the new one
    is committed; a compaction that failed leaves a folder without a marker, which the next one overwrites.
    """
    table = f"{path}/{name}"
    folders = chosen_folders(stored_folders(spark, table))
    newest = max((f.last for f in folders), default=-1)
    closed = [f for f in folders if f.last <= (newest - 1 if through is None else min(through, newest - 1))]
    if len(closed) < 2:
        return None
    made = Stored(f"batches={closed[0].first}-{closed[-1].last}", closed[0].first, closed[-1].last)
    rows = spark.read.parquet(*[f"{table}/{f.name}" for f in closed])
    rows.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").parquet(f"{table}/{made.name}")
    return made


def vacuum(spark: SparkSession, path: str, name: str = ALERTS) -> list[str]:
    """Delete the folders that a wider one covers; call it when no reader of before the compaction is left."""
    table = f"{path}/{name}"
    folders = stored_folders(spark, table)
    kept = {f.name for f in chosen_folders(folders)}
    gone = [f.name for f in folders if f.name not in kept]
    for folder in gone:
        files, place = file_system(spark, f"{table}/{folder}")
        files.delete(place, True)
    return gone
