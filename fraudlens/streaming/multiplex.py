"""Several event streams as one, each with its own watermark.

The watermark of the whole is the least of the sources' (Spark's ``min`` policy), so a source that is behind loses no rows.
A source that is silent would hold all windows open.  ``IdleSources`` hears that it is, and moves its watermark with a
heartbeat: a row that carries nothing but a time, no later than what the sources that speak have reached.
When the source speaks again, its rows are judged by the watermark like any others.  After a restart every source
has to be heard or moved again before more windows close: the checkpoint holds the least watermark, not each one.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from fraudlens.schema import WATERMARK_DELAY

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
HEARTBEAT = T.StructType([T.StructField("event_time", T.TimestampType())])


def heartbeat_folder(folder: str, source: str) -> str:
    return f"{folder.rstrip('/')}/source={source}"


def beat(spark: SparkSession, folder: str, sources: Iterable[str], upto: datetime) -> None:
    """Tell the stream that these sources have nothing before ``upto``."""
    for source in sources:
        row = spark.createDataFrame([(upto,)], HEARTBEAT)
        row.coalesce(1).write.mode("append").parquet(heartbeat_folder(folder, source))


def multiplexed(sources: dict[str, DataFrame], folder: str, delay: str = WATERMARK_DELAY) -> DataFrame:
    """The transactions of all sources with ``event_time``, under one watermark.

    Sources may lack columns that others have.  Each reports ``rows`` and ``newest`` under its name in the
    progress of the query; heartbeats are read from ``folder``.
    """
    parts = []
    for name, tx in sources.items():
        spark = tx.sparkSession
        spark.createDataFrame([], HEARTBEAT).write.mode("ignore").parquet(heartbeat_folder(folder, name))
        beats = spark.readStream.schema(HEARTBEAT).parquet(heartbeat_folder(folder, name))
        heard = tx.withColumn("event_time", F.col("timestamp")).observe(
            f"source_{name}", F.count("*").alias("rows"), F.unix_micros(F.max("event_time")).alias("newest")
        )
        parts.append(
            heard.withColumn("_beat", F.lit(False))
            .unionByName(beats.withColumn("_beat", F.lit(True)), allowMissingColumns=True)
            .withWatermark("event_time", delay)
        )
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # Naming the event time keeps this filter above the watermarks, which the heartbeats must reach.
    return merged.filter(~F.col("_beat") | F.col("event_time").isNull()).drop("_beat")


class IdleSources:
    """Which sources have been silent for ``idle_seconds`` while others went on."""

    def __init__(
        self, names: Iterable[str], idle_seconds: float = 60, clock: Callable[[], float] = time.monotonic
    ):
        self.idle_seconds, self.clock = idle_seconds, clock
        self.heard = dict.fromkeys(names, clock())
        self.newest: dict[str, datetime] = {}
        self.last_batch: tuple | None = None

    def hear(self, observed: dict[str, Row]) -> None:
        """What one micro-batch read, from ``observedMetrics`` of its progress."""
        now = self.clock()
        for name in self.heard:
            row = observed.get(f"source_{name}")
            if row is not None and row["rows"]:
                self.heard[name] = now
                if row["newest"] is not None:
                    newest = EPOCH + timedelta(microseconds=row["newest"])
                    self.newest[name] = max(newest, self.newest.get(name, newest))

    def to_move(self) -> tuple[list[str], datetime | None]:
        """The idle sources to move and the time they may move to: the least of what the others have reached."""
        now = self.clock()
        idle = [n for n, at in self.heard.items() if now - at >= self.idle_seconds]
        speaking = [self.newest[n] for n in self.heard if n not in idle and n in self.newest]
        if not speaking:
            return [], None
        upto = min(speaking)
        return [n for n in idle if n not in self.newest or self.newest[n] < upto], upto

    def attend(self, query: StreamingQuery, folder: str, spark: SparkSession) -> list[str]:
        """Read the newest progress of a running query and move the sources that are idle; returns their names.

        For a driver's loop, called about once a trigger.
        """
        for progress in query.recentProgress:
            seen = (progress.runId, progress.batchId)
            if self.last_batch is None or seen[0] != self.last_batch[0] or seen[1] > self.last_batch[1]:
                self.hear(progress.observedMetrics)
                self.last_batch = seen
        names, upto = self.to_move()
        if names:
            beat(spark, folder, names, upto)
            for name in names:
                self.newest[name] = upto
        return names
