"""Windows scored in batches: a keyed operator with a buffer, a count flush and a time flush.

Windows that have closed wait in the state of one of ``lanes`` buffers.  A buffer that holds ``batch_size``
windows releases them at once; one that holds fewer releases what it has when the oldest has waited ``flush_ms`` of
processing time, whether or not more windows arrive.  Released windows go through the scorer together, and one
without a prediction scores 0 with version ``error``.

The buffer is a list state of at most ``batch_size - 1`` rows and a value state with the time of the next flush, both
empty while nothing waits; they and the timers live in the state store and so in the checkpoint.  A restart goes on
with what was waiting; a micro-batch that is run again releases again what its first attempt released.
A lane's rows are read as they come and leave in batches, so a lane's size costs no memory.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fraudlens.operators.alerts import attach_predictions
from fraudlens.schema import WATERMARK_DELAY, WINDOW_DURATION
from fraudlens.streaming.alert_stream import Scorer, keep_state_on_disk, windows_of

BATCH_SIZE, FLUSH_MS, LANES = 100, 5000, 16

# Rows that one lane is given; a lane is a key, so one task reads all of it.
LANE_ROWS = 25_000

RELEASED = "flush_id string, flush_size int, flush_reason string, packed string"

# Values go through the buffer as JSON; times keep their microseconds.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class ScoringBuffer(StatefulProcessor):
    """Rows of one lane, released in batches."""

    def __init__(self, batch_size: int = BATCH_SIZE, flush_ms: int = FLUSH_MS):
        self.batch_size, self.flush_ms = batch_size, flush_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "packed string")
        self.due = handle.getValueState("due", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, full = timerValues.getCurrentProcessingTimeInMs(), 0
        held = self._held()
        for frame in rows:
            held.extend(frame["packed"])
            while len(held) >= self.batch_size:
                yield self._batch(key, now, full, held[: self.batch_size], "size")
                held, full = held[self.batch_size :], full + 1
        if full:
            self._no_flush()
        if held:
            self.waiting.put([(row,) for row in held])
            if not self.due.exists():
                self.due.update((now + self.flush_ms,))
                self.handle.registerTimer(now + self.flush_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        if held:
            # after the batches that the same micro-batch released by size
            yield self._batch(key, timerValues.getCurrentProcessingTimeInMs(), 1 << 30, held, "interval")
        self.waiting.clear()
        self.due.clear()

    def close(self) -> None:
        pass

    def _held(self) -> list[str]:
        return [row[0] for row in self.waiting.get()] if self.waiting.exists() else []

    def _no_flush(self) -> None:
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
            self.due.clear()
        self.waiting.clear()

    def _batch(self, key, now: int, number: int, rows: list[str], reason: str) -> pd.DataFrame:
        flush = f"{key[0]}-{now}-{number}"
        return pd.DataFrame({"flush_id": flush, "flush_size": len(rows), "flush_reason": reason, "packed": rows})


FLUSH = ["flush_id", "flush_size", "flush_reason"]


def lanes_for(rows: int, least: int = LANES) -> int:
    """Lanes for a micro-batch of ``rows`` rows at most, so that a larger one is read by more tasks.

    A job keeps the number it was started with: lanes are the keys of its state.
    """
    return max(least, -(-rows // LANE_ROWS))


def released_batches(
    windows: DataFrame, batch_size: int = BATCH_SIZE, flush_ms: int = FLUSH_MS, lanes: int = LANES
) -> DataFrame:
    """The windows of a stream as they are released, with ``flush_id, flush_size, flush_reason``.

    One micro-batch releases whole batches, so whoever reads it sees all rows of a batch together.  The id is
    made of the lane, the micro-batch's logged time and a number, so a repeated micro-batch gives the same.
    """
    keep_state_on_disk(windows.sparkSession)
    kinds = T.StructType([f for f in windows.schema])
    lane = F.pmod(F.xxhash64("alert_id"), F.lit(lanes)).cast("int")
    packed = windows.select(lane.alias("lane"), F.to_json(F.struct(*windows.columns), JSON).alias("packed"))
    out = packed.groupBy("lane").transformWithStateInPandas(
        ScoringBuffer(batch_size, flush_ms), RELEASED, outputMode="Append", timeMode="ProcessingTime"
    )
    row = F.from_json("packed", kinds, JSON).alias("row")
    return out.select(*FLUSH, row).select(*FLUSH, "row.*")


def score_batch(windows: DataFrame, scorer: Scorer) -> DataFrame:
    """Score the windows of one micro-batch; those the scorer leaves out score 0, version ``error``."""
    found = scorer(windows).select("actor_id", "window_start", "fraud_score", "model_version", "inference_time_ms")
    return attach_predictions(windows, found)


def start_batched_job(
    tx: DataFrame,
    scorer: Scorer,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    duration: str = WINDOW_DURATION,
    delay: str = WATERMARK_DELAY,
    batch_size: int = BATCH_SIZE,
    flush_ms: int = FLUSH_MS,
    lanes: int = LANES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Release, score and hand the scored windows of every micro-batch to ``sink(scored, batch_id)``.

    The sink is called for micro-batches that release nothing too.
    """
    windows = windows_of(tx, duration, delay).drop("window")
    released = released_batches(windows, batch_size, flush_ms, lanes)

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            sink(score_batch(rows, scorer), batch_id)
        finally:
            rows.unpersist()

    return (
        released.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .foreachBatch(write)
        .start()
    )


def is_drained(query: StreamingQuery, watermark: str) -> bool:
    """Whether a job has seen all up to ``watermark`` (UTC, ISO-8601) and no window waits in a buffer."""
    progress = query.lastProgress
    if progress is None or progress.numInputRows or progress.eventTime.get("watermark", "") < watermark:
        return False
    return all(o.numRowsTotal == 0 and o.numRowsUpdated == 0 for o in progress.stateOperators if o.operatorName.startswith("transformWithState"))


def wait_until(query: StreamingQuery, done: Callable[[], bool], seconds: float = 120) -> None:
    """Let a running job go on until ``done()``; raises what ended it, or if that takes too long.

    A job with processing-time timers plans a micro-batch at every trigger, so waiting for "no more data" would not end.
    """
    until = time.monotonic() + seconds
    while not done():
        if query.exception() is not None:
            raise query.exception()
        if time.monotonic() > until:
            raise TimeoutError("the job did not get there in time")
        time.sleep(0.1)
