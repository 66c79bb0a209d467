"""The scoring buffer: batches by size, by timer, over a restart; and several sources under one watermark."""

import json
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import at
from fraudlens.sources import files
from fraudlens.streaming import alert_stream as st, batched_scoring as bs, multiplex as mx

FAR = "2099-01-01T00:00:00+00:00"


def event(i, actor, time, domain="gaming", amount=10):
    return json.dumps(
        {
            "transaction_id": f"T{i}", "domain": domain, "test_id": "t", "actor_id": actor, "timestamp": time, "amount": amount,
            "currency": "USD", "ip_address": "1.1.1.1", "pattern": "fraud_velocity_spike", "is_fraud": True, "sequence_position": 0,
        }
    )


def some_scored(windows):
    """A scorer that answers for actors with an even number only."""
    even = windows.filter(F.expr("CAST(substring(actor_id, 2) AS INT) % 2 = 0"))
    return even.withColumns({"fraud_score": F.lit(85), "model_version": F.lit("v"), "inference_time_ms": F.lit(3)})


class Job:
    """A batched job over a folder of JSON lines, whose released windows are kept in memory."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.rows, self.query = spark, folder, [], None
        (folder / "in").mkdir()

    def feed(self, name, lines):
        (self.folder / f"{name}.tmp").write_text("\n".join(lines))
        (self.folder / f"{name}.tmp").rename(self.folder / "in" / f"{name}.json")

    def start(self, **options):
        raw = files.event_stream(self.spark, str(self.folder / "in"), source="text")

        def sink(scored, batch_id):
            self.rows.extend((batch_id, r) for r in scored.collect())

        self.query = bs.start_batched_job(
            st.transactions_of(raw), some_scored, sink, str(self.folder / "ck"), lanes=1, trigger={"processingTime": "200 milliseconds"}, **options
        )

    def until(self, done, seconds=90):
        bs.wait_until(self.query, done, seconds)

    def closed(self):
        """The windows up to the last file's have closed and been taken up."""
        progress = self.query.lastProgress
        return progress is not None and progress.eventTime.get("watermark", "") > "2098"

    def sizes(self):
        return sorted({(r.flush_id, r.flush_size, r.flush_reason) for _, r in self.rows}, key=str)


@pytest.fixture
def job(spark, tmp_path):
    made = Job(spark, tmp_path)
    yield made
    if made.query is not None:
        made.query.stop()


def test_full_batches_leave_at_once_and_the_rest_on_the_timer(job):
    job.feed("a", [event(i, f"A{i}", "2025-01-15T10:00:05+00:00") for i in range(7)] + [event(99, "A99", FAR)])
    job.start(batch_size=3, flush_ms=1500)
    job.until(lambda: len(job.rows) == 7)
    assert sorted(s[1:] for s in job.sizes()) == [(1, "interval"), (3, "size"), (3, "size")]
    first = min(b for b, r in job.rows)
    assert {b for b, r in job.rows if r.flush_reason == "size"} == {first}
    assert all(b > first for b, r in job.rows if r.flush_reason == "interval")
    scores = {r.actor_id: (r.fraud_score, r.model_version) for _, r in job.rows}
    assert scores["A2"] == (85, "v") and scores["A3"] == (0, "error") and len(scores) == 7
    # the buffer is empty now, and an idle job releases nothing more
    job.until(lambda: bs.is_drained(job.query, "2098"))
    time.sleep(1)
    assert len(job.rows) == 7


def test_values_pass_the_buffer_unchanged(job):
    job.feed("a", [event(i, "A4", f"2025-01-15T10:00:0{i}.123456+00:00", amount=0.1) for i in range(3)] + [event(99, "A99", FAR)])
    job.start(batch_size=100, flush_ms=300)
    job.until(lambda: job.rows)
    (_, row), = job.rows
    assert row.window_start.replace(tzinfo=None) == at("2025-01-15T10:00:00").replace(tzinfo=None)
    assert str(row.total_amount) == "0.30" and row.transaction_count == 3 and row.fraud_patterns == ["fraud_velocity_spike"]
    assert row.first_txn.transaction_id == "T0" and row.last_timestamp.microsecond == 123456 and row.first_country_from is None


def test_a_restart_goes_on_with_what_was_waiting(job):
    job.feed("a", [event(i, f"A{i}", "2025-01-15T10:00:05+00:00") for i in range(4)] + [event(99, "A99", FAR)])
    job.start(batch_size=3, flush_ms=600_000)
    job.until(lambda: len(job.rows) == 3 and job.closed())
    time.sleep(1)
    job.query.stop()
    assert len(job.rows) == 3  # the fourth waits in the state
    job.start(batch_size=3, flush_ms=600_000)
    job.feed("b", [event(50 + i, f"A{50 + i}", "2099-01-01T00:10:00+00:00") for i in range(2)] + [event(98, "A98", "2199-01-01T00:00:00+00:00")])
    job.until(lambda: len(job.rows) == 6)
    assert {s[1:] for s in job.sizes()} == {(3, "size")}
    # with the one from before the restart there are four more: three left, one waits
    left = {r.actor_id for _, r in job.rows}
    assert {"A0", "A1", "A2", "A3"} <= left and len(left) == 6


# --- Several sources -------------------------------------------------------------


class Sources:
    def __init__(self, spark, folder, names):
        self.spark, self.folder, self.names = spark, folder, names
        for n in names:
            (folder / n).mkdir()

    def feed(self, source, name, lines):
        (self.folder / f"{source}-{name}.tmp").write_text("\n".join(lines))
        (self.folder / f"{source}-{name}.tmp").rename(self.folder / source / f"{name}.json")

    def start(self, trigger):
        raw = {n: files.event_stream(self.spark, str(self.folder / n), source="text") for n in self.names}
        merged = mx.multiplexed({n: st.transactions_of(r) for n, r in raw.items()}, str(self.folder / "beats"))
        closed = st.tumbling_windows(merged, "1 minute", "event_time").select("actor_id", "window_start", "transaction_count", "domain")
        writer = closed.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(self.folder / "ck"))
        return writer.trigger(**trigger).start(str(self.folder / "out"))

    def run(self):
        self.start({"availableNow": True}).awaitTermination()

    def windows(self):
        return sorted((r.actor_id, r.transaction_count) for r in self.spark.read.parquet(str(self.folder / "out")).collect())


def test_a_source_behind_loses_nothing(spark, tmp_path):
    s = Sources(spark, tmp_path, ["gaming", "fintech"])
    s.feed("gaming", "a", [event(1, "A1", "2025-01-15T12:00:00+00:00"), event(2, "A2", "2025-01-15T10:00:30+00:00")])
    s.feed("fintech", "a", [event(3, "A3", "2025-01-15T10:00:10+00:00", "fintech")])
    query = s.start({"processingTime": "200 milliseconds"})
    try:
        query.processAllAvailable()
        assert s.windows() == []  # fintech is at 10:00: nothing may close, although gaming is at 12:00
        s.feed("fintech", "b", [event(4, "A3", "2025-01-15T10:00:40+00:00", "fintech"), event(5, "A3", "2025-01-15T10:05:00+00:00", "fintech")])
        bs.wait_until(query, lambda: s.windows() == [("A2", 1), ("A3", 2)])
    finally:
        query.stop()
    # after a restart both have to be heard again before anything closes
    s.feed("fintech", "c", [event(6, "A3", "2025-01-15T11:00:00+00:00", "fintech")])
    s.run()
    assert s.windows() == [("A2", 1), ("A3", 2)]
    mx.beat(spark, str(tmp_path / "beats"), ["gaming"], at("2025-01-15T12:00:00"))
    s.feed("fintech", "d", [event(7, "A7", "2025-01-15T11:00:10+00:00", "fintech")])
    s.run()
    assert s.windows() == [("A2", 1), ("A3", 1), ("A3", 2)]


def test_a_silent_source_is_moved_and_holds_nothing_up(spark, tmp_path):
    s = Sources(spark, tmp_path, ["gaming", "fintech", "ecommerce"])
    ticks = [0.0]
    idle = mx.IdleSources(s.names, idle_seconds=60, clock=lambda: ticks[0])
    s.feed("gaming", "a", [event(1, "A1", "2025-01-15T10:00:05+00:00"), event(2, "A2", "2025-01-15T10:10:00+00:00")])
    s.feed("fintech", "a", [event(3, "A3", "2025-01-15T10:00:07+00:00", "fintech"), event(4, "A4", "2025-01-15T10:08:00+00:00", "fintech")])
    query = s.start({"processingTime": "200 milliseconds"})
    try:
        bs.wait_until(query, lambda: query.lastProgress is not None and query.lastProgress.batchId >= 0 and query.recentProgress[0].numInputRows > 0)
        assert idle.attend(query, str(tmp_path / "beats"), spark) == []  # not yet idle for long enough
        assert s.windows() == []  # ecommerce has said nothing
        ticks[0] = 50.0
        idle.heard["gaming"] = idle.heard["fintech"] = 50.0
        ticks[0] = 61.0
        assert idle.attend(query, str(tmp_path / "beats"), spark) == ["ecommerce"]
        assert idle.newest["ecommerce"] == idle.newest["fintech"]  # no further than the slowest that speaks
        bs.wait_until(query, lambda: s.windows() == [("A1", 1), ("A3", 1)])
        assert idle.attend(query, str(tmp_path / "beats"), spark) == []  # moved as far as it may
        s.feed("ecommerce", "a", [event(6, "A6", "2025-01-15T10:08:30+00:00", "ecommerce")])
        bs.wait_until(query, lambda: any(p.numInputRows and p.batchId > 1 for p in query.recentProgress[-3:]) or query.lastProgress.batchId > 6)
    finally:
        query.stop()
    mx.beat(spark, str(tmp_path / "beats"), s.names, at("2026-01-01T00:00:00"))
    s.run()
    assert s.windows() == [("A1", 1), ("A2", 1), ("A3", 1), ("A4", 1), ("A6", 1)]


def test_no_source_speaks_and_all_are_idle():
    ticks = [0.0]
    idle = mx.IdleSources(["a", "b"], 10, lambda: ticks[0])
    ticks[0] = 100.0
    assert idle.to_move() == ([], None)
    idle.newest["a"] = at("2025-01-01T00:00:00")
    assert idle.to_move() == ([], None)  # a has been heard of, but is idle as well
    idle.heard["a"] = 99.0
    assert idle.to_move() == (["b"], at("2025-01-01T00:00:00"))
    idle.newest["b"] = at("2025-01-01T00:00:00") + timedelta(seconds=1)
    assert idle.to_move() == ([], at("2025-01-01T00:00:00"))


def test_lanes_follow_the_rows():
    """A lane is read by one task, so ten times the rows make ten times the lanes; small jobs keep what they had."""
    assert bs.lanes_for(0, 4) == bs.lanes_for(100_000, 4) == 4
    assert bs.lanes_for(6_000_000, 4) == 240 and bs.lanes_for(60_000_000, 4) == 2400
    assert bs.lanes_for(1) == bs.LANES
