import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, at
from fraudlens.sources import adapters, files, sinks
from fraudlens.streaming import alert_stream as st

FAR = "2099-01-01T00:00:00Z"  # a last record that closes every window before it


def event(i, actor, time, amount=10, **more):
    return json.dumps(
        {
            "transaction_id": f"T{i}", "domain": "gaming", "test_id": "t", "actor_id": actor, "timestamp": time,
            "amount": amount, "currency": "USD", "ip_address": "1.1.1.1", "pattern": "fraud_velocity_spike",
            "is_fraud": True, "sequence_position": 0, **more,
        }
    )


def score_by_actor(windows):
    return windows.withColumns(
        {
            "fraud_score": F.when(F.col("actor_id") == "fraud_actor", 95).otherwise(30),
            "model_version": F.lit("v"),
            "inference_time_ms": F.lit(1),
        }
    )


@pytest.fixture
def run(spark, tmp_path):
    """Feed lists of lines as successive files; one micro-batch per file."""
    (tmp_path / "in").mkdir()

    def feed(*batches, scorer=score_by_actor, trigger=None):
        for lines in batches:
            n = len(list((tmp_path / "in").iterdir()))
            (tmp_path / "in" / f"{n:03d}.json").write_text("\n".join(lines))
            raw = files.event_stream(spark, str(tmp_path / "in"), source="text", maxFilesPerTrigger="1")
            rows = st.alert_rows(st.transactions_of(raw), scorer)
            job = st.start_alert_job(
                rows, sinks.parquet_alert_sink(str(tmp_path / "out")), str(tmp_path / "ck"), {"availableNow": True}
            )
            job.awaitTermination()
        return (
            spark.read.parquet(str(tmp_path / "out/fraud_alerts")),
            spark.read.parquet(str(tmp_path / "out/suspicious_transactions")),
        )

    return feed


BURST = [event(i, "fraud_actor", f"2025-01-15T10:00:{s}Z", a) for i, (s, a) in enumerate((("05", 500), ("15", 600), ("25", 700)))]


def test_burst_among_bad_records_and_low_scores(run):
    alerts, children = run(
        BURST + ["{broken", "", event(8, "calm_actor", "2025-01-15T10:00:10Z")], [event(9, "calm_actor", FAR)]
    )
    (alert,) = alerts.collect()
    assert (alert["actor_id"], alert["transaction_count"], float(alert["total_amount"])) == ("fraud_actor", 3, 1800.0)
    assert alert["alert_type"] == "velocity_spike" and alert["severity"] == "CRITICAL"
    assert sorted(r["transaction_id"] for r in children.collect()) == ["T0", "T1", "T2"]


def test_window_split_over_batches_and_restart(run):
    """Each file is a new start of the job from its checkpoint."""
    alerts, children = run(BURST[:1], BURST[1:], [event(9, "x", FAR)])
    assert alerts.first()["transaction_count"] == 3 and children.count() == 3


def test_late_rows(run):
    """A row behind the watermark of the batch before it is dropped, from both tables."""
    late = event(5, "fraud_actor", "2025-01-15T10:00:40Z", 1)
    alerts, children = run(BURST, [event(6, "x", "2025-01-15T12:00:00Z")], [late], [event(9, "x", FAR)])
    assert alerts.first()["transaction_count"] == 3 and alerts.count() == 1
    assert children.count() == 3


def test_out_of_order_within_the_delay(run):
    """Behind the newest event by less than the delay: counted."""
    newer = event(5, "x", "2025-01-15T10:01:20Z")
    late = event(6, "fraud_actor", "2025-01-15T10:00:55Z", 1)
    alerts, children = run(BURST + [newer], [late], [event(9, "x", FAR)])
    assert alerts.first()["transaction_count"] == 4 and children.count() == 4


def test_repeated_transaction_ids_are_kept(run):
    alerts, children = run([BURST[0], BURST[0]], [event(9, "x", FAR)])
    assert alerts.count() == 1 and alerts.first()["transaction_count"] == 2 and children.count() == 2


def test_stream_equals_batch(spark, tmp_path):
    counters = st.ProgressCounters()
    spark.streams.addListener(counters)
    events = files.parquet_stream(spark, SMALL, adapters.EVENTS_SCHEMA, "events.parquet")
    rows = st.alert_rows(adapters.transactions_from(events), adapters.rule_scorer, "6 hours")
    job = st.start_alert_job(
        rows, sinks.parquet_alert_sink(str(tmp_path / "out")), str(tmp_path / "ck"), {"availableNow": True}
    )
    job.awaitTermination()
    tx = adapters.transactions(spark, SMALL)
    newest = tx.agg(F.max("timestamp")).first()[0]
    parents, children = sinks.split_alert_rows(st.alert_rows(tx, adapters.rule_scorer, "6 hours"))
    parents = parents.filter(F.col("last_seen") <= F.lit(newest - timedelta(seconds=30)))
    children = children.join(parents.select("alert_id"), "alert_id", "left_semi")
    for name, expected in (("fraud_alerts", parents), ("suspicious_transactions", children)):
        got = spark.read.parquet(str(tmp_path / "out" / name)).drop("batch_id").select(*expected.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    spark.streams.removeListener(counters)
    assert counters.totals["passed"] >= parents.count() > 0
    assert counters.totals["late_rows"] == 0 and counters.totals["rows_in"] > 0


def test_state_on_disk(spark, run):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    try:
        st.keep_state_on_disk(spark)
        alerts, children = run(BURST, [event(9, "x", FAR)])
        assert alerts.count() == 1 and children.count() == 3
    finally:
        spark.conf.set(name, before)


def test_salts_do_not_change_the_result(make_tx):
    tx = make_tx([{"timestamp": at("2025-01-15T10:00:00") + timedelta(seconds=i), "actor_id": "fraud_actor"} for i in range(50)])
    for salts in (1, 16):
        parents, children = sinks.split_alert_rows(st.alert_rows(tx, score_by_actor, salts=salts))
        assert parents.first()["transaction_count"] == 50
        assert parents.count() == 1 and children.select("transaction_id").distinct().count() == 50


def test_join_keys_of_an_alert_are_those_its_transactions_have(make_tx):
    """One transaction needs one of the 16 keys; those of a burst still all arrive, the alert on one key's rows."""
    tx = make_tx([{"timestamp": at("2025-01-15T10:00:00") + timedelta(seconds=i), "actor_id": "fraud_actor"} for i in range(3)]
                 + [{"timestamp": at("2025-01-15T11:00:00"), "actor_id": "fraud_actor"}])
    seen = []

    def scorer(windows):
        seen.append(windows.select("transaction_count", "_salts"))
        return score_by_actor(windows)

    rows = st.alert_rows(tx, scorer).collect()
    assert len(rows) == 4 and len({r["alert_id"] for r in rows}) == 2 and {r["alert_id"] for r in rows if r["alert"]} == {r["alert_id"] for r in rows}
    keys = {r["transaction_count"]: sorted(r["_salts"]) for r in seen[0].collect()}
    assert len(keys[1]) == 1 and 1 <= len(keys[3]) <= 3


def test_whole_job_keeps_damaged_records_and_closes_the_last_window(spark, tmp_path):
    """No later record comes, yet the burst's window leaves; every record is landed or quarantined."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("\n".join([*BURST, "{broken", event(7, None, "2025-01-15T10:00:10Z")]))
    raw = files.event_stream(spark, str(tmp_path / "in"), source="text")
    out = str(tmp_path / "out")
    st.run_alert_job(raw, score_by_actor, sinks.parquet_alert_sink(out), out)
    (alert,) = spark.read.parquet(f"{out}/fraud_alerts").collect()
    assert alert["transaction_count"] == 3
    assert spark.read.parquet(f"{out}/suspicious_transactions").count() == 3
    assert st.landed(spark, f"{out}/landed").count() == 3
    rejects = {r["reject_reason"]: r["raw"] for r in st.quarantine(spark, f"{out}/landed").collect()}
    assert set(rejects) == {"malformed", "missing_actor"} and rejects["malformed"] == "{broken"


def test_state_of_the_join_is_one_store_a_partition_and_holds_transactions_only(spark, tmp_path):
    """A store has a price whatever it holds; alerts meet what is stored and are not stored themselves."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("\n".join([*BURST, event(9, "x", FAR)]))
    raw = files.event_stream(spark, str(tmp_path / "in"), source="text")
    rows = st.alert_rows(st.transactions_of(raw), score_by_actor)
    job = st.start_alert_job(rows, sinks.parquet_alert_sink(str(tmp_path / "out")), str(tmp_path / "ck"), {"availableNow": True})
    job.awaitTermination()
    joins = [o for p in job.recentProgress for o in p.stateOperators if o.operatorName == "symmetricHashJoin"]
    assert {o.numStateStoreInstances for o in joins} == {int(spark.conf.get("spark.sql.shuffle.partitions"))}
    assert sum(o.numRowsUpdated for o in joins) == 4 and sum(o.numRowsRemoved for o in joins) == 3
    assert spark.read.parquet(str(tmp_path / "out/suspicious_transactions")).count() == 3


def test_rows_are_counted_where_a_job_asks_for_the_count(spark):
    """The batched job ends when no row waits, so it must not be told zero for want of counting."""
    name = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    st.keep_state_on_disk(spark, count_rows=False)
    assert spark.conf.get(name) == "false"
    st.keep_state_on_disk(spark)
    assert spark.conf.get(name) == "true"


def test_whole_job_starts_once(spark, tmp_path):
    """One micro-batch reads what has landed with the closing transaction, and one closes the windows."""
    (tmp_path / "in").mkdir()
    for n, line in enumerate([*BURST, event(5, "x", "2025-01-17T10:00:00Z"), event(6, "fraud_actor", "2025-01-15T10:00:50Z", 1)]):
        (tmp_path / f"in/{n}.json").write_text(line)
    raw = files.event_stream(spark, str(tmp_path / "in"), source="text", maxFilesPerTrigger="1")
    out = tmp_path / "out"
    st.run_alert_job(raw, score_by_actor, sinks.parquet_alert_sink(str(out)), str(out))
    (alert,) = spark.read.parquet(f"{out}/fraud_alerts").collect()
    assert alert["transaction_count"] == 4 and spark.read.parquet(f"{out}/suspicious_transactions").count() == 4
    assert sorted(p.name for p in (out / "alert_checkpoint/commits").iterdir() if p.name.isdigit()) == ["0", "1"]


def test_whole_job_without_an_end(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("\n".join(BURST))
    raw = files.event_stream(spark, str(tmp_path / "in"), source="text")
    out = str(tmp_path / "out")
    landing, job = st.start_jobs(raw, score_by_actor, sinks.parquet_alert_sink(out), out, trigger={"processingTime": "1 second"})
    try:
        for name, lines in (("b", [event(8, "x", FAR)]), ("c", [event(9, "x", FAR)])):
            landing.processAllAvailable()
            job.processAllAvailable()
            (tmp_path / f"in/{name}.json").write_text("\n".join(lines))
        landing.processAllAvailable()
        job.processAllAvailable()
    finally:
        landing.stop()
        job.stop()
    assert spark.read.parquet(f"{out}/fraud_alerts").first()["transaction_count"] == 3


def test_records_of_the_json_job_are_compressed_and_cut(spark, tmp_path, monkeypatch):
    """As text they are several times the table; files that cannot be cut hold a task's work each, and all records are there."""
    from fraudlens.plans import queries

    monkeypatch.setattr(queries, "fresh_path", lambda *_: str(tmp_path))
    monkeypatch.setattr(queries, "RECORDS_A_FILE", 300)
    monkeypatch.setattr(queries.alert_stream, "run_alert_job", lambda *_: None)
    queries._run_json_job(spark, SMALL)
    files = [f.name for f in (tmp_path / "records").glob("part-*")]
    records = adapters.raw_events(spark, SMALL)
    assert all(f.endswith(".gz") for f in files) and len(files) >= records.count() / 300
    assert sorted(spark.read.text(f"{tmp_path}/records").collect()) == sorted(records.collect())
    st.keep_state_on_disk(spark)
    assert spark.conf.get("spark.sql.streaming.stateStore.compression.codec") == "zstd"
