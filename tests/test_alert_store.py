"""The alert store: generated keys, compaction that readers never see half done, velocity kept up to date."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import at
from fraudlens.operators import analytics
from fraudlens.schema import ALERT_COLUMNS, TRANSACTION_COLUMNS
from fraudlens.sources import alert_store as store
from fraudlens.streaming import live_velocity as live

START = at("2025-01-01T10:00:00.250000")


def batch(spark, rows):
    """(alert_id, seconds after START) to rows of (alert_id, alert, txn), two transactions an alert."""
    base = spark.createDataFrame(
        [(a, ["gaming", "fintech"][len(a) % 2], 60 + len(a), START + timedelta(seconds=s)) for a, s in rows],
        "alert_id string, domain string, fraud_score int, created_at timestamp",
    )
    alert = F.struct(*[F.col(c) if c in base.columns else F.lit(None).cast("string").alias(c) for c in ALERT_COLUMNS])
    txn = F.struct(*[
        (F.concat("alert_id", F.lit("-"), F.col("n").cast("string")) if c == "transaction_id" else F.lit(None).cast("string")).alias(c)
        for c in TRANSACTION_COLUMNS
    ])
    both = base.select("alert_id", alert.alias("alert"), F.explode(F.array(F.lit(0), F.lit(1))).alias("n"))
    return both.select("alert_id", F.when(F.col("n") == 0, F.col("alert")).alias("alert"), txn.alias("txn"))


def ids(frame):
    return sorted(r.alert_id for r in frame.collect())


def test_keys_follow_from_the_batch(spark, tmp_path):
    path = str(tmp_path)
    rows = [[(f"A{b}_{i}", i) for i in range(30)] for b in range(3)]
    for b, r in enumerate(rows):
        store.write_keyed_batch(batch(spark, r), b, path)
    before = {r.alert_id: r.alert_key for r in store.read_table(spark, path).collect()}
    assert len(before) == len(set(before.values())) == 90 and min(before.values()) == 1
    random.Random(1).shuffle(rows[1])
    store.write_keyed_batch(batch(spark, rows[1]).repartition(5), 1, path)  # run again, dealt otherwise
    assert {r.alert_id: r.alert_key for r in store.read_table(spark, path).collect()} == before
    children = store.read_table(spark, path, store.TRANSACTIONS).collect()
    assert len(children) == 180 and all(before[r.alert_id] == r.alert_key for r in children)
    store.write_keyed_batch(batch(spark, rows[0]).limit(0), 3, path)
    assert store.read_table(spark, path).count() == 90


@pytest.mark.parametrize("names, expected", [
    (["batch_id=0", "batch_id=1"], ["batch_id=0", "batch_id=1"]),
    (["batch_id=0", "batch_id=1", "batches=0-1", "batch_id=2"], ["batches=0-1", "batch_id=2"]),
    (["batches=0-1", "batch_id=2", "batches=0-2", "batch_id=0", "batch_id=9"], ["batches=0-2", "batch_id=9"]),
    ([], []),
])
def test_each_batch_is_read_once(names, expected):
    folders = []
    for n in names:
        one, low, high = store.FOLDER.match(n).groups()
        folders.append(store.Stored(n, int(one or low), int(one or high)))
    assert [f.name for f in store.chosen_folders(folders)] == expected


def test_readers_during_a_compaction(spark, tmp_path):
    path = str(tmp_path)
    everything = []
    for b in range(5):
        rows = [(f"A{b}_{i}", i) for i in range(4)]
        everything += [a for a, _ in rows]
        live.alert_sink_with_velocity(path)(batch(spark, rows), b)
    early = store.read_table(spark, path)
    # a compaction that is under way or has failed: its folder has files and no marker
    spark.read.parquet(f"{path}/fraud_alerts/batch_id=0").write.parquet(f"{path}/fraud_alerts/batches=0-3")
    (tmp_path / "fraud_alerts/batches=0-3/_SUCCESS").unlink()
    assert ids(store.read_table(spark, path)) == sorted(everything)
    made = store.compact(spark, path)
    assert made.name == "batches=0-3"  # the newest batch may still be run again
    assert ids(early) == ids(store.read_table(spark, path)) == sorted(everything)
    live.alert_sink_with_velocity(path)(batch(spark, [("A4_0", 0)]), 4)  # it is
    everything = [a for a in everything if not a.startswith("A4_")] + ["A4_0"]
    assert sorted(store.vacuum(spark, path)) == [f"batch_id={b}" for b in range(4)]
    assert ids(store.read_table(spark, path)) == sorted(everything)
    assert store.compact(spark, path) is None and store.vacuum(spark, path) == []
    live.alert_sink_with_velocity(path)(batch(spark, [("B", 1)]), 5)
    assert store.compact(spark, path).name == "batches=0-4"
    assert ids(store.read_table(spark, path)) == sorted([*everything, "B"])
    assert ids(store.read_table(spark, path, store.TRANSACTIONS)) == sorted([*everything, "B"] * 2)


def test_nothing_stored(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        store.read_table(spark, str(tmp_path))
    assert store.compact(spark, str(tmp_path)) is None and store.vacuum(spark, str(tmp_path)) == []


def equal_series(spark, path):
    alerts = store.read_table(spark, path)
    for seconds, trend in ((1, 1), (5, 1), (7, 3), (3600, 2)):
        want = sorted(map(tuple, analytics.velocity(alerts, seconds, trend).collect()), key=str)
        assert sorted(map(tuple, live.velocity_now(spark, path, seconds, trend).collect()), key=str) == want


def test_velocity_after_replays_and_an_earlier_alert(spark, tmp_path):
    path, rng = str(tmp_path), random.Random(3)
    sink = live.alert_sink_with_velocity(path)
    rows = [[(f"{'A' * rng.randint(1, 4)}{b}_{i}", round(rng.random() * 40, 6)) for i in range(25)] for b in range(3)]
    sink(batch(spark, []), 0)
    assert live.origins(spark, path) == []
    for b in (1, 2, 1):
        sink(batch(spark, rows[b - 1]), b)
    equal_series(spark, path)
    store.compact(spark, path)
    before = live.origins(spark, path)[0]
    sink(batch(spark, [*rows[2], ("early", -100.123456)]), 3)  # seconds now begin elsewhere
    assert live.origins(spark, path)[0] < before - 90 * live.SECOND
    equal_series(spark, path)
    sink(batch(spark, [*rows[2], ("early", -100.123456)]), 3)
    sink(batch(spark, [("late", 5000.5)]), 4)
    equal_series(spark, path)
