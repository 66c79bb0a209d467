from datetime import datetime

from pyspark.sql import functions as F

import pytest

from fraudlens.functions import parsing
from fraudlens.operators import labels as lb
from fraudlens.schema import LABEL_SCHEMA
from fraudlens.sources import files, sinks
from fraudlens.streaming import alert_stream


def score_all(windows):
    return windows.withColumns(
        {"fraud_score": F.lit(80), "model_version": F.lit("v"), "inference_time_ms": F.lit(1)}
    )


@pytest.fixture(scope="module")
def rows(make_tx):
    """Two alerts of one actor, with two and three transactions."""
    times = ["10:00:01", "10:00:02", "11:00:01", "11:00:02", "11:00:03"]
    tx = make_tx([{"timestamp": f"2025-01-15T{t}", "amount": 999999.99} for t in times])
    return alert_stream.alert_rows(tx, score_all)


def counts(spark, path):
    return (
        spark.read.parquet(f"{path}/fraud_alerts").count(),
        spark.read.parquet(f"{path}/suspicious_transactions").count(),
    )


def test_parents_and_children(spark, rows, tmp_path):
    sinks.write_alert_batch(rows, 0, str(tmp_path))
    assert counts(spark, tmp_path) == (2, 5)
    child = spark.read.parquet(f"{tmp_path}/suspicious_transactions").first()
    assert float(child["amount"]) == 999999.99


def test_replayed_batch_replaces_itself(spark, rows, tmp_path):
    for batch in (0, 1, 1):
        sinks.write_alert_batch(rows, batch, str(tmp_path))
    assert counts(spark, tmp_path) == (4, 10)


def test_failure_between_the_writes_is_repaired(spark, rows, tmp_path):
    parents, _ = sinks.split_alert_rows(rows)
    parents.write.parquet(f"{tmp_path}/fraud_alerts/batch_id=0")
    sinks.write_alert_batch(rows, 0, str(tmp_path))
    assert counts(spark, tmp_path) == (2, 5)


def test_parent_without_children(spark, rows, tmp_path):
    alone = rows.filter("alert is not null").limit(1).withColumn(
        "txn", F.lit(None).cast(rows.schema["txn"].dataType)
    )
    sinks.write_alert_batch(alone, 0, str(tmp_path))
    assert counts(spark, tmp_path) == (1, 0)


def test_only_new_rows_are_appended(rows):
    _, children = sinks.split_alert_rows(rows)
    stored = children.filter("transaction_id <> 'TXN004'")
    new = sinks.not_yet_stored(children, stored, ["alert_id", "transaction_id"])
    assert [r["transaction_id"] for r in new.collect()] == ["TXN004"]


def test_keys_are_read_back_for_the_times_of_a_batch():
    low, high = datetime(2025, 1, 15, 10), datetime(2025, 1, 15, 11, 0, 3, 5)
    assert sinks.stored_keys("t", ["a", "b"], "seen", low, high) == (
        "(SELECT a, b FROM t WHERE seen BETWEEN '2025-01-15 10:00:00.000000' AND '2025-01-15 11:00:03.000005') stored"
    )


def test_lookup_pushes_the_id_into_sorted_files(spark, rows, tmp_path):
    parents, children = sinks.split_alert_rows(rows)
    sinks.write_alert_tables(parents, children, str(tmp_path))
    stored = files.read_parquet(spark, f"{tmp_path}/suspicious_transactions").filter("alert_id = 'x'")
    assert "EqualTo(alert_id,x)" in stored._jdf.queryExecution().executedPlan().toString()
    assert counts(spark, tmp_path) == (2, 5)


def test_patterns_as_text(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "patterns_detected array<string>")
    assert [r[0] for r in sinks.flat_patterns(df).collect()] == ["a,b", ""]


def test_label_file_roundtrip(spark, make_tx, tmp_path):
    tx = make_tx([{"timestamp": "2025-01-15T10:00:00", "ip_address": 'a "quoted",\nline'}] * 2)
    table = lb.label_table(lb.anchored_groups(tx)).select(*LABEL_SCHEMA.fieldNames())
    sinks.write_labels_csv(table, str(tmp_path / "l"))
    back = files.read_csv(spark, str(tmp_path / "l"), LABEL_SCHEMA, multi_line=True)
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in table.collect()]
    assert "related_transaction_ids" in files.read_csv(spark, str(tmp_path / "l")).columns


def test_events_and_jsonl(spark, make_tx, tmp_path):
    tx = make_tx([{"timestamp": "2025-01-15T10:00:00.123456"}])
    sinks.write_events(tx, str(tmp_path / "e"), sink="text")
    parsed = parsing.accepted(parsing.parse_events(spark.read.text(str(tmp_path / "e"))))
    assert [tuple(r) for r in parsed.collect()] == [tuple(r) for r in tx.collect()]
    sinks.write_jsonl(tx, str(tmp_path / "j"))
    assert files.read_jsonl(spark, str(tmp_path / "j")).first()["transaction_id"] == "TXN001"
    sinks.write_by_domain(tx, str(tmp_path / "d"))
    pruned = files.read_parquet(spark, str(tmp_path / "d")).filter("domain = 'gaming'")
    assert "PartitionFilters: [isnotnull(domain" in pruned._jdf.queryExecution().executedPlan().toString()
