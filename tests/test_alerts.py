from pyspark.sql import functions as F

import pytest

from fraudlens.functions import scoring
from fraudlens.operators import alerts as al, windows


def scored(make_tx, rows, score):
    return windows.tumbling_windows(make_tx(rows)).withColumns(
        {"fraud_score": F.lit(score), "model_version": F.lit("v"), "inference_time_ms": F.lit(1)}
    )


BURST = [
    {"timestamp": f"2025-01-15T10:00:{s}", "amount": a, "actor_id": "fraud_actor", "pattern": "fraud_velocity_spike", "is_fraud": True}
    for s, a in (("05", 500), ("15", 600), ("25", 700))
]


def test_burst_becomes_one_alert(make_tx):
    row = al.build_alerts(scored(make_tx, BURST, 95)).first()
    assert row["transaction_count"] == 3 and float(row["total_amount"]) == 1800.0
    assert row["alert_type"] == "velocity_spike" and row["severity"] == "CRITICAL"
    assert row["patterns_detected"] == ["fraud_velocity_spike"]
    assert row["baseline_avg"] == 600.0 and row["window_seconds"] == 60
    assert row["first_seen"].minute == 0 and row["last_seen"].minute == 1


def test_details_of_risky_windows_only_give_the_same_alerts(make_tx):
    rows = BURST + [{"timestamp": "2025-01-15T11:00:00", "actor_id": "calm"}]
    win = scored(make_tx, rows, 95).withColumn(
        "fraud_score", F.when(F.col("actor_id") == "calm", 10).otherwise(95)
    )
    direct = al.build_alerts(win)
    later = al.alerts_of(win, windows.window_members(make_tx(rows)))
    assert later.collect() == direct.collect() and direct.count() == 1


@pytest.mark.parametrize("score, kept", [(30, 0), (69, 0), (70, 1)])
def test_threshold(make_tx, score, kept):
    assert al.build_alerts(scored(make_tx, BURST, score)).count() == kept


def test_alert_without_fraud_rows(make_tx):
    row = al.build_alerts(scored(make_tx, [{"timestamp": "2025-01-15T10:00:00", "ip_address": None}], 80)).first()
    assert row["alert_type"] == "suspicious_activity" and row["patterns_detected"] == []
    assert row["ip_address"] == "unknown"


def test_most_frequent_pattern_and_ties(make_tx):
    def one(patterns):
        rows = [{"timestamp": "2025-01-15T10:00:00", "pattern": p, "is_fraud": True} for p in patterns]
        return al.build_alerts(scored(make_tx, rows, 80)).first()["alert_type"]

    assert one(["fraud_b", "fraud_a", "fraud_b"]) == "b"
    assert one(["fraud_b", "fraud_a"]) == "a"


def test_severity_bounds_and_colours(spark):
    df = spark.createDataFrame([(s,) for s in (100, 90, 89, 75, 74, 60, 59, 0)], "s int")
    found = [r[0] for r in df.select(scoring.severity("s")).collect()]
    assert found == ["CRITICAL", "CRITICAL", "HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    names = spark.createDataFrame([("Critical",), ("HIGH",), ("odd",), (None,)], "s string")
    assert [r[0] for r in names.select(scoring.severity_colour("s")).collect()] == [
        "danger", "warning", "secondary", "secondary",
    ]


def test_score_truncates(spark):
    df = spark.createDataFrame([(0.85,), (0.95,), (0.29,), (0.999,)], "c double")
    assert [r[0] for r in df.select(scoring.score_from_confidence("c")).collect()] == [85, 95, 28, 99]


def test_missing_prediction_falls_back(spark, make_tx):
    win = windows.tumbling_windows(
        make_tx([{"timestamp": "2025-01-15T10:00:00"}, {"timestamp": "2025-01-15T10:05:00"}])
    )
    known = win.filter(F.minute("window_start") == 0).select(
        "actor_id", "window_start", F.lit(88).alias("fraud_score"),
        F.lit("m").alias("model_version"), F.lit(2).alias("inference_time_ms"),
    )
    got = al.attach_predictions(win, known).orderBy("window_start").collect()
    assert [(r["fraud_score"], r["model_version"]) for r in got] == [(88, "m"), (0, "error")]


@pytest.fixture(scope="module")
def stored(make_tx):
    rows = [
        {"timestamp": f"2025-01-15T{h:02d}:00:0{n}", "actor_id": f"A{h}", "domain": d}
        for h, d in ((1, "gaming"), (2, "fintech"), (3, "gaming"), (4, "gaming"))
        for n in range(2)
    ]
    tx = make_tx(rows)
    alerts = al.build_alerts(scored(make_tx, rows, 80))
    return alerts, al.alert_children(alerts, windows.window_members(tx))


def test_pages(stored):
    alerts, _ = stored
    first = al.alerts_page(alerts, domain="GAMING", severity="high", limit=2).collect()
    assert [r["actor_id"] for r in first] == ["A4", "A3"]
    assert {(r["total"], r["page"]) for r in first} == {(3, 1)}
    second = al.alerts_page(alerts, domain="gaming", limit=2, page=2).collect()
    assert [r["actor_id"] for r in second] == ["A1"]
    last = first[-1]
    keyset = al.alerts_page(alerts, domain="gaming", limit=2, page=2, after=(last["last_seen"], last["alert_id"]))
    assert [r["actor_id"] for r in keyset.collect()] == ["A1"]


def test_total_does_not_depend_on_the_page(stored):
    alerts, _ = stored
    assert {r["total"] for r in al.alerts_page(alerts, limit=1, page=4).collect()} == {4}


def test_feed_is_newest_first(stored):
    assert [r["actor_id"] for r in al.alert_feed(stored[0], 2).collect()] == ["A4", "A3"]


def test_detail_keeps_alerts_without_transactions(stored):
    alerts, children = stored
    detail = al.alert_detail(alerts, children.filter("actor_id <> 'A1'"))
    counts = {r["actor_id"]: r["n"] for r in detail.groupBy("actor_id").agg(F.count("txn_transaction_id").alias("n")).collect()}
    assert counts == {"A1": 0, "A2": 2, "A3": 2, "A4": 2}
    key = alerts.filter("actor_id = 'A2'").first()["alert_id"]
    assert al.alert_detail(alerts, children, key).count() == 2


def test_pages_are_taken_without_a_full_sort(stored):
    plan = al.alerts_page(stored[0])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "CartesianProduct" not in plan


def test_envelope_holds_rows_and_total_together(stored):
    alerts, _ = stored
    page = al.alerts_envelope(alerts, domain="gaming", page=1, limit=2).first()
    assert [i["actor_id"] for i in page["items"]] == ["A4", "A3"]
    assert (page["total"], page["page"], page["limit"]) == (3, 1, 2)
    past = al.alerts_envelope(alerts, domain="gaming", page=9, limit=2).first()
    assert (past["items"], past["total"], past["page"]) == ([], 3, 9)
