from pyspark.sql import functions as F

from conftest import at
from fraudlens.operators import positions, windows


def test_single_row_window(make_tx):
    row = windows.tumbling_windows(make_tx([{"timestamp": "2025-01-15T10:30:15", "amount": 150}])).first()
    assert row["transaction_count"] == 1 and float(row["total_amount"]) == 150.0
    assert (row["window_end"] - row["window_start"]).total_seconds() == 60
    assert row["alert_id"] == f"A1:{int(at('2025-01-15T10:30:00').timestamp())}"


def test_several_rows_share_a_window(make_tx):
    rows = [{"timestamp": f"2025-01-15T10:30:{s}", "amount": a} for s, a in (("01", 100), ("20", 200), ("59", 50))]
    found = windows.tumbling_windows(make_tx(rows)).collect()
    assert [(r["transaction_count"], float(r["total_amount"])) for r in found] == [(3, 350.0)]


def test_no_rows_no_window(make_tx):
    assert windows.tumbling_windows(make_tx([])).count() == 0


def test_actors_and_minutes_are_separate(make_tx):
    tx = make_tx(
        [
            {"timestamp": "2025-01-15T10:30:59"},
            {"timestamp": "2025-01-15T10:31:00"},
            {"timestamp": "2025-01-15T10:30:10", "actor_id": "A2", "domain": "fintech"},
        ]
    )
    found = windows.tumbling_windows(tx).select("actor_id", "domain").collect()
    assert sorted(map(tuple, found)) == [("A1", "gaming"), ("A1", "gaming"), ("A2", "fintech")]


def test_sum_is_exact(make_tx):
    rows = [{"timestamp": "2025-01-15T10:30:01", "amount": a} for a in (10.1, 20.2, 6.2)]
    assert float(windows.tumbling_windows(make_tx(rows)).first()["total_amount"]) == 36.5


def test_members_keep_arrival_order(make_tx):
    rows = [
        {"transaction_id": "TXN003", "timestamp": "2025-01-15T10:30:30"},
        {"transaction_id": "TXN002", "timestamp": "2025-01-15T10:30:05"},
        {"transaction_id": "TXN001", "timestamp": "2025-01-15T10:30:05"},
    ]
    members = positions.numbered(windows.window_members(make_tx(rows)), ["alert_id"])
    ordered = members.orderBy("position").select("transaction_id", "position").collect()
    assert [tuple(r) for r in ordered] == [("TXN001", 0), ("TXN002", 1), ("TXN003", 2)]


def test_first_row_decides_domain_and_attributes(make_tx):
    tx = make_tx(
        [
            {"timestamp": "2025-01-15T10:30:30", "domain": "fintech", "payment_method": "paypal"},
            {"timestamp": "2025-01-15T10:30:05", "domain": "gaming", "payment_method": None},
        ]
    )
    row = windows.tumbling_windows(tx).first()
    assert row["domain"] == "gaming"
    assert row["first_txn"]["payment_method"] is None and row["first_payment_method"] == "paypal"


def test_scoring_request(make_tx):
    rows = [{"timestamp": "2025-01-15T10:30:05", "amount": a} for a in (1, 2)]
    row = windows.scoring_requests(windows.tumbling_windows(make_tx(rows))).first()
    assert (row["avg_amount"], row["time_delta_sec"]) == (1.5, 60)
    assert (row["window_start"], row["window_end"]) == ("2025-01-15T10:30:00Z", "2025-01-15T10:31:00Z")


def test_window_never_collects_rows(make_tx):
    plan = windows.tumbling_windows(make_tx([]))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
