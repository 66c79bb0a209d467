from pyspark.sql import functions as F

import pytest

from conftest import at
from fraudlens.functions import features
from fraudlens.operators import rollup, windows

NAMES = "fraud_actor_id string, amount double, timestamp string, fraud_label boolean, domain string"


def train(spark, rows, schema):
    return features.training_features(rollup.actor_rollup(spark.createDataFrame(rows, schema)))


def test_minimal_columns(spark):
    row = train(spark, [("A", 100.0, "2024-01-15T10:00:00", False, "gaming")], NAMES).first()
    assert (row["country_mismatch"], row["involves_high_risk_country"]) == (0, 0)
    assert row["payment_method"] == "unknown" and row["fraud_pattern"] == "unknown"
    assert row["session_length_sec"] == 0.0


def test_many_actors(spark):
    rows = [(f"A{i % 20}", float(i), f"2024-01-{i % 28 + 1:02d}T{i % 24:02d}:00:00", False, "fintech") for i in range(100)]
    got = train(spark, rows, NAMES).collect()
    assert len(got) == 20
    assert all(0 <= r["hour_of_day"] <= 23 and 1 <= r["day_of_week"] <= 7 for r in got)


FULL = NAMES + ", session_length_sec long, country_from string, country_to string"


@pytest.mark.parametrize(
    "pair, mismatch, risky",
    [(("US", "US"), 0, 0), (("US", "NG"), 1, 0), (("US", "GB"), 1, 0), (("US", "KY"), 1, 1), ((None, "KY"), 0, 1), (("US", None), 0, 0)],
)
def test_countries(spark, pair, mismatch, risky):
    row = train(spark, [("A", 1.0, "2024-01-15T10:00:00", False, "gaming", 200, *pair)], FULL).first()
    assert (row["country_mismatch"], row["involves_high_risk_country"]) == (mismatch, risky)


def test_saturday_night(spark):
    row = train(spark, [("A", 1.0, "2024-01-13T03:00:00", False, "gaming", 10, "US", "US")], FULL).first()
    assert (row["hour_of_day"], row["is_weekend"], row["is_rapid_session"], row["night_rapid_combo"]) == (3, 1, 1, 1)
    assert row["day_of_week"] == 7


@pytest.mark.parametrize("hour, night", [(22, 0), (23, 1), (5, 1), (6, 0)])
def test_night_hours(spark, hour, night):
    row = train(spark, [("A", 1.0, f"2024-01-15T{hour:02d}:30:00", False, "gaming", 10, "US", "US")], FULL).first()
    assert row["night_rapid_combo"] == night


def test_derived_values(spark):
    rows = [("A", 100.0, "2024-01-15T10:00:00", False, "gaming", 99, "US", "US")] * 10
    row = train(spark, rows, FULL).first()
    assert row["amount_per_txn"] == pytest.approx(90.909, abs=1e-3)
    assert row["session_efficiency"] == 10.0


@pytest.mark.parametrize("amount, near", [(9499.99, 0), (9500.0, 1), (9999.99, 1), (10000.0, 0)])
def test_near_threshold(spark, amount, near):
    row = train(spark, [("A", amount, "2024-01-15T10:00:00", False, "gaming", 1, "US", "US")], FULL).first()
    assert row["is_near_threshold"] == near


def test_absent_session_is_rapid_only_when_filled_first(spark):
    df = rollup.actor_rollup(
        spark.createDataFrame([("A", 5.0, "2024-01-15T10:00:00", False, "gaming", None, "US", "US")], FULL)
    )
    first = features.training_features(df).first()
    after = features.training_features(df, fill_session_first=False).first()
    assert (first["is_rapid_session"], after["is_rapid_session"]) == (1, 0)
    assert (first["session_efficiency"], after["session_efficiency"]) == (5.0, 0.0)


def test_duration_column_stands_in_for_session(spark):
    schema = NAMES + ", session_duration_sec long, pattern string"
    row = train(spark, [("A", 1.0, "2024-01-15T10:00:00", True, "ecommerce", 50, "regular_shopper")], schema).first()
    assert row["session_length_sec"] == 50.0 and row["fraud_pattern_simplified"] == "regular"


def test_first_values_follow_time_and_skip_nulls(make_tx):
    tx = make_tx(
        [
            {"timestamp": "2025-01-02T00:00:00", "payment_method": "paypal", "pattern": "fraud_b"},
            {"timestamp": "2025-01-01T00:00:00", "payment_method": None, "pattern": "fraud_a"},
        ]
    )
    row = rollup.actor_rollup(tx).first()
    assert (row["payment_method"], row["fraud_pattern"]) == ("paypal", "fraud_a")


def served(make_tx, rows, **options):
    groups = windows.aggregate_transactions(make_tx(rows), "actor_id").withColumn("domain", F.col("opened_by.domain"))
    return features.serving_features(groups, **options).first()


SERVED = [
    {"timestamp": "2024-01-14T23:00:00", "amount": 100, "session_length_sec": 60, "country_from": "US", "country_to": "US", "payment_method": "bank_transfer"},
    {"timestamp": "2024-01-14T23:10:00", "amount": 50, "session_length_sec": None, "country_from": "GB", "country_to": "VG", "payment_method": "paypal"},
]


def test_serving_form(make_tx):
    row = served(make_tx, SERVED)
    assert (row["amount"], row["fraud_txn_count"], row["session_length_sec"]) == (150.0, 2, 30.0)
    assert (row["country_mismatch"], row["involves_high_risk_country"]) == (1, 1)
    assert (row["day_of_week"], row["is_weekend"], row["hour_of_day"]) == (7, 1, 23)
    assert row["payment_method"] == "credit_card" and row["amount_per_txn"] == 75.0
    assert row["time_delta_sec"] == 600.0 and row["night_rapid_combo"] == 1


def test_consistent_form_is_the_training_form(make_tx):
    row = served(make_tx, SERVED, consistent=True)
    trained = features.training_features(rollup.actor_rollup(make_tx(SERVED))).first()
    for name in ("amount", "fraud_txn_count", "session_length_sec", "country_mismatch", "hour_of_day", "day_of_week",
                 "is_weekend", "is_near_threshold", "involves_high_risk_country", "is_rapid_session", "amount_per_txn",
                 "session_efficiency", "night_rapid_combo", "payment_method"):
        assert row[name] == trained[name], name
