import json

import pytest
from pyspark.sql import functions as F

from fraudlens.functions import parsing

GOOD = {
    "transaction_id": "T1", "domain": "gaming", "test_id": "t", "actor_id": "A1",
    "timestamp": "2025-01-15T10:30:00+02:00", "amount": 150.0, "currency": "USD",
    "ip_address": "1.2.3.4", "pattern": "regular_grinder", "is_fraud": False, "sequence_position": 3,
}


def parse(spark, *values):
    return parsing.parse_events(spark.createDataFrame([(v,) for v in values], "value string"))


def test_absent_optional_fields_are_null_and_offset_is_applied(spark):
    row = parsing.accepted(parse(spark, json.dumps(GOOD))).withColumn(
        "timestamp", F.col("timestamp").cast("string")
    ).first()
    assert row["timestamp"] == "2025-01-15 08:30:00"
    assert float(row["amount"]) == 150.0
    assert row["player_id"] is None and row["session_length_sec"] is None


def test_unknown_property_is_ignored(spark):
    assert parsing.accepted(parse(spark, json.dumps({**GOOD, "extra": {"a": 1}}))).count() == 1


def test_nested_values_of_text_fields_keep_their_json(spark):
    event = {**GOOD, "cart_items": [{"sku": "S1"}], "shipping_address": {"city": "C"}, "billing_address": "plain"}
    row = parsing.accepted(parse(spark, json.dumps(event))).first()
    assert json.loads(row["cart_items"]) == [{"sku": "S1"}]
    assert json.loads(row["shipping_address"]) == {"city": "C"}
    assert row["billing_address"] == "plain"


@pytest.mark.parametrize(
    "value, reason",
    [
        ("{not json", "malformed"),
        ("", "malformed"),
        (None, "malformed"),
        (json.dumps({**GOOD, "amount": "abc"}), "malformed"),
        (json.dumps({**GOOD, "timestamp": "soon"}), "bad_timestamp"),
        (json.dumps({k: v for k, v in GOOD.items() if k != "actor_id"}), "missing_actor"),
        (json.dumps({k: v for k, v in GOOD.items() if k != "amount"}), "missing_amount"),
    ],
)
def test_unusable_records_are_quarantined(spark, value, reason):
    parsed = parse(spark, value, json.dumps(GOOD))
    assert [tuple(r) for r in parsing.quarantined(parsed).collect()] == [(value, reason)]
    assert parsing.accepted(parsed).count() == 1


def test_each_record_is_parsed_once(spark):
    plan = parsing.accepted(parse(spark, json.dumps(GOOD)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_snake_and_camel_json(spark):
    df = spark.createDataFrame([("T1", True)], "transaction_id string, is_fraud boolean")
    row = df.select(parsing.to_snake_json(df).alias("s"), parsing.to_camel_json(df).alias("c")).first()
    assert json.loads(row["s"]) == {"transaction_id": "T1", "is_fraud": True}
    assert json.loads(row["c"]) == {"transactionId": "T1", "isFraud": True}


def test_id_list_and_bad_time(spark):
    row = spark.range(1).select(
        parsing.parse_id_list(F.lit('["a","b"]')).alias("ids"),
        parsing.iso_timestamp(F.lit("bad")).alias("bad"),
    ).first()
    assert row["ids"] == ["a", "b"] and row["bad"] is None
