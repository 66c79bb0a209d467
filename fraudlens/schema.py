"""Schemas and the fixed values that the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (they must equal the published behaviour) ------------------

WINDOW_DURATION = "1 minute"
WATERMARK_DELAY = "30 seconds"
SCORE_THRESHOLD = 70
REVIEW_SCORE = 60
CLASS_WEIGHT_DIVISOR = 16
WORST_CLASS_F1 = 0.70

HIGH_RISK_COUNTRIES = ["KY", "PA", "BZ", "VG"]
KNOWN_PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "apple_pay", "google_pay"]
NEAR_THRESHOLD_MIN = 9500
NEAR_THRESHOLD_MAX = 10000
RAPID_SESSION_SEC = 120
NIGHT_BEFORE_HOUR = 6
NIGHT_AFTER_HOUR = 22

SEVERITY_BANDS = [(90, "CRITICAL"), (75, "HIGH"), (60, "MEDIUM")]
SEVERITY_COLOURS = {"critical": "danger", "high": "warning", "medium": "info", "low": "success"}

LOAD_LEVELS = {"mini": 5, "normal": 10_000, "peak": 50_000, "crisis": 100_000}

PATTERNS = {
    "gaming": [
        "fraud_account_takeover", "fraud_gold_farming", "fraud_chargeback_fraud",
        "regular_casual_player", "regular_whale_spender", "regular_grinder",
    ],
    "ecommerce": [
        "fraud_card_testing", "fraud_friendly_fraud", "fraud_promo_abuse",
        "regular_shopper", "regular_window_shopper",
    ],
    "fintech": [
        "fraud_structuring", "fraud_money_laundering", "fraud_synthetic_identity",
        "regular_saver", "regular_bill_payer",
    ],
}

_HOUR = 3600
_DAY = 24 * _HOUR
GROUPING_SECONDS = {
    "fraud_account_takeover": 4 * _HOUR,
    "fraud_gold_farming": 7 * _DAY,
    "fraud_chargeback_fraud": 24 * _HOUR,
    "fraud_card_testing": 12 * _HOUR,
    "fraud_friendly_fraud": 30 * _DAY,
    "fraud_promo_abuse": 7 * _DAY,
    "fraud_structuring": 30 * _DAY,
    "fraud_money_laundering": 14 * _DAY,
    "fraud_synthetic_identity": 7 * _DAY,
}
DEFAULT_GROUPING_SECONDS = _HOUR
UNKNOWN_PATTERN = "UNKNOWN"

FEATURE_COLUMNS = [
    "amount", "fraud_txn_count", "session_length_sec", "country_mismatch", "hour_of_day",
    "day_of_week", "is_weekend", "is_near_threshold", "involves_high_risk_country",
    "is_rapid_session", "amount_per_txn", "session_efficiency", "night_rapid_combo",
    "payment_idx", "domain_idx",
]

# --- Schemas -----------------------------------------------------------------

MONEY = T.DecimalType(15, 2)

# Optional attributes an alert copies from the first transaction of its window.
DETAIL_FIELDS = [
    ("player_id", T.StringType()), ("game_id", T.StringType()), ("item_type", T.StringType()),
    ("item_name", T.StringType()), ("session_length_sec", T.IntegerType()),
    ("account_from", T.StringType()), ("account_to", T.StringType()),
    ("transfer_type", T.StringType()), ("country_from", T.StringType()),
    ("country_to", T.StringType()), ("purpose", T.StringType()),
    ("user_id", T.StringType()), ("cart_items", T.StringType()),
    ("shipping_address", T.StringType()), ("billing_address", T.StringType()),
    ("device_fingerprint", T.StringType()), ("session_duration_sec", T.IntegerType()),
    ("payment_method", T.StringType()), ("device_id", T.StringType()),
]
DETAIL_COLUMNS = [name for name, _ in DETAIL_FIELDS]

_CORE_FIELDS = [
    ("transaction_id", T.StringType()), ("domain", T.StringType()), ("test_id", T.StringType()),
    ("timestamp", T.TimestampType()), ("actor_id", T.StringType()), ("amount", MONEY),
    ("currency", T.StringType()), ("ip_address", T.StringType()), ("pattern", T.StringType()),
    ("is_fraud", T.BooleanType()), ("sequence_position", T.IntegerType()),
]

TRANSACTION_SCHEMA = T.StructType(
    [T.StructField(name, kind) for name, kind in _CORE_FIELDS + DETAIL_FIELDS]
)
TRANSACTION_COLUMNS = TRANSACTION_SCHEMA.fieldNames()

# On the wire the timestamp is ISO-8601 text and money is a JSON number.  String
# fields that arrive as arrays or objects keep their raw JSON text.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField(
            f.name,
            {"timestamp": T.StringType(), "amount": T.DoubleType()}.get(f.name, f.dataType),
        )
        for f in TRANSACTION_SCHEMA
    ]
    + [T.StructField("_corrupt", T.StringType())]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("actor_id", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("fraud_score", T.IntegerType()),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("total_amount", MONEY),
        T.StructField("first_seen", T.TimestampType()),
        T.StructField("last_seen", T.TimestampType()),
        T.StructField("window_seconds", T.LongType()),
        T.StructField("baseline_avg", T.DoubleType()),
        T.StructField("patterns_detected", T.ArrayType(T.StringType())),
        T.StructField("confidence", T.IntegerType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("inference_time_ms", T.IntegerType()),
    ]
    + [T.StructField(name, kind) for name, kind in DETAIL_FIELDS]
    + [
        T.StructField("ip_address", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
ALERT_COLUMNS = ALERT_SCHEMA.fieldNames()
ALERT_SUMMARY_COLUMNS = [
    "alert_id", "alert_type", "domain", "actor_id", "severity", "fraud_score",
    "transaction_count", "total_amount", "first_seen", "last_seen", "created_at",
    "window_seconds", "baseline_avg", "patterns_detected", "confidence", "model_version",
]

LABEL_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("actor_id", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("pattern", T.StringType()),
        T.StructField("fraud_label", T.BooleanType()),
        T.StructField("fraud_type", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("label_source", T.StringType()),
        T.StructField("label_timestamp", T.TimestampType()),
        T.StructField("related_transaction_ids", T.StringType()),
    ]
)
