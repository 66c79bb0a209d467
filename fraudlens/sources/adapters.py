"""The provided tables as transactions, raw events and fixture predictions.

The column expressions are written in the SQL that both Spark and DuckDB read, so that
the check queries start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fraudlens.functions.parsing import TIMESTAMP_FORMAT
from fraudlens.functions.scoring import score_from_confidence
from fraudlens.schema import TRANSACTION_COLUMNS
from fraudlens.session import prepare

# Event type to pattern, per domain.
EVENT_PATTERNS = {
    "gaming": {
        "error": "fraud_account_takeover", "signup": "fraud_gold_farming",
        "purchase": "fraud_chargeback_fraud", "click": "regular_casual_player",
        "view": "regular_grinder",
    },
    "ecommerce": {
        "error": "fraud_card_testing", "signup": "fraud_promo_abuse",
        "purchase": "fraud_friendly_fraud", "click": "regular_shopper",
        "view": "regular_window_shopper",
    },
    "fintech": {
        "error": "fraud_money_laundering", "signup": "fraud_synthetic_identity",
        "purchase": "fraud_structuring", "click": "regular_saver",
        "view": "regular_bill_payer",
    },
}


def _case(subject: str, values: dict) -> str:
    arms = " ".join(f"WHEN {k} THEN {v}" for k, v in values.items())
    return f"CASE {subject} {arms} END"


def _texts(values: list) -> dict:
    return {i: "NULL" if v is None else f"'{v}'" for i, v in enumerate(values)}


_PATTERN = _case(
    "domain",
    {
        f"'{d}'": _case("event_type", {f"'{e}'": f"'{p}'" for e, p in by_type.items()})
        for d, by_type in EVENT_PATTERNS.items()
    },
)


def _only(domain: str, value: str) -> str:
    return f"CASE WHEN domain = '{domain}' THEN {value} END"


# Column name and expression; ``k`` is the number in events.props.
_TRANSACTION_EXPRS = [
    ("transaction_id", "concat('T', event_id)"),
    ("domain", "domain"),
    ("test_id", "concat('run-', CAST(CAST(ts AS DATE) AS STRING))"),
    ("timestamp", "ts"),
    ("actor_id", "concat('A', user_id)"),
    ("amount", "CAST(value AS DECIMAL(15,2))"),
    ("currency", _case("user_id % 4", _texts(["USD", "EUR", "GBP", "USD"]))),
    ("ip_address", "concat('10.', user_id % 256, '.', event_id % 256, '.1')"),
    ("pattern", _PATTERN),
    ("is_fraud", f"({_PATTERN}) LIKE 'fraud%'"),
    ("sequence_position", "CAST(event_id % 10 AS INT)"),
    ("player_id", _only("gaming", "concat('P', user_id)")),
    ("game_id", _only("gaming", "concat('G', event_id % 5)")),
    ("item_type", _only("gaming", _case("event_id % 3", _texts(["skin", "weapon", "currency"])))),
    ("item_name", _only("gaming", "concat('item-', event_id % 20)")),
    ("session_length_sec", "CASE WHEN event_id % 10 <> 0 THEN CAST(k * 6 AS INT) END"),
    ("account_from", _only("fintech", "concat('ACC', user_id)")),
    ("account_to", _only("fintech", "concat('ACC', (user_id * 7 + event_id) % 1000)")),
    ("transfer_type", _only("fintech", _case("event_id % 3", _texts(["wire", "ach", "p2p"])))),
    ("country_from", _case("user_id % 7", _texts(["US", "GB", "KY", "DE", None, "NG", "PA"]))),
    ("country_to", _case(
        "event_id % 11",
        _texts(["US", "GB", "FR", "VG", None, "DE", "US", "BZ", "US", "GB", "US"]),
    )),
    ("purpose", _only("fintech", _case("event_id % 4", _texts(["rent", "gift", "invoice", "payroll"])))),
    ("user_id", _only("ecommerce", "concat('U', user_id)")),
    ("cart_items", _only(
        "ecommerce",
        """concat('[{"sku":"S', event_id % 100, '","qty":', event_id % 3 + 1, '}]')""",
    )),
    ("shipping_address", _only("ecommerce", """concat('{"city":"C', user_id % 20, '"}')""")),
    ("billing_address", _only(
        "ecommerce",
        """CASE WHEN event_id % 2 = 1 THEN concat('{"city":"C', user_id % 20, '"}') END""",
    )),
    ("device_fingerprint", _only("ecommerce", "concat('F', user_id % 97)")),
    ("session_duration_sec", _only("ecommerce", "CAST(k * 3 AS INT)")),
    ("payment_method", _case(
        "event_id % 7",
        _texts(["credit_card", "debit_card", "paypal", "apple_pay", "google_pay", "bank_transfer", None]),
    )),
    ("device_id", "concat('D', user_id % 50)"),
]
_DOMAIN = _case("user_id % 3", _texts(["gaming", "ecommerce", "fintech"]))

# The same transactions for the check queries.
TRANSACTIONS_SQL = (
    "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _TRANSACTION_EXPRS)
    + f" FROM (SELECT *, {_DOMAIN} AS domain,"
    + " CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e"
)

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def transactions_from(events: DataFrame) -> DataFrame:
    """Canonical transactions from an ``events`` table or stream.

    Event times carry no zone in the file; they are UTC.
    """
    prepare(events.sparkSession)
    staged = events.withColumns(
        {
            "ts": F.col("ts").cast("timestamp"),
            "domain": F.expr(_DOMAIN),
            "k": F.get_json_object("props", "$.k").cast("long"),
        }
    )
    return staged.select(*[F.expr(e).alias(n) for n, e in _TRANSACTION_EXPRS])


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return transactions_from(spark.read.parquet(f"{sf_dir}/events.parquet"))


# --- Raw events -----------------------------------------------------------------

# Event numbers divisible by these arrive damaged in the way named.
DAMAGE = {"malformed": 97, "bad_timestamp": 89, "missing_actor": 83, "missing_amount": 79}


def raw_events_from(tx: DataFrame) -> DataFrame:
    """Transactions as they arrive on the wire: JSON text, nested carts and addresses,
    a property the schema does not know, and some damaged records."""
    number = F.substring("transaction_id", 2, 20).cast("long")
    damaged = {kind: number % F.lit(n) == 0 for kind, n in DAMAGE.items()}
    wire = {
        "timestamp": F.when(damaged["bad_timestamp"], "not-a-time").otherwise(
            F.date_format("timestamp", TIMESTAMP_FORMAT)
        ),
        "actor_id": F.when(~damaged["missing_actor"], F.col("actor_id")),
        "amount": F.when(~damaged["missing_amount"], F.col("amount")),
        "cart_items": F.from_json("cart_items", "array<struct<sku:string,qty:int>>"),
        "shipping_address": F.from_json("shipping_address", "struct<city:string>"),
    }
    fields = [wire.get(c, F.col(c)).alias(c) for c in TRANSACTION_COLUMNS]
    text = F.to_json(F.struct(*fields, F.lit("simulator").alias("emitted_by")))
    broken = F.when(damaged["malformed"], "{").otherwise("")
    return tx.select(F.concat(broken, text).alias("value"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events_from(transactions(spark, sf_dir))


# --- Predictions that SQL can compute --------------------------------------------

_CONFIDENCE = (
    "CAST((CAST(total_amount * 100 AS BIGINT) * 7 + transaction_count * 13) % 100 AS DOUBLE) / 100"
)


def rule_scorer(windows: DataFrame) -> DataFrame:
    """Stand-in scorer: confidence from the window's totals."""
    return windows.withColumn("confidence", F.expr(_CONFIDENCE)).withColumns(
        {
            "fraud_score": score_from_confidence("confidence"),
            "model_version": F.lit("rule-v1"),
            "inference_time_ms": F.lit(1),
        }
    )


def predictions_for(windows: DataFrame) -> DataFrame:
    """Predictions of the stand-in scorer.

    A request whose first transaction has no payment method is turned down, so such
    windows have none.
    """
    served = windows.filter(F.col("opened_by.payment_method").isNotNull())
    return rule_scorer(served).select(
        "actor_id", "window_start", "confidence", "fraud_score", "model_version", "inference_time_ms"
    )


# --- Orders as a second source -----------------------------------------------------

_ORDERS_STAGED_SQL = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       floor(o_totalprice / 50) AS units, o_orderdate AS ordered_at, o_orderpriority AS priority,
       n_nationkey AS nation_id, n_regionkey AS region_id
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""
_ORDER_EXPRS = [
    ("transaction_id", "concat('O', order_id)"),
    ("domain", _case("region_id % 3", _texts(["gaming", "ecommerce", "fintech"]))),
    ("timestamp", "ordered_at"),
    ("fraud_actor_id", "concat('C', customer_id)"),
    ("amount", "CAST(units AS DECIMAL(15,2))"),
    ("fraud_label", "priority = '1-URGENT'"),
    ("fraud_pattern", "CASE WHEN priority = '1-URGENT' THEN 'fraud_structuring' WHEN priority = '5-LOW' THEN NULL ELSE 'regular_saver' END"),
    ("country_from", _case("nation_id % 7", _texts(["US", "GB", "KY", "DE", None, "NG", "PA"]))),
    ("country_to", _case("order_id % 5", _texts(["US", None, "GB", "BZ", "US"]))),
    ("payment_method", _case("order_id % 3", _texts(["credit_card", None, "wire"]))),
]
ORDER_TRANSACTIONS_SQL = (
    "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _ORDER_EXPRS) + f" FROM ({_ORDERS_STAGED_SQL}) o"
)


# Orders as visits: with an hour and a session, so that every feature flag takes both values.
_VISIT_EXPRS = {
    "timestamp": "ordered_at + (order_id % 24) * INTERVAL '1' HOUR",
    "amount": "CAST(floor(units / 3) AS DECIMAL(15,2))",
    "session_length_sec": "CASE WHEN order_id % 10 <> 0 THEN CAST((customer_id + order_id) % 30 * 8 AS INT) END",
}
_VISITS = {**dict(_ORDER_EXPRS), **_VISIT_EXPRS}
VISITS_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _VISITS.items()) + f" FROM ({_ORDERS_STAGED_SQL}) o"


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's nation, without session columns."""
    return _staged_orders(spark, sf_dir).select(*[F.expr(e).alias(n) for n, e in _ORDER_EXPRS])


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with an hour and a session length."""
    return _staged_orders(spark, sf_dir).select(*[F.expr(e).alias(n) for n, e in _VISITS.items()])


def _staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(
        nation, customer["c_nationkey"] == nation["n_nationkey"]
    )
    return joined.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.floor(F.col("o_totalprice") / 50).alias("units"),
        F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
        F.col("o_orderpriority").alias("priority"),
        F.col("n_nationkey").alias("nation_id"),
        F.col("n_regionkey").alias("region_id"),
    )
