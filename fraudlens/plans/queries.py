"""The registered queries over the provided tables, each with its check query.

``query(name, sql)`` registers a function ``(spark, sf_dir) -> DataFrame``; queries
whose result SQL cannot compute (fitted models) have no check query.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fraudlens.functions import features, parsing, scoring
from fraudlens.operators import (
    alerts as al, analytics, evaluate, labels as lb, positions, reports, rollup, windows,
)
from fraudlens.plans import forest, training
from fraudlens.plans.checks import MISMATCH, RISKY, check, velocity_cte
from fraudlens.schema import (
    ALERT_COLUMNS,
    ALERT_SUMMARY_COLUMNS,
    DETAIL_COLUMNS,
    LABEL_SCHEMA,
    PATTERNS,
    SCORE_THRESHOLD,
    TRANSACTION_COLUMNS,
)
from fraudlens.session import fresh_path, prepare
from fraudlens.sources import adapters, alert_index, alert_store, files, sinks
from fraudlens.streaming import alert_stream, batched_scoring, live_velocity, multiplex

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

DAY = "1 day"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def presentable(df: DataFrame) -> DataFrame:
    """Plain column types: times without zone, money as double, lists as joined text."""
    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(column, ",").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema])


# --- Shared inputs -----------------------------------------------------------------


def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_windows(adapters.transactions(spark, sf_dir), DAY)


def scored_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_windows(spark, sf_dir)
    return al.attach_predictions(daily, adapters.predictions_for(daily))


def built_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = windows.window_members(adapters.transactions(spark, sf_dir), DAY)
    return al.alerts_of(scored_windows(spark, sf_dir), members)


_ALERT_TABLES: dict[tuple[str, str], str] = {}


def alert_tables(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the stored alert tables, written once per application.

    The alert queries read stored tables, as they do in use.
    """
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ALERT_TABLES:
        path = fresh_path(spark, "alert_tables")
        stored = sinks.write_alerts(built_alerts(spark, sf_dir), path)
        members = windows.window_members(adapters.transactions(spark, sf_dir), DAY)
        sinks.write_alert_transactions(al.alert_children(stored, members), path)
        _ALERT_TABLES[key] = path
    return _ALERT_TABLES[key]


def stored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_parquet(spark, f"{alert_tables(spark, sf_dir)}/fraud_alerts")


def stored_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_parquet(spark, f"{alert_tables(spark, sf_dir)}/suspicious_transactions")


_GROUP_TABLES: dict[tuple[str, str], str] = {}


def grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped transactions, stored once per application: labels, id lists and the
    training join all read them."""
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GROUP_TABLES:
        path = fresh_path(spark, "grouped")
        lb.anchored_groups(adapters.transactions(spark, sf_dir)).write.parquet(path)
        _GROUP_TABLES[key] = path
    return files.read_parquet(spark, _GROUP_TABLES[key])


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed rule in place of a model, so that evaluation tables can be checked."""
    label = scoring.simplify_pattern("pattern")
    guess = (
        F.when(F.col("amount") >= 20, label)
        .when(F.col("is_fraud"), "fraud_card_testing")
        .otherwise("regular")
    )
    return adapters.transactions(spark, sf_dir).select(label.alias("label"), guess.alias("prediction"))


def _names(columns: list[str], money: tuple[str, ...] = ("amount",)) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in columns)


_TX_NAMES = _names(TRANSACTION_COLUMNS)

# --- Parsing and JSON --------------------------------------------------------------


@query("parse_events", check(f"SELECT {_TX_NAMES} FROM arrived WHERE reject_reason IS NULL", "arrived"))
def _(spark, sf_dir):
    return parsing.accepted(parsing.parse_events(adapters.raw_events(spark, sf_dir)))


@query(
    "quarantine_events",
    check(
        "SELECT reject_reason, count(*) AS events FROM arrived WHERE reject_reason IS NOT NULL GROUP BY 1",
        "arrived",
    ),
)
def _(spark, sf_dir):
    rejects = parsing.quarantined(parsing.parse_events(adapters.raw_events(spark, sf_dir)))
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("events"))


# All but time and money, whose text form differs between the engines; null fields included.
_JSON_COLUMNS = [c for c in TRANSACTION_COLUMNS if c not in ("timestamp", "amount")]


@query(
    "json_camel_snake",
    check(
        "SELECT transaction_id, to_json({"
        + ", ".join(f"'{c}': {c}" for c in _JSON_COLUMNS)
        + "})::VARCHAR AS snake, to_json({"
        + ", ".join(f"'{parsing.camel(c)}': {c}" for c in _JSON_COLUMNS)
        + "})::VARCHAR AS camel FROM tx",
        "tx",
    ),
)
def _(spark, sf_dir):
    tx = adapters.transactions(spark, sf_dir)
    return tx.select(
        "transaction_id",
        parsing.to_snake_json(tx, *_JSON_COLUMNS).alias("snake"),
        parsing.to_camel_json(tx, *_JSON_COLUMNS).alias("camel"),
    )


@query("event_json_sink", check(f"SELECT {_TX_NAMES} FROM tx", "tx"))
def _(spark, sf_dir):
    path = fresh_path(spark, "events")
    sinks.write_events(adapters.transactions(spark, sf_dir), path, sink="text")
    return parsing.accepted(parsing.parse_events(spark.read.text(path)))


@query("jsonl_roundtrip", check(f"SELECT {_TX_NAMES} FROM tx", "tx"))
def _(spark, sf_dir):
    path = fresh_path(spark, "jsonl")
    tx = adapters.transactions(spark, sf_dir)
    sinks.write_jsonl(tx, path)
    return files.read_jsonl(spark, path, tx.schema).select(*TRANSACTION_COLUMNS)


@query("partitioned_roundtrip", check(f"SELECT {_TX_NAMES} FROM tx WHERE domain = 'gaming'", "tx"))
def _(spark, sf_dir):
    path = fresh_path(spark, "by_domain")
    sinks.write_by_domain(adapters.transactions(spark, sf_dir), path)
    return files.read_parquet(spark, path).filter("domain = 'gaming'").select(*TRANSACTION_COLUMNS)


@query("partition_by_domain_counts", check("SELECT domain, count(*) AS count FROM tx GROUP BY 1", "tx"))
def _(spark, sf_dir):
    path = fresh_path(spark, "by_domain")
    sinks.write_by_domain(adapters.transactions(spark, sf_dir), path)
    return evaluate.class_distribution(files.read_parquet(spark, path), "domain")


@query(
    "domain_union",
    check(
        "SELECT transaction_id, domain, actor_id, game_id, transfer_type, user_id FROM tx", "tx"
    ),
)
def _(spark, sf_dir):
    tx = adapters.transactions(spark, sf_dir)
    common = ["transaction_id", "domain", "actor_id"]
    own = {"gaming": "game_id", "fintech": "transfer_type", "ecommerce": "user_id"}
    gaming, fintech, shop = [
        tx.filter(F.col("domain") == d).select(*common, c) for d, c in own.items()
    ]
    return gaming.unionByName(fintech, allowMissingColumns=True).unionByName(
        shop, allowMissingColumns=True
    )


@query(
    "pattern_dimension",
    check(
        """SELECT c.pattern, c.domain, c.pattern LIKE 'fraud%' AS is_fraud, count(tx.transaction_id) AS transactions
        FROM catalogue c LEFT JOIN tx ON tx.pattern = c.pattern AND tx.domain = c.domain GROUP BY ALL""",
        "catalogue", "tx",
    ),
)
def _(spark, sf_dir):
    used = adapters.transactions(spark, sf_dir).groupBy("pattern", "domain").agg(
        F.count("*").alias("transactions")
    )
    return scoring.pattern_dimension(spark).join(used, ["pattern", "domain"], "left").na.fill(
        {"transactions": 0}
    )


@query(
    "rename_and_default",
    check(
        """SELECT fraud_actor_id AS actor_id, transaction_id, coalesce(payment_method, 'unknown') AS payment_method,
        coalesce(fraud_pattern, 'unknown') AS fraud_pattern, 0 AS session_length_sec FROM order_tx""",
        "order_tx",
    ),
)
def _(spark, sf_dir):
    orders = adapters.order_transactions(spark, sf_dir)
    actor = rollup.first_available(orders, "fraud_actor_id", "actor_id")
    session = rollup.first_available(orders, "session_length_sec", "session_duration_sec")
    return (
        orders.withColumnRenamed(actor, "actor_id")
        .withColumn("session_length_sec", F.col(session) if session else F.lit(0))
        .na.fill({"payment_method": "unknown", "fraud_pattern": "unknown"})
        .select("actor_id", "transaction_id", "payment_method", "fraud_pattern", "session_length_sec")
    )


# --- Windows -----------------------------------------------------------------------

_WINDOW_COLUMNS = (
    "alert_id, actor_id, domain, transaction_count, CAST(total_amount AS DOUBLE) AS total_amount, "
    "window_start, window_end, CAST(window_seconds AS BIGINT) AS window_seconds"
)
_WINDOW_NAMES = [
    "alert_id", "actor_id", "domain", "transaction_count", "total_amount", "window_start",
    "window_end", "window_seconds",
]


@query("tumbling_windows", check(f"SELECT {_WINDOW_COLUMNS} FROM win", "win"))
def _(spark, sf_dir):
    return daily_windows(spark, sf_dir).select(*_WINDOW_NAMES)


@query(
    "minute_windows",
    check(
        """SELECT actor_id, time_bucket(INTERVAL 1 MINUTE, timestamp, TIMESTAMP '1970-01-01') AS window_start,
        count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount FROM tx GROUP BY 1, 2""",
        "tx",
    ),
)
def _(spark, sf_dir):
    minute = windows.tumbling_windows(adapters.transactions(spark, sf_dir))
    return minute.select("actor_id", "window_start", "transaction_count", "total_amount")


@query(
    "window_members",
    check(
        """SELECT alert_id, transaction_id, row_number() OVER (
        PARTITION BY alert_id ORDER BY timestamp, transaction_id) - 1 AS position FROM members""",
        "members",
    ),
)
def _(spark, sf_dir):
    members = windows.window_members(adapters.transactions(spark, sf_dir), DAY)
    narrow = members.select("alert_id", "timestamp", "transaction_id")
    return positions.numbered(narrow, ["alert_id"]).select("alert_id", "transaction_id", "position")


@query(
    "scoring_requests",
    check(
        """SELECT actor_id, domain, transaction_count, CAST(total_amount AS DOUBLE) AS total_amount,
        CAST(total_amount AS DOUBLE) / transaction_count AS avg_amount, CAST(86400 AS BIGINT) AS time_delta_sec,
        strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
        strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') AS window_end FROM win""",
        "win",
    ),
)
def _(spark, sf_dir):
    return windows.scoring_requests(daily_windows(spark, sf_dir))


@query(
    "sequence_position",
    check(
        """SELECT transaction_id, row_number() OVER (
        PARTITION BY actor_id ORDER BY timestamp, transaction_id) - 1 AS position FROM tx""",
        "tx",
    ),
)
def _(spark, sf_dir):
    narrow = adapters.transactions(spark, sf_dir).select("actor_id", "timestamp", "transaction_id")
    return positions.numbered(narrow, ["actor_id"]).select("transaction_id", "position")


@query("chronological_merge", check("SELECT timestamp, transaction_id, actor_id FROM tx ORDER BY 1, 2", "tx"))
def _(spark, sf_dir):
    return (
        adapters.transactions(spark, sf_dir)
        .select("timestamp", "transaction_id", "actor_id")
        .orderBy("timestamp", "transaction_id")
    )


# --- Scores and alerts ---------------------------------------------------------------


@query(
    "score_truncation",
    check("SELECT actor_id, window_start, confidence, fraud_score FROM pred", "pred"),
)
def _(spark, sf_dir):
    return adapters.predictions_for(daily_windows(spark, sf_dir)).select(
        "actor_id", "window_start", "confidence", "fraud_score"
    )


@query(
    "prediction_attach_fallback",
    check("SELECT alert_id, fraud_score, model_version, inference_time_ms FROM scored", "scored"),
)
def _(spark, sf_dir):
    return scored_windows(spark, sf_dir).select(
        "alert_id", "fraud_score", "model_version", "inference_time_ms"
    )


@query("high_risk_filter", check("SELECT alert_id, fraud_score FROM scored WHERE fraud_score >= 70", "scored"))
def _(spark, sf_dir):
    return al.high_risk(scored_windows(spark, sf_dir)).select("alert_id", "fraud_score")


@query("severity_bands", check("SELECT alert_id, fraud_score, severity FROM scored", "scored"))
def _(spark, sf_dir):
    return scored_windows(spark, sf_dir).select(
        "alert_id", "fraud_score", scoring.severity("fraud_score").alias("severity")
    )


@query(
    "severity_display",
    check(
        """SELECT alert_id, CASE severity WHEN 'CRITICAL' THEN 'danger' WHEN 'HIGH' THEN 'warning'
        WHEN 'MEDIUM' THEN 'info' WHEN 'LOW' THEN 'success' ELSE 'secondary' END AS colour FROM scored""",
        "scored",
    ),
)
def _(spark, sf_dir):
    level = scoring.severity("fraud_score")
    return scored_windows(spark, sf_dir).select(
        "alert_id", scoring.severity_colour(level).alias("colour")
    )


@query("alert_type_mode", check("SELECT alert_id, alert_type FROM win", "win"))
def _(spark, sf_dir):
    return daily_windows(spark, sf_dir).select(
        "alert_id", scoring.alert_type("top_fraud_pattern").alias("alert_type")
    )


@query("patterns_detected", check("SELECT alert_id, patterns_detected FROM win", "win"))
def _(spark, sf_dir):
    return daily_windows(spark, sf_dir).select(
        "alert_id", scoring.detected_patterns("fraud_patterns").alias("patterns_detected")
    )


@query(
    "first_txn_attributes",
    check(f"SELECT alert_id, ip_address, {', '.join(DETAIL_COLUMNS)} FROM win", "win"),
)
def _(spark, sf_dir):
    return daily_windows(spark, sf_dir).select(
        "alert_id", "first_txn.ip_address", *[f"first_txn.{c}" for c in DETAIL_COLUMNS]
    )


@query("alerts_built", check("SELECT * FROM alerts", "alerts"))
def _(spark, sf_dir):
    return built_alerts(spark, sf_dir)


@query("alert_full_view", check(f"SELECT {', '.join(ALERT_COLUMNS)} FROM alerts", "alerts"))
def _(spark, sf_dir):
    return al.alert_full(stored_alerts(spark, sf_dir))


@query("alert_summary_view", check(f"SELECT {', '.join(ALERT_SUMMARY_COLUMNS)} FROM alerts", "alerts"))
def _(spark, sf_dir):
    return al.alert_summary(stored_alerts(spark, sf_dir))


@query("transaction_view", check(f"SELECT {_TX_NAMES} FROM children", "children"))
def _(spark, sf_dir):
    return al.transaction_view(stored_children(spark, sf_dir))


_PAGE = f"SELECT {', '.join(ALERT_SUMMARY_COLUMNS)}, (SELECT count(*) FROM m) AS total"


@query(
    "alerts_filtered_page",
    check(
        f"{_PAGE}, 2 AS page FROM m ORDER BY last_seen DESC, alert_id DESC LIMIT 10 OFFSET 10",
        "alerts",
        extra={"m": "SELECT * FROM alerts WHERE domain = 'gaming' AND severity = 'HIGH'"},
    ),
)
def _(spark, sf_dir):
    return al.alerts_page(stored_alerts(spark, sf_dir), domain="gaming", severity="high", page=2)


@query(
    "alerts_page_by_number",
    check(
        f"{_PAGE}, 3 AS page FROM m ORDER BY last_seen DESC, alert_id DESC LIMIT 25 OFFSET 50",
        "alerts",
        extra={"m": "SELECT * FROM alerts WHERE domain = 'fintech' AND severity = 'CRITICAL'"},
    ),
)
def _(spark, sf_dir):
    index = spark.read.parquet(f"{alert_tables(spark, sf_dir)}/alert_pages")
    return alert_index.page_by_number(stored_alerts(spark, sf_dir), index, "fintech", "critical", page=3, limit=25)


@query(
    "alert_page_counts",
    check("SELECT domain, severity, count(*) AS alerts FROM alerts GROUP BY 1, 2", "alerts"),
)
def _(spark, sf_dir):
    index = spark.read.parquet(f"{alert_tables(spark, sf_dir)}/alert_pages")
    return index.groupBy("domain", "severity").agg(F.sum("rows").alias("alerts"))


@query(
    "alerts_empty_page",
    check(
        "SELECT 0 AS items, count(*) AS total, 10000 AS page FROM alerts WHERE domain = 'gaming'", "alerts"
    ),
)
def _(spark, sf_dir):
    page = al.alerts_envelope(stored_alerts(spark, sf_dir), domain="gaming", page=10_000)
    return page.select(F.size("items").alias("items"), "total", "page")


@query(
    "alerts_envelope",
    check(
        """SELECT string_agg(alert_id, ',' ORDER BY last_seen DESC, alert_id DESC) AS ids,
        (SELECT count(*) FROM alerts) AS total, 2 AS page FROM (
        SELECT * FROM alerts ORDER BY last_seen DESC, alert_id DESC LIMIT 10 OFFSET 10) p""",
        "alerts",
    ),
)
def _(spark, sf_dir):
    page = al.alerts_envelope(stored_alerts(spark, sf_dir), page=2)
    return page.select(F.array_join("items.alert_id", ",").alias("ids"), "total", "page")


@query(
    "alerts_keyset_page",
    check(
        f"""{_PAGE}, 2 AS page FROM m
        WHERE (last_seen, alert_id) < (TIMESTAMP '2024-01-20 00:00:00', 'A5')
        ORDER BY last_seen DESC, alert_id DESC LIMIT 10""",
        "alerts",
        extra={"m": "SELECT * FROM alerts"},
    ),
)
def _(spark, sf_dir):
    after = (F.lit("2024-01-20 00:00:00").cast("timestamp"), "A5")
    return al.alerts_page(stored_alerts(spark, sf_dir), page=2, after=after)


@query("alerts_total", check("SELECT count(*) AS total FROM alerts WHERE domain = 'fintech'", "alerts"))
def _(spark, sf_dir):
    return al.alert_total(al.filter_alerts(stored_alerts(spark, sf_dir), domain="fintech"))


@query(
    "alert_feed_topk",
    check(
        """SELECT alert_id, domain, actor_id, alert_type, total_amount, severity, fraud_score FROM alerts
        ORDER BY last_seen DESC, alert_id DESC LIMIT 10""",
        "alerts",
    ),
)
def _(spark, sf_dir):
    return al.alert_feed(stored_alerts(spark, sf_dir))


_CHILD_NAMES = ", ".join(
    f"CAST(c.{c} AS DOUBLE) AS txn_{c}" if c == "amount" else f"c.{c} AS txn_{c}"
    for c in TRANSACTION_COLUMNS
)


@query(
    "alert_detail",
    check(f"SELECT alerts.*, {_CHILD_NAMES} FROM alerts LEFT JOIN children c USING (alert_id)", "alerts", "children"),
)
def _(spark, sf_dir):
    return al.alert_detail(stored_alerts(spark, sf_dir), stored_children(spark, sf_dir))


@query(
    "alert_lookup",
    check(
        f"""SELECT alerts.*, {_CHILD_NAMES} FROM alerts LEFT JOIN children c USING (alert_id)
        WHERE alert_id = 'A0:1704499200'""",
        "alerts", "children",
    ),
)
def _(spark, sf_dir):
    return alert_index.lookup(spark, alert_tables(spark, sf_dir), "A0:1704499200")


# --- Velocity ------------------------------------------------------------------------


def _velocity_check(select: str, seconds: int, trend_rows: int = 1) -> str:
    name, sql = velocity_cte("velocity", seconds, trend_rows)
    return check(select, "alerts", extra={name: sql})


@query("velocity", _velocity_check("SELECT * FROM velocity", 5))
def _(spark, sf_dir):
    return analytics.velocity_ordered(stored_alerts(spark, sf_dir))


@query("velocity_hourly", _velocity_check("SELECT * FROM velocity", 3600))
def _(spark, sf_dir):
    return analytics.velocity(stored_alerts(spark, sf_dir), 3600)


@query("velocity_cumulative", _velocity_check("SELECT domain, x, y3_cumulative FROM velocity", 60))
def _(spark, sf_dir):
    return analytics.velocity(stored_alerts(spark, sf_dir), 60).select("domain", "x", "y3_cumulative")


@query("velocity_trend_n", _velocity_check("SELECT domain, x, trend_status FROM velocity", 21600, 4))
def _(spark, sf_dir):
    series = analytics.velocity(stored_alerts(spark, sf_dir), 21600, trend_rows=4)
    return series.select("domain", "x", "trend_status")


@query(
    "velocity_buckets",
    check(
        """SELECT domain, CAST((epoch_us(created_at) - gm) // 3600000000 * 3600 AS DOUBLE) AS x,
        count(*) AS y1_velocity, min(created_at) AS bucket_start, max(created_at) AS bucket_end
        FROM alerts, (SELECT epoch_us(min(created_at)) AS gm FROM alerts) g GROUP BY 1, 2""",
        "alerts",
    ),
)
def _(spark, sf_dir):
    return analytics.velocity_buckets(stored_alerts(spark, sf_dir), 3600).drop("y2_avg_score")


@query(
    "velocity_last_points",
    _velocity_check(
        """SELECT domain, x, y1_velocity, label FROM (
        SELECT *, concat(CAST(floor(x / 60) AS BIGINT), 'm') AS label,
               row_number() OVER (PARTITION BY domain ORDER BY x DESC) AS rn FROM velocity) v WHERE rn <= 15""",
        5,
    ),
)
def _(spark, sf_dir):
    points = analytics.last_points(analytics.velocity(stored_alerts(spark, sf_dir)))
    return points.select("domain", "x", "y1_velocity", "label")


@query(
    "velocity_summary",
    check(
        """SELECT 5 AS bucket_size_seconds, count(*) AS total_alerts,
        string_agg(DISTINCT domain, ',' ORDER BY domain) AS domains FROM alerts""",
        "alerts",
    ),
)
def _(spark, sf_dir):
    return analytics.velocity_summary(stored_alerts(spark, sf_dir))


# --- Features --------------------------------------------------------------------------


def _training_check(source: str) -> str:
    night = "(hour(fraud_first_seen) < 6 OR hour(fraud_first_seen) > 22)"
    rapid = "coalesce(session_length_sec, 0) < 120"
    return check(
        f"""SELECT actor_id, fraud_label, domain, fraud_pattern, fraud_first_seen, timestamp, country_from,
        country_to, payment_method, amount, fraud_txn_count, coalesce(session_length_sec, 0) AS session_length_sec,
        {MISMATCH}::INT AS country_mismatch, {RISKY}::INT AS involves_high_risk_country,
        hour(fraud_first_seen)::INT AS hour_of_day, (dayofweek(fraud_first_seen) + 1)::INT AS day_of_week,
        (dayofweek(fraud_first_seen) IN (0, 6))::INT AS is_weekend,
        (amount >= 9500 AND amount < 10000)::INT AS is_near_threshold,
        ({rapid})::INT AS is_rapid_session, amount / (fraud_txn_count + 1) AS amount_per_txn,
        amount / (coalesce(session_length_sec, 0) + 1) AS session_efficiency,
        ({night} AND {rapid})::INT AS night_rapid_combo,
        CASE WHEN fraud_pattern LIKE 'regular%' THEN 'regular' ELSE fraud_pattern END AS fraud_pattern_simplified
        FROM {source}""",
        source,
    )


@query("actor_rollup", check("SELECT * FROM rollup", "rollup"))
def _(spark, sf_dir):
    return rollup.actor_rollup(adapters.transactions(spark, sf_dir))


@query("training_features", _training_check("rollup"))
def _(spark, sf_dir):
    return features.training_features(rollup.actor_rollup(adapters.transactions(spark, sf_dir)))


@query("training_features_orders", _training_check("order_rollup"))
def _(spark, sf_dir):
    return features.training_features(rollup.actor_rollup(adapters.order_transactions(spark, sf_dir)))


@query("training_features_visits", _training_check("visit_rollup"))
def _(spark, sf_dir):
    """Every flag takes both values here."""
    return features.training_features(rollup.actor_rollup(adapters.visits(spark, sf_dir)))


def actor_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = windows.aggregate_transactions(adapters.transactions(spark, sf_dir), "actor_id")
    return groups.withColumn("domain", F.col("opened_by.domain"))


_SERVED = [
    "actor_id", "domain", "amount", "fraud_txn_count", "session_length_sec", "country_mismatch",
    "involves_high_risk_country", "is_near_threshold", "is_rapid_session", "is_weekend",
    "night_rapid_combo", "hour_of_day", "day_of_week", "amount_per_txn", "session_efficiency",
    "payment_method", "time_delta_sec",
]


def _serving_check(
    session: str, mismatch: str, risky: str, weekday: str, weekend: str, per: str, pay: str,
    keys: str = "actor_id", source: str = "actor_groups",
) -> str:
    night = "(hour(first_ts) < 6 OR hour(first_ts) > 22)"
    return check(
        f"""SELECT {keys}, domain, amount, n AS fraud_txn_count, {session} AS session_length_sec,
        {mismatch} AS country_mismatch, {risky} AS involves_high_risk_country,
        (amount >= 9500 AND amount < 10000)::INT AS is_near_threshold, ({session} < 120)::INT AS is_rapid_session,
        {weekend}::INT AS is_weekend, ({night} AND {session} < 120)::INT AS night_rapid_combo,
        hour(first_ts)::INT AS hour_of_day, ({weekday})::INT AS day_of_week, {per} AS amount_per_txn,
        amount / ({session} + 1) AS session_efficiency, {pay} AS payment_method,
        (epoch_us(last_ts) - epoch_us(first_ts)) / 1e6 AS time_delta_sec FROM {source}""",
        source,
    )


_PAYMENT = """CASE WHEN first_payment IN ('credit_card', 'debit_card', 'paypal', 'apple_pay', 'google_pay')
    THEN first_payment ELSE 'credit_card' END"""


@query(
    "serving_features",
    _serving_check(
        "mean_session", "any_mismatch", "any_risky", "isodow(first_ts)", "(isodow(first_ts) >= 6)",
        "amount / n", _PAYMENT,
    ),
)
def _(spark, sf_dir):
    return features.serving_features(actor_groups(spark, sf_dir)).select(*_SERVED)


@query(
    "serving_features_windows",
    _serving_check(
        "mean_session", "any_mismatch", "any_risky", "isodow(first_ts)", "(isodow(first_ts) >= 6)",
        "amount / n", _PAYMENT, "actor_id, window_start", "day_groups",
    ),
)
def _(spark, sf_dir):
    """Of daily windows, with amounts in hundredths: every flag takes both values here."""
    tx = adapters.transactions(spark, sf_dir)
    minor = tx.withColumn("amount", (F.col("amount") * 100).cast(tx.schema["amount"].dataType))
    return features.serving_features(windows.tumbling_windows(minor, DAY)).select(_SERVED[0], "window_start", *_SERVED[1:])


@query(
    "serving_features_consistent",
    _serving_check(
        "mean_present", f"{MISMATCH}::INT", f"{RISKY}::INT", "dayofweek(first_ts) + 1",
        "(dayofweek(first_ts) IN (0, 6))", "amount / (n + 1)", "coalesce(payment_present, 'unknown')",
    ),
)
def _(spark, sf_dir):
    return features.serving_features(actor_groups(spark, sf_dir), consistent=True).select(*_SERVED)


@query("payment_normalised", check(f"SELECT actor_id, {_PAYMENT} AS payment_method FROM actor_groups", "actor_groups"))
def _(spark, sf_dir):
    return actor_groups(spark, sf_dir).select(
        "actor_id", features.known_payment(F.col("opened_by.payment_method")).alias("payment_method")
    )


# --- Labels ------------------------------------------------------------------------------


@query("anchored_groups", check("SELECT transaction_id, group_start, group_id FROM grouped", "grouped"))
def _(spark, sf_dir):
    groups = lb.anchored_groups(adapters.transactions(spark, sf_dir))
    return groups.select("transaction_id", "group_start", "group_id")


@query("alert_labels", check("SELECT * FROM labels_table", "labels_table"))
def _(spark, sf_dir):
    return lb.alert_labels(grouped(spark, sf_dir))


@query(
    "label_id_lists",
    check(
        """SELECT group_id AS alert_id, CAST(rn // 3 AS BIGINT) AS chunk_no,
        concat('["', string_agg(transaction_id, '","' ORDER BY timestamp, transaction_id), '"]')
            AS related_transaction_ids
        FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY timestamp, transaction_id) - 1 AS rn
              FROM grouped) g GROUP BY 1, 2""",
        "grouped",
    ),
)
def _(spark, sf_dir):
    return lb.label_id_lists(grouped(spark, sf_dir), chunk=3)


@query(
    "label_ids",
    check(
        """SELECT group_id AS alert_id, row_number() OVER (PARTITION BY group_id ORDER BY timestamp, transaction_id) - 1
        AS position, transaction_id FROM grouped""",
        "grouped",
    ),
)
def _(spark, sf_dir):
    return lb.label_ids(grouped(spark, sf_dir))


_LABELLED_SQL = check(
    """SELECT l.alert_id, l.transaction_id AS fraud_alert_txn_id, l.actor_id AS fraud_actor_id,
    l.amount AS fraud_total_amount, l.transaction_count AS fraud_txn_count, l.timestamp AS fraud_first_seen,
    l.pattern AS fraud_pattern, g.transaction_id AS related_txn_id, g.domain, CAST(g.amount AS DOUBLE) AS amount
    FROM labels_table l JOIN grouped g ON g.group_id = l.alert_id""",
    "labels_table",
)


@query("label_members", _LABELLED_SQL)
def _(spark, sf_dir):
    return lb.label_members(grouped(spark, sf_dir)).select(
        "alert_id", "fraud_alert_txn_id", "fraud_actor_id", "fraud_total_amount", "fraud_txn_count",
        "fraud_first_seen", "fraud_pattern", "related_txn_id", "domain", "amount",
    )


@query("label_explode_join", _LABELLED_SQL)
def _(spark, sf_dir):
    table = lb.label_table(grouped(spark, sf_dir))
    joined = training.build_training_set(table, adapters.transactions(spark, sf_dir))
    return joined.select(
        "alert_id", "fraud_alert_txn_id", "fraud_actor_id", "fraud_total_amount", "fraud_txn_count",
        "fraud_first_seen", "fraud_pattern", "related_txn_id", "domain", "amount",
    )


@query(
    "csv_roundtrip",
    check(
        """SELECT l.alert_id, l.pattern, l.amount, l.timestamp, ids FROM labels_table l JOIN (
        SELECT group_id, concat('["', string_agg(transaction_id, '","' ORDER BY timestamp, transaction_id), '"]') AS ids
        FROM grouped GROUP BY 1) g ON g.group_id = l.alert_id""",
        "labels_table",
    ),
)
def _(spark, sf_dir):
    path = fresh_path(spark, "labels")
    table = lb.label_table(grouped(spark, sf_dir)).select(*LABEL_SCHEMA.fieldNames())
    sinks.write_labels_csv(table, path)
    return files.read_csv(spark, path, LABEL_SCHEMA).select(
        "alert_id", "pattern", "amount", "timestamp", F.col("related_transaction_ids").alias("ids")
    )


@query(
    "label_statistics",
    check(
        """SELECT pattern, count(*) AS alerts, min(transaction_count) AS min_txns, max(transaction_count) AS max_txns,
        avg(transaction_count) AS avg_txns, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM labels_table) AS percent
        FROM labels_table GROUP BY pattern""",
        "labels_table",
    ),
)
def _(spark, sf_dir):
    return lb.label_statistics(lb.alert_labels(grouped(spark, sf_dir)))


@query(
    "pattern_window_lookup",
    check("SELECT pattern, CAST(span AS BIGINT) AS grouping_seconds, count(*) AS transactions FROM seq GROUP BY 1, 2", "seq"),
)
def _(spark, sf_dir):
    tx = adapters.transactions(spark, sf_dir)
    return tx.groupBy("pattern", lb.grouping_seconds().alias("grouping_seconds")).agg(
        F.count("*").alias("transactions")
    )


# --- Classes and evaluation -----------------------------------------------------------------


@query("class_distribution", check("SELECT pattern, count(*) AS count FROM tx GROUP BY 1", "tx"))
def _(spark, sf_dir):
    return evaluate.class_distribution(adapters.transactions(spark, sf_dir), "pattern")


@query("top_classes", check("SELECT pattern, count(*) AS count FROM tx GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", "tx"))
def _(spark, sf_dir):
    return evaluate.top_classes(adapters.transactions(spark, sf_dir), "pattern")


@query("class_count", check("SELECT count(DISTINCT pattern) AS classes FROM tx", "tx"))
def _(spark, sf_dir):
    return evaluate.class_count(adapters.transactions(spark, sf_dir), "pattern")


_WEIGHTS = "SELECT pattern, count(*) AS count, (SELECT count(*) FROM tx) / (16 * count(*)) AS class_weight FROM tx GROUP BY 1"


@query("class_weights", check(_WEIGHTS, "tx"))
def _(spark, sf_dir):
    return evaluate.class_weights(adapters.transactions(spark, sf_dir), "pattern")


@query("top_class_weights", check(f"{_WEIGHTS} ORDER BY 3 DESC, 1 LIMIT 5", "tx"))
def _(spark, sf_dir):
    return evaluate.top_class_weights(adapters.transactions(spark, sf_dir), "pattern")


@query(
    "class_weight_column",
    check("SELECT transaction_id, class_weight FROM tx JOIN w USING (pattern)", "tx", extra={"w": _WEIGHTS}),
)
def _(spark, sf_dir):
    weighted = evaluate.with_class_weight(adapters.transactions(spark, sf_dir), "pattern")
    return weighted.select("transaction_id", "class_weight")


@query("confusion_counts", check("SELECT label, prediction, count(*) AS count FROM classified GROUP BY 1, 2", "classified"))
def _(spark, sf_dir):
    return evaluate.confusion_counts(classified(spark, sf_dir))


_MATRIX_CLASSES = ["regular", *sorted({p for names in PATTERNS.values() for p in names if not p.startswith("regular_")})]


@query(
    "confusion_matrix",
    check(
        "SELECT label, "
        + ", ".join(f"count(*) FILTER (WHERE prediction = '{c}') AS {c}" for c in _MATRIX_CLASSES)
        + " FROM classified GROUP BY 1",
        "classified",
    ),
)
def _(spark, sf_dir):
    return evaluate.confusion_matrix(classified(spark, sf_dir), _MATRIX_CLASSES)


@query("per_class_metrics", check("SELECT * FROM metrics", "metrics"))
def _(spark, sf_dir):
    return evaluate.per_class_metrics(classified(spark, sf_dir))


@query("worst_classes", check("SELECT class, f1 FROM metrics WHERE f1 < 0.7 ORDER BY f1, class", "metrics"))
def _(spark, sf_dir):
    return evaluate.worst_classes(evaluate.per_class_metrics(classified(spark, sf_dir)))


@query(
    "accuracy_and_f1",
    check(
        """SELECT round(sum(hits) / sum(actual), 6) AS accuracy,
        round(sum(f1 * actual) / sum(actual), 6) AS f1 FROM metrics""",
        "metrics",
    ),
)
def _(spark, sf_dir):
    table = evaluate.accuracy_and_f1(evaluate.per_class_metrics(classified(spark, sf_dir)))
    return table.select(F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


# --- Reports ----------------------------------------------------------------------------------


@query(
    "filter_pass_rate",
    check(
        """SELECT count(*) AS total, count(*) FILTER (WHERE fraud_score >= 60) AS high_risk,
        count(*) FILTER (WHERE fraud_score >= 70) AS passed,
        CAST(trunc(count(*) FILTER (WHERE fraud_score >= 70) * 100 / count(*)) AS INTEGER) AS pass_rate_percent
        FROM scored""",
        "scored",
    ),
)
def _(spark, sf_dir):
    return reports.filter_pass_rate(scored_windows(spark, sf_dir))


@query(
    "detection_report",
    check(
        """SELECT 'total' AS section, 'alerts' AS name, count(*) FILTER (WHERE fraud_score >= 70) AS value FROM scored
        UNION ALL SELECT 'total', 'fraud_windows', count(*) FILTER (WHERE fraud_count > 0) FROM scored
        UNION ALL SELECT 'total', 'fraud_detected', count(*) FILTER (WHERE fraud_count > 0 AND fraud_score >= 70) FROM scored
        UNION ALL SELECT 'severity', severity, count(*) FROM scored WHERE fraud_score >= 70 GROUP BY severity
        UNION ALL SELECT 'alert_type', alert_type, count(*) FROM scored WHERE fraud_score >= 70 GROUP BY alert_type""",
        "scored",
    ),
)
def _(spark, sf_dir):
    return reports.detection_report(scored_windows(spark, sf_dir))


@query(
    "ingest_rate_report",
    check(
        """SELECT domain, 'normal' AS load_level, generated AS events_generated, published AS events_published,
        errors, ((20000 * errors + generated) // (2 * generated)) / 100.0 AS error_rate_percent,
        10000 AS target_rate_per_min, seconds AS duration_seconds,
        coalesce(published * 60 / seconds, 0) AS actual_rate_per_min,
        coalesce(published * 60 / seconds, 0) / 10000 * 100 AS efficiency_percent,
        CASE WHEN published = 0 THEN 0 ELSE ((2000 * fraud + published) // (2 * published)) / 10.0 END AS fraud_rate_percent
        FROM (SELECT CASE WHEN reject_reason IS DISTINCT FROM 'malformed' THEN domain END AS domain, count(*) AS generated,
              count(*) FILTER (WHERE reject_reason IS NULL) AS published,
              count(*) FILTER (WHERE reject_reason IS NOT NULL) AS errors,
              count(*) FILTER (WHERE reject_reason IS NULL AND is_fraud) AS fraud,
              (max(epoch_us(timestamp)) FILTER (WHERE reject_reason IS NULL)
               - min(epoch_us(timestamp)) FILTER (WHERE reject_reason IS NULL)) / 1e6 AS seconds
              FROM arrived GROUP BY 1) a""",
        "arrived",
    ),
)
def _(spark, sf_dir):
    return reports.ingest_rate_report(parsing.parse_events(adapters.raw_events(spark, sf_dir)))


@query("partition_rows")
def _(spark, sf_dir):
    return reports.rows_per_partition(adapters.transactions(spark, sf_dir))


@query("partition_totals", check("SELECT CAST(count(*) AS BIGINT) AS rows, true AS none_empty FROM tx", "tx"))
def _(spark, sf_dir):
    parts = reports.rows_per_partition(adapters.transactions(spark, sf_dir))
    return parts.agg(F.sum("rows").alias("rows"), (F.min("rows") > 0).alias("none_empty"))


# --- Streaming --------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = files.parquet_stream(spark, sf_dir, adapters.EVENTS_SCHEMA, "events.parquet")
    return adapters.transactions_from(events)


@query("stream_windows", check(f"SELECT {_WINDOW_COLUMNS} FROM win", "win"))
def _(spark, sf_dir):
    path = fresh_path(spark, "stream_windows")
    alert_stream.keep_state_on_disk(spark)

    def start(tx: DataFrame):
        closed = alert_stream.windows_of(tx, DAY).select(*_WINDOW_NAMES)
        writer = closed.writeStream.format("parquet").outputMode("append")
        writer = writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
        return writer.start(f"{path}/windows")

    stored = adapters.transactions(spark, sf_dir)
    alert_stream.run_to_end(_event_stream(spark, sf_dir), stored, start, f"{path}/closing", DAY, at_once=True)
    return spark.read.parquet(f"{path}/windows")


def _run_alert_job(spark: SparkSession, sf_dir: str, scorer, threshold: int = SCORE_THRESHOLD) -> str:
    """Stream the events into the alert tables; returns their folder."""
    path = fresh_path(spark, "stream_alerts")

    def start(tx: DataFrame):
        rows = alert_stream.alert_rows(tx, scorer, DAY, threshold=threshold)
        sink = sinks.parquet_alert_sink(path)
        return alert_stream.start_alert_job(rows, sink, f"{path}/checkpoint", {"availableNow": True})

    stored = adapters.transactions(spark, sf_dir)
    alert_stream.run_to_end(_event_stream(spark, sf_dir), stored, start, f"{path}/closing", DAY, at_once=True)
    return path


_STREAM_ALERT = [
    "alert_id", "alert_type", "severity", "fraud_score", "transaction_count", "total_amount",
    "first_seen", "last_seen", "patterns_detected", "model_version", "payment_method", "ip_address",
]


_STREAM_ALERT_SQL = """SELECT alert_id, alert_type, severity, fraud_score, transaction_count,
    CAST(total_amount AS DOUBLE) AS total_amount, window_start AS first_seen, window_end AS last_seen,
    patterns_detected, model_version, payment_method, ip_address FROM stream_scored WHERE fraud_score >= 70"""


@query("stream_alerts", check(_STREAM_ALERT_SQL, "stream_scored"))
def _(spark, sf_dir):
    path = _run_alert_job(spark, sf_dir, adapters.rule_scorer)
    return spark.read.parquet(f"{path}/fraud_alerts").select(*_STREAM_ALERT)


RECORDS_A_FILE = 100_000


def _run_json_job(spark: SparkSession, sf_dir: str) -> str:
    """The whole job from JSON records; returns its folder."""
    path = fresh_path(spark, "stream_job")
    # compressed, as the text is several times its columns; in files that are a task's work each, as they cannot be cut
    records = adapters.raw_events(spark, sf_dir).write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_A_FILE)
    records.text(f"{path}/records")
    raw = files.event_stream(spark, f"{path}/records", source="text")
    alert_stream.run_alert_job(raw, adapters.rule_scorer, sinks.parquet_alert_sink(path), path, DAY)
    return path


@query("stream_job_alerts", check(_STREAM_ALERT_SQL, "stream_scored", accepted_only=True))
def _(spark, sf_dir):
    return spark.read.parquet(f"{_run_json_job(spark, sf_dir)}/fraud_alerts").select(*_STREAM_ALERT)


@query(
    "stream_quarantine",
    check(
        "SELECT reject_reason, count(*) AS events FROM arrived WHERE reject_reason IS NOT NULL GROUP BY 1",
        "arrived",
    ),
)
def _(spark, sf_dir):
    path = fresh_path(spark, "stream_landing")
    adapters.raw_events(spark, sf_dir).write.text(f"{path}/records")
    raw = files.event_stream(spark, f"{path}/records", source="text")
    job = alert_stream.start_landing(raw, f"{path}/landed", f"{path}/checkpoint", {"availableNow": True})
    job.awaitTermination()
    return alert_stream.quarantine(spark, f"{path}/landed").groupBy("reject_reason").agg(F.count("*").alias("events"))


@query(
    "stream_alert_transactions",
    check(
        f"""SELECT m.alert_id, {', '.join(f'CAST(m.{c} AS DOUBLE) AS {c}' if c == 'amount' else f'm.{c}' for c in TRANSACTION_COLUMNS)}
        FROM members m JOIN stream_scored s USING (alert_id) WHERE s.fraud_score >= 70""",
        "members", "stream_scored",
    ),
)
def _(spark, sf_dir):
    path = _run_alert_job(spark, sf_dir, adapters.rule_scorer)
    return spark.read.parquet(f"{path}/suspicious_transactions").drop("batch_id")


def _run_domain_streams(spark: SparkSession, sf_dir: str) -> str:
    """Each domain's records as a stream of its own, merged into windows; returns their folder."""
    path = fresh_path(spark, "domain_streams")
    domains = ["gaming", "ecommerce", "fintech"]
    tx = adapters.transactions(spark, sf_dir)
    records = adapters.raw_events_from(tx).select("value", F.get_json_object("value", "$.domain").alias("domain"))
    records.filter("domain IS NOT NULL").write.partitionBy("domain").text(f"{path}/topics")
    raw = {d: files.event_stream(spark, f"{path}/topics/domain={d}", source="text") for d in domains}
    merged = multiplex.multiplexed({d: alert_stream.transactions_of(r) for d, r in raw.items()}, f"{path}/beats")
    # All windows close: each source says that it has nothing before a time past the last of them.
    newest = tx.agg(F.max("timestamp").alias("newest")).filter("newest IS NOT NULL").collect()
    if newest:
        multiplex.beat(spark, f"{path}/beats", domains, newest[0]["newest"] + timedelta(days=2))
    alert_stream.keep_state_on_disk(spark)
    closed = windows.tumbling_windows(merged, DAY, "event_time").select(*_WINDOW_NAMES)
    job = closed.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/checkpoint")
    job.trigger(availableNow=True).start(f"{path}/windows").awaitTermination()
    return f"{path}/windows"


@query("stream_domains", check(f"SELECT {_WINDOW_COLUMNS} FROM win", "win", accepted_only=True))
def _(spark, sf_dir):
    return spark.read.schema(daily_windows(spark, sf_dir).select(*_WINDOW_NAMES).schema).parquet(_run_domain_streams(spark, sf_dir))


def _run_batched_job(spark: SparkSession, sf_dir: str, flush_ms: int = 1000) -> str:
    """Windows scored in batches of at most 100; returns the folder of the scored windows."""
    path = fresh_path(spark, "batched_scores")
    stored = adapters.transactions(spark, sf_dir)
    newest, rows = stored.agg(F.max("timestamp"), F.count("*")).collect()[0]
    columns = [*batched_scoring.FLUSH, *_SCORED]
    daily_windows(spark, sf_dir).limit(0).select(
        F.lit("").alias("flush_id"), F.lit(0).alias("flush_size"), F.lit("").alias("flush_reason"), "*",
        F.lit(0).alias("fraud_score"), F.lit("").alias("model_version"), F.lit(0).alias("inference_time_ms"),
    ).select(*columns).write.parquet(f"{path}/scored/batch_id=-1")
    if newest is None:
        return f"{path}/scored"
    last = newest + timedelta(days=2)
    closing = spark.createDataFrame([("closing", "closing", last)], "transaction_id string, actor_id string, timestamp timestamp")
    kinds = {f.name: f.dataType for f in stored.schema}
    closing.select(*[
        (F.col(n) if n in closing.columns else F.lit(None)).cast(t).alias(n) for n, t in kinds.items()
    ]).write.parquet(f"{path}/closing")

    def sink(scored: DataFrame, batch_id: int) -> None:
        scored.select(*columns).write.mode("overwrite").parquet(f"{path}/scored/batch_id={batch_id}")

    ended = spark.readStream.schema(stored.schema).parquet(f"{path}/closing")
    job = batched_scoring.start_batched_job(
        _event_stream(spark, sf_dir).unionByName(ended), adapters.rule_scorer, sink, f"{path}/checkpoint", DAY,
        flush_ms=flush_ms, lanes=batched_scoring.lanes_for(rows, 4), trigger={"processingTime": "200 milliseconds"},
    )
    try:
        mark = (last - timedelta(minutes=1)).strftime("%Y-%m-%dT%H:%M:%S")
        batched_scoring.wait_until(job, lambda: batched_scoring.is_drained(job, mark), 900)
    finally:
        job.stop()
    return f"{path}/scored"


_SCORED = [
    "alert_id", "actor_id", "domain", "transaction_count", "total_amount", "window_start", "window_end",
    "fraud_patterns", "top_fraud_pattern", "first_txn", "last_timestamp", "window_seconds",
    "fraud_score", "model_version", "inference_time_ms",
]


@query("stream_batched_alerts", check(_STREAM_ALERT_SQL, "stream_scored"))
def _(spark, sf_dir):
    scored = spark.read.parquet(_run_batched_job(spark, sf_dir))
    return al.build_alerts(scored).select(*_STREAM_ALERT)


@query(
    "stream_batch_sizes",
    check(
        """SELECT count(*) AS windows, true AS none_above_100, true AS full_by_size, true AS whole,
        count(DISTINCT alert_id) AS distinct_windows FROM stream_scored""",
        "stream_scored",
    ),
)
def _(spark, sf_dir):
    """Every window leaves in one batch of at most 100; a batch is full, or left by its timer."""
    scored = spark.read.parquet(_run_batched_job(spark, sf_dir))
    flushes = scored.groupBy(*batched_scoring.FLUSH).agg(F.count("*").alias("rows"))
    return flushes.agg(
        F.sum("rows").alias("windows"), (F.max("rows") <= 100).alias("none_above_100"),
        F.min((F.col("rows") == 100) == (F.col("flush_reason") == "size")).alias("full_by_size"),
        F.min(F.col("rows") == F.col("flush_size")).alias("whole"),
        scored.agg(F.countDistinct("alert_id")).scalar().alias("distinct_windows"),
    )


BATCHES = 4


def _alert_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The stored alerts with their transactions as the batches of a stream, cut by a hash of the id."""
    alerts, children = stored_alerts(spark, sf_dir), stored_children(spark, sf_dir)
    rows = alerts.select("alert_id", F.struct(*ALERT_COLUMNS).alias("alert"), F.lit(None).alias("txn")).unionByName(
        children.select("alert_id", F.struct(*TRANSACTION_COLUMNS).alias("txn")), allowMissingColumns=True
    )
    of = F.pmod(F.xxhash64("alert_id"), F.lit(BATCHES))
    return [rows.filter(of == b) for b in range(BATCHES)]


def _run_batches(spark: SparkSession, sf_dir: str, sink) -> None:
    """Every batch once, and two of them again."""
    batches = _alert_batches(spark, sf_dir)
    for b in [0, 1, 1, 2, 0, 3]:
        sink(batches[b], b)


@query("velocity_maintained", _velocity_check("SELECT * FROM velocity", 5))
def _(spark, sf_dir):
    path = fresh_path(spark, "live_velocity")
    _run_batches(spark, sf_dir, live_velocity.alert_sink_with_velocity(path))
    return live_velocity.velocity_now(spark, path)


@query(
    "stream_generated_keys",
    check(
        """SELECT (SELECT count(*) FROM alerts) AS alerts, (SELECT count(*) FROM alerts) AS distinct_keys,
        (SELECT count(*) FROM alerts) AS unchanged_keys, (SELECT count(*) FROM children) AS transactions,
        (SELECT count(*) FROM children) AS referring""",
        "alerts", "children",
    ),
)
def _(spark, sf_dir):
    """Keys are unique, the same after batches were run again, and referred to by every transaction."""
    path = fresh_path(spark, "keyed_alerts")
    sink, batches = alert_store.keyed_alert_sink(path), _alert_batches(spark, sf_dir)
    for b, rows in enumerate(batches):
        sink(rows, b)
    first = fresh_path(spark, "first_keys")
    alert_store.read_table(spark, path).select("alert_id", "alert_key").write.parquet(first)
    for b in (2, 0):
        sink(batches[b].repartition(3), b)
    alerts = alert_store.read_table(spark, path).select("alert_id", "alert_key")
    children = alert_store.read_table(spark, path, alert_store.TRANSACTIONS)
    count = lambda rows: rows.agg(F.count("*")).scalar()
    return alerts.agg(
        F.count("*").alias("alerts"), F.countDistinct("alert_key").alias("distinct_keys"),
        count(alerts.intersect(spark.read.parquet(first))).alias("unchanged_keys"), count(children).alias("transactions"),
        count(children.join(alerts, ["alert_id", "alert_key"], "left_semi")).alias("referring"),
    )


@query("alerts_compacted", check(f"SELECT {', '.join(ALERT_SUMMARY_COLUMNS)} FROM alerts", "alerts"))
def _(spark, sf_dir):
    """The store after its closed batches were put together."""
    path = fresh_path(spark, "compacted_alerts")
    _run_batches(spark, sf_dir, sinks.parquet_alert_sink(path))
    alert_store.compact(spark, path, through=1)
    alert_store.compact(spark, path)
    alert_store.vacuum(spark, path)
    return al.alert_summary(alert_store.read_table(spark, path))


# --- Models (rows only) -------------------------------------------------------------------------


def _fitted(spark: SparkSession, sf_dir: str, path: str):
    """Features and a model of the published size, trained on this data and saved below ``path``."""
    feats = f"{path}/features"
    sinks.write_features(
        features.training_features(rollup.actor_rollup(adapters.transactions(spark, sf_dir))), feats
    )
    return training.train(spark, feats, f"{path}/model")


@query("train_and_score")
def _(spark, sf_dir):
    model = _fitted(spark, sf_dir, fresh_path(spark, "train"))
    return training.score_groups(actor_groups(spark, sf_dir), training.model_scorer(model))


@query(
    "scored_actor_totals",
    check(
        """SELECT actor_id, n AS transactions_analyzed, round(amount, 2) AS total_amount,
        round((epoch_us(last_ts) - epoch_us(first_ts)) / 1e6, 2) AS time_window_sec,
        true AS score_follows_confidence, true AS known_class FROM actor_groups""",
        "actor_groups",
    ),
)
def _(spark, sf_dir):
    """What SQL can say about scored actors: one row each, their totals, score and class in order."""
    model = _fitted(spark, sf_dir, fresh_path(spark, "train"))
    rows = training.score_groups(actor_groups(spark, sf_dir), training.model_scorer(model))
    follows = F.col("fraud_score") == F.floor(F.col("confidence") * 100)
    return rows.select(
        "actor_id", "transactions_analyzed", "total_amount", "time_window_sec",
        follows.alias("score_follows_confidence"),
        F.col("fraud_type").isin(training.model_labels(model)).alias("known_class"),
    )


@query(
    "flat_forest_agreement",
    check("SELECT count(*) AS actors, count(*) AS equal_rows FROM actor_groups", "actor_groups"),
)
def _(spark, sf_dir):
    """Rows that the flat forest and the pipeline score alike, in every column."""
    path = fresh_path(spark, "train")
    model = _fitted(spark, sf_dir, path)
    groups = actor_groups(spark, sf_dir)
    pipeline = training.score_groups(groups, training.model_scorer(model))
    flat = training.score_groups(groups, forest.forest_scorer(forest.load_forest(spark, f"{path}/model")))
    return pipeline.agg(F.count("*").alias("actors")).select(
        "actors", pipeline.intersectAll(flat).agg(F.count("*")).scalar().alias("equal_rows")
    )


@query(
    "training_facts",
    check(
        """SELECT count(*) AS feature_rows, count(*) AS split_rows, 0 AS in_both_parts, true AS known_labels,
        count(*) AS validated_rows, true AS metrics_in_range, 5 AS stages, 150 AS trees FROM rollup""",
        "rollup",
    ),
)
def _(spark, sf_dir):
    """What SQL can say about training: the split is whole and disjoint, labels are known, the saved model applies."""
    path = fresh_path(spark, "train")
    model = _fitted(spark, sf_dir, path)
    feats = spark.read.parquet(f"{path}/features")
    fit_rows, test_rows = training.hash_split(feats)
    known = feats.filter(F.col(training.LABEL).isin(training.model_labels(model))).select(training.LABEL).distinct()
    metrics = spark.read.json(f"{path}/model_metrics")
    inside = F.min(F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1))
    count = lambda rows: rows.agg(F.count("*")).scalar()
    return metrics.agg(
        count(feats).alias("feature_rows"), count(fit_rows.unionAll(test_rows)).alias("split_rows"),
        count(fit_rows.join(test_rows, "actor_id", "left_semi")).cast("int").alias("in_both_parts"),
        (count(known) == F.lit(len(training.model_labels(model)))).alias("known_labels"),
        count(training.validate_model(f"{path}/model", feats)).alias("validated_rows"), inside.alias("metrics_in_range"),
        F.lit(len(model.stages)).alias("stages"), F.lit(model.stages[-1].getNumTrees).alias("trees"),
    )


@query("single_actor_score")
def _(spark, sf_dir):
    model = _fitted(spark, sf_dir, fresh_path(spark, "train"))
    return training.score_actor(actor_groups(spark, sf_dir), training.model_scorer(model), "A1")


@query("model_roundtrip")
def _(spark, sf_dir):
    path = fresh_path(spark, "train")
    _fitted(spark, sf_dir, path)
    rows = training.validate_model(f"{path}/model", spark.read.parquet(f"{path}/features"))
    return rows.select("actor_id", "fraud_type", "confidence", "fraud_score")


@query("metrics_json")
def _(spark, sf_dir):
    path = fresh_path(spark, "train")
    _fitted(spark, sf_dir, path)
    return spark.read.json(f"{path}/model_metrics")


@query("training_job_chain")
def _(spark, sf_dir):
    path = fresh_path(spark, "chain")
    training.build_training_set(
        lb.label_table(grouped(spark, sf_dir)), adapters.transactions(spark, sf_dir), f"{path}/training"
    )
    rows = training.training_chain(spark, f"{path}/training", path)
    return rows.select("actor_id", "fraud_type", "confidence", "fraud_score")


@query("stream_scored_alerts")
def _(spark, sf_dir):
    model = _fitted(spark, sf_dir, fresh_path(spark, "train"))
    # Patterns in these tables do not depend on the features, so no model is ever confident.
    path = _run_alert_job(spark, sf_dir, training.model_scorer(model), threshold=20)
    return spark.read.parquet(f"{path}/fraud_alerts").select(*_STREAM_ALERT)
