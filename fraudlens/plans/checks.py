"""Common table expressions of the check queries, in DuckDB SQL.

Each is written from the definitions and independently of the DataFrame code; only the
column expressions of the adapters are shared.
"""

from __future__ import annotations

from fraudlens.schema import (
    DETAIL_COLUMNS,
    GROUPING_SECONDS,
    HIGH_RISK_COUNTRIES,
    KNOWN_PAYMENT_METHODS,
    PATTERNS,
)
from fraudlens.sources.adapters import DAMAGE, ORDER_TRANSACTIONS_SQL, TRANSACTIONS_SQL, VISITS_SQL

_RISKY = ", ".join(f"'{c}'" for c in HIGH_RISK_COUNTRIES)
_KNOWN = ", ".join(f"'{p}'" for p in KNOWN_PAYMENT_METHODS)
_NUMBER = "CAST(substring(transaction_id, 2) AS BIGINT)"
_REASON = " ".join(f"WHEN {_NUMBER} % {n} = 0 THEN '{kind}'" for kind, n in DAMAGE.items())
_DETAILS = ", ".join(f"f.{c}" for c in DETAIL_COLUMNS)
_SPAN = "CASE pattern " + " ".join(
    f"WHEN '{p}' THEN {s}" for p, s in GROUPING_SECONDS.items()
) + " ELSE 3600 END"
_CATALOGUE = ", ".join(f"('{p}', '{d}')" for d, names in PATTERNS.items() for p in names)

MISMATCH = "(country_from IS NOT NULL AND country_to IS NOT NULL AND country_from <> country_to)"
RISKY = f"(coalesce(country_from IN ({_RISKY}), false) OR coalesce(country_to IN ({_RISKY}), false))"


def first_of(column: str) -> str:
    return (
        f"arg_min({column}, row(timestamp, transaction_id)) FILTER (WHERE {column} IS NOT NULL)"
    )


CTES = {
    "tx": TRANSACTIONS_SQL,
    "order_tx": ORDER_TRANSACTIONS_SQL,
    "arrived": f"SELECT *, CASE {_REASON} END AS reject_reason FROM tx",
    "day_tx": "SELECT *, time_bucket(INTERVAL 1 DAY, timestamp, TIMESTAMP '1970-01-01') AS window_start FROM tx",
    "first_rows": """SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY actor_id, window_start ORDER BY timestamp, transaction_id) AS rn
        FROM day_tx) r WHERE rn = 1""",
    "top_pattern": """SELECT actor_id, window_start, pattern AS top_fraud_pattern FROM (
        SELECT actor_id, window_start, pattern,
               row_number() OVER (PARTITION BY actor_id, window_start ORDER BY count(*) DESC, pattern) AS rn
        FROM day_tx WHERE is_fraud GROUP BY actor_id, window_start, pattern) p WHERE rn = 1""",
    "totals": """SELECT actor_id, window_start, count(*) AS transaction_count, sum(amount) AS total_amount,
        max(timestamp) AS last_timestamp, count(*) FILTER (WHERE is_fraud) AS fraud_count,
        coalesce(string_agg(DISTINCT pattern, ',' ORDER BY pattern) FILTER (WHERE is_fraud), '') AS patterns_detected
        FROM day_tx GROUP BY actor_id, window_start""",
    "win": f"""SELECT t.*, window_start + INTERVAL 1 DAY AS window_end, 86400 AS window_seconds,
        concat(t.actor_id, ':', epoch_us(t.window_start) // 1000000) AS alert_id,
        f.domain, f.ip_address, top_fraud_pattern, {_DETAILS},
        coalesce(replace(top_fraud_pattern, 'fraud_', ''), 'suspicious_activity') AS alert_type
        FROM totals t JOIN first_rows f USING (actor_id, window_start)
        LEFT JOIN top_pattern USING (actor_id, window_start)""",
    "pred": """SELECT *, CAST(trunc(confidence * 100) AS INTEGER) AS fraud_score FROM (
        SELECT actor_id, window_start,
        CAST((CAST(total_amount * 100 AS BIGINT) * 7 + transaction_count * 13) % 100 AS DOUBLE) / 100 AS confidence
        FROM win WHERE payment_method IS NOT NULL) p""",
    "scored": """SELECT win.*, coalesce(fraud_score, 0) AS fraud_score,
        CASE WHEN fraud_score IS NULL THEN 'error' ELSE 'rule-v1' END AS model_version,
        CASE WHEN fraud_score IS NULL THEN 0 ELSE 1 END AS inference_time_ms,
        CASE WHEN coalesce(fraud_score, 0) >= 90 THEN 'CRITICAL' WHEN fraud_score >= 75 THEN 'HIGH'
             WHEN fraud_score >= 60 THEN 'MEDIUM' ELSE 'LOW' END AS severity
        FROM win LEFT JOIN pred USING (actor_id, window_start)""",
    # Every window has a prediction when the scorer runs inside the stream.
    "stream_scored": """SELECT *, CASE WHEN fraud_score >= 90 THEN 'CRITICAL' WHEN fraud_score >= 75 THEN 'HIGH'
             WHEN fraud_score >= 60 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM (
        SELECT *, CAST(trunc(CAST((CAST(total_amount * 100 AS BIGINT) * 7 + transaction_count * 13) % 100 AS DOUBLE)
            / 100 * 100) AS INTEGER) AS fraud_score, 'rule-v1' AS model_version, 1 AS inference_time_ms
        FROM win) w""",
    "alerts": """SELECT alert_id, alert_type, domain, actor_id, severity, fraud_score, transaction_count,
        CAST(total_amount AS DOUBLE) AS total_amount, window_start AS first_seen, window_end AS last_seen,
        CAST(window_seconds AS BIGINT) AS window_seconds,
        CAST(total_amount AS DOUBLE) / transaction_count AS baseline_avg, patterns_detected,
        fraud_score AS confidence, model_version, inference_time_ms, """
    + ", ".join(DETAIL_COLUMNS)
    + """, ip_address, last_timestamp AS created_at
        FROM scored WHERE fraud_score >= 70""",
    "members": "SELECT *, concat(actor_id, ':', epoch_us(window_start) // 1000000) AS alert_id FROM day_tx",
    "children": "SELECT m.* FROM members m JOIN alerts USING (alert_id)",
    "rollup": f"""SELECT actor_id, count(*) AS fraud_txn_count, CAST(sum(amount) AS DOUBLE) AS amount,
        min(timestamp) AS fraud_first_seen, max(timestamp) AS timestamp,
        arg_min(is_fraud, row(timestamp, transaction_id)) AS fraud_label,
        arg_min(domain, row(timestamp, transaction_id)) AS domain,
        coalesce({first_of('payment_method')}, 'unknown') AS payment_method,
        {first_of('country_from')} AS country_from, {first_of('country_to')} AS country_to,
        avg(session_length_sec) AS session_length_sec,
        coalesce({first_of('pattern')}, 'unknown') AS fraud_pattern
        FROM tx GROUP BY actor_id""",
    "order_rollup": f"""SELECT fraud_actor_id AS actor_id, count(*) AS fraud_txn_count,
        CAST(sum(amount) AS DOUBLE) AS amount, min(timestamp) AS fraud_first_seen, max(timestamp) AS timestamp,
        arg_min(fraud_label, row(timestamp, transaction_id)) AS fraud_label,
        arg_min(domain, row(timestamp, transaction_id)) AS domain,
        coalesce({first_of('payment_method')}, 'unknown') AS payment_method,
        {first_of('country_from')} AS country_from, {first_of('country_to')} AS country_to,
        CAST(0 AS DOUBLE) AS session_length_sec,
        coalesce({first_of('fraud_pattern')}, 'unknown') AS fraud_pattern
        FROM order_tx GROUP BY fraud_actor_id""",
    "actor_groups": f"""SELECT actor_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount,
        sum(coalesce(session_length_sec, 0)) / count(*) AS mean_session,
        coalesce(avg(session_length_sec), 0) AS mean_present,
        max({MISMATCH})::INT AS any_mismatch, max({RISKY})::INT AS any_risky,
        min(timestamp) AS first_ts, max(timestamp) AS last_ts,
        arg_min({{'p': payment_method}}, row(timestamp, transaction_id)).p AS first_payment,
        arg_min(domain, row(timestamp, transaction_id)) AS domain,
        {first_of('payment_method')} AS payment_present,
        {first_of('country_from')} AS country_from, {first_of('country_to')} AS country_to
        FROM tx GROUP BY actor_id""",
    "seq": f"""SELECT *, {_SPAN} AS span, row_number() OVER (
        PARTITION BY actor_id, pattern ORDER BY timestamp, transaction_id) AS rn FROM tx""",
    "walked": """SELECT actor_id, pattern, rn, transaction_id, timestamp, timestamp AS group_start FROM seq WHERE rn = 1
        UNION ALL
        SELECT s.actor_id, s.pattern, s.rn, s.transaction_id, s.timestamp,
               CASE WHEN epoch_us(s.timestamp) - epoch_us(w.group_start) <= CAST(s.span AS BIGINT) * 1000000
                    THEN w.group_start ELSE s.timestamp END
        FROM walked w JOIN seq s ON s.actor_id = w.actor_id AND s.pattern = w.pattern AND s.rn = w.rn + 1""",
    "grouped": """SELECT tx.*, group_start,
        concat(tx.actor_id, ':', tx.pattern, ':', epoch_us(group_start)) AS group_id
        FROM tx JOIN walked USING (transaction_id)""",
    "labels_table": """SELECT group_id AS alert_id, arg_min(transaction_id, row(timestamp, transaction_id)) AS transaction_id,
        arg_min(domain, row(timestamp, transaction_id)) AS domain, actor_id,
        CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS transaction_count, min(timestamp) AS timestamp,
        arg_min(ip_address, row(timestamp, transaction_id)) AS ip_address, pattern, true AS fraud_label,
        pattern AS fraud_type, CAST(0.9 AS DOUBLE) AS confidence, 'rule_based' AS label_source,
        max(timestamp) AS label_timestamp
        FROM grouped GROUP BY group_id, actor_id, pattern""",
    "classified": """SELECT label, CASE WHEN amount >= 20 THEN label WHEN is_fraud THEN 'fraud_card_testing'
        ELSE 'regular' END AS prediction FROM (
        SELECT amount, is_fraud, CASE WHEN pattern LIKE 'regular%' THEN 'regular' ELSE pattern END AS label FROM tx) t""",
    "per_class": """SELECT class, sum(hits) AS hits, sum(actual) AS actual, sum(guessed) AS guessed FROM (
        SELECT label AS class, count(*) FILTER (WHERE label = prediction) AS hits, count(*) AS actual, 0 AS guessed
        FROM classified GROUP BY label
        UNION ALL SELECT prediction, 0, 0, count(*) FROM classified GROUP BY prediction) c GROUP BY class""",
    "metrics": """SELECT class, CAST(actual AS BIGINT) AS actual, CAST(guessed AS BIGINT) AS guessed,
        CAST(hits AS BIGINT) AS hits,
        CASE WHEN guessed = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / guessed END AS precision,
        CASE WHEN actual = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / actual END AS recall,
        CASE WHEN actual + guessed = 0 THEN 0 ELSE CAST(2 * hits AS DOUBLE) / (actual + guessed) END AS f1
        FROM per_class""",
    "catalogue": f"SELECT * FROM (VALUES {_CATALOGUE}) v(pattern, domain)",
}

CTES["visits"] = VISITS_SQL
CTES["visit_rollup"] = CTES["order_rollup"].replace("CAST(0 AS DOUBLE)", "avg(session_length_sec)").replace("order_tx", "visits")
CTES["day_groups"] = (
    CTES["actor_groups"].replace("SELECT actor_id,", "SELECT actor_id, window_start,").replace("sum(amount)", "sum(amount * 100)")
    .replace("FROM tx GROUP BY actor_id", "FROM day_tx GROUP BY actor_id, window_start")
)

# What each expression reads.
_NEEDS = {
    "arrived": ["tx"], "day_tx": ["tx"], "first_rows": ["day_tx"], "top_pattern": ["day_tx"],
    "totals": ["day_tx"], "win": ["totals", "first_rows", "top_pattern"], "pred": ["win"],
    "scored": ["win", "pred"], "stream_scored": ["win"], "alerts": ["scored"],
    "members": ["day_tx"], "children": ["members", "alerts"], "rollup": ["tx"],
    "order_rollup": ["order_tx"], "visit_rollup": ["visits"], "day_groups": ["day_tx"], "actor_groups": ["tx"], "seq": ["tx"], "walked": ["seq"],
    "grouped": ["tx", "walked"], "labels_table": ["grouped"], "classified": ["tx"],
    "per_class": ["classified"], "metrics": ["per_class"], "velocity": ["alerts"],
}


def velocity_cte(name: str, seconds: int, trend_rows: int = 1) -> tuple[str, str]:
    trend = "sum(y1_velocity) OVER r AS prev, count(y1_velocity) OVER r AS prev_rows"
    return name, f"""SELECT domain, x, y1_velocity, y2_avg_score, y3_cumulative,
        CASE WHEN prev IS NULL THEN 'BASELINE' WHEN y1_velocity * 10 * prev_rows > 15 * prev THEN 'SPIKE'
             WHEN y1_velocity * 10 * prev_rows > 11 * prev THEN 'TRENDING_UP' ELSE 'STABLE' END AS trend_status
        FROM (SELECT *, CAST(sum(y1_velocity) OVER (PARTITION BY domain ORDER BY x) AS BIGINT) AS y3_cumulative,
              {trend}
              FROM (SELECT domain, CAST((epoch_us(created_at) - gm) // {seconds * 1_000_000} * {seconds} AS DOUBLE) AS x,
                           count(*) AS y1_velocity,
                           ((20 * CAST(sum(fraud_score) AS BIGINT) + count(*)) // (2 * count(*))) / 10.0 AS y2_avg_score
                    FROM alerts, (SELECT epoch_us(min(created_at)) AS gm FROM alerts) g GROUP BY 1, 2) b
              WINDOW r AS (PARTITION BY domain ORDER BY x ROWS BETWEEN {trend_rows} PRECEDING AND 1 PRECEDING)) v"""


def check(select: str, *uses: str, extra: dict[str, str] | None = None, accepted_only: bool = False) -> str:
    """``select`` preceded by the expressions it uses, in dependency order.

    ``accepted_only``: of the transactions only those whose record arrives undamaged.
    """
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in uses:
        need(name)
    ctes = CTES
    if accepted_only:
        ordered.insert(0, "sent")
        ctes = {**CTES, "sent": TRANSACTIONS_SQL, "tx": f"SELECT * FROM sent WHERE CASE {_REASON} END IS NULL"}
    parts = [f"{n} AS ({ctes[n]})" for n in ordered]
    parts += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    return f"WITH RECURSIVE {', '.join(parts)} {select}"
