"""Scored windows to alerts, and the queries over stored alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.functions.scoring import alert_type, detected_patterns, severity
from fraudlens.operators.windows import window_details
from fraudlens.schema import (
    ALERT_COLUMNS,
    ALERT_SUMMARY_COLUMNS,
    DETAIL_COLUMNS,
    MONEY,
    SCORE_THRESHOLD,
    TRANSACTION_COLUMNS,
)


def attach_predictions(windows: DataFrame, predictions: DataFrame) -> DataFrame:
    """Left join on (actor, window); a window without a prediction scores 0, ``error``.

    ``predictions`` holds actor_id, window_start, fraud_score, model_version,
    inference_time_ms.
    """
    fallback = {"fraud_score": F.lit(0), "model_version": F.lit("error"), "inference_time_ms": F.lit(0)}
    joined = windows.join(
        predictions.select("actor_id", "window_start", *fallback), ["actor_id", "window_start"], "left"
    )
    return joined.withColumns({c: F.coalesce(c, default) for c, default in fallback.items()})


def high_risk(scored: DataFrame, threshold: int = SCORE_THRESHOLD) -> DataFrame:
    return scored.filter(F.col("fraud_score") >= threshold)


def build_alerts(scored: DataFrame, threshold: int = SCORE_THRESHOLD, *extra: Column | str) -> DataFrame:
    """Windows at or above the threshold, as alert rows, followed by ``extra`` columns.

    First and last seen are the window's bounds.  The stored time of an alert is the
    time of its last transaction, so that a replay gives the same row.
    """
    first = [F.col(f"first_txn.{c}").alias(c) for c in DETAIL_COLUMNS]
    return high_risk(scored, threshold).select(
        "alert_id",
        alert_type("top_fraud_pattern").alias("alert_type"),
        "domain",
        "actor_id",
        severity("fraud_score").alias("severity"),
        "fraud_score",
        "transaction_count",
        F.col("total_amount").cast(MONEY).alias("total_amount"),
        F.col("window_start").alias("first_seen"),
        F.col("window_end").alias("last_seen"),
        "window_seconds",
        F.try_divide(F.col("total_amount").cast("double"), "transaction_count").alias("baseline_avg"),
        detected_patterns("fraud_patterns").alias("patterns_detected"),
        F.col("fraud_score").alias("confidence"),
        "model_version",
        "inference_time_ms",
        *first,
        F.coalesce("first_txn.ip_address", F.lit("unknown")).alias("ip_address"),
        F.col("last_timestamp").alias("created_at"),
        *extra,
    )


def alerts_of(scored: DataFrame, members: DataFrame, threshold: int = SCORE_THRESHOLD) -> DataFrame:
    """The alerts of a table, with details gathered for the windows above the threshold only.

    Scoring then shuffles narrow rows, and the wide ones only where an alert needs them.
    """
    risky = high_risk(scored, threshold).drop("top_fraud_pattern", "fraud_patterns", "first_txn")
    wanted = members.join(risky.select("alert_id"), "alert_id", "left_semi")
    return build_alerts(risky.join(window_details(wanted), "alert_id"), threshold)


def alert_children(alerts: DataFrame, members: DataFrame) -> DataFrame:
    """The transactions of each alert, one row each.

    The alert side is one small row per window; adaptive execution broadcasts it when
    its measured size allows and splits skewed windows of the transaction side
    otherwise.
    """
    return members.select("alert_id", *TRANSACTION_COLUMNS).join(alerts.select("alert_id"), "alert_id")


# --- Queries over stored alerts and their transactions -----------------------


def alert_summary(alerts: DataFrame) -> DataFrame:
    return alerts.select(*ALERT_SUMMARY_COLUMNS)


def alert_full(alerts: DataFrame) -> DataFrame:
    return alerts.select(*ALERT_COLUMNS)


def transaction_view(children: DataFrame) -> DataFrame:
    return children.select(*TRANSACTION_COLUMNS)


def filter_alerts(alerts: DataFrame, domain: str | None = None, severity: str | None = None) -> DataFrame:
    """Optional equality filters; severity is stored in upper case, domain in lower."""
    if domain is not None:
        alerts = alerts.filter(F.col("domain") == domain.lower())
    if severity is not None:
        alerts = alerts.filter(F.col("severity") == severity.upper())
    return alerts


def alert_by_id(alerts: DataFrame, alert_id: str) -> DataFrame:
    return alerts.filter(F.col("alert_id") == alert_id)


def alert_total(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("total"))


def newest_first(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.desc("last_seen"), F.desc("alert_id"))


def alerts_page(
    alerts: DataFrame,
    domain: str | None = None,
    severity: str | None = None,
    page: int = 1,
    limit: int = 10,
    after: tuple | None = None,
) -> DataFrame:
    """One page, newest first, with the total under the same filters and the page number.

    ``after=(last_seen, alert_id)`` continues behind the last row of the previous page
    with a pushed-down filter, which keeps late pages as cheap as the first; so does
    ``alert_index.page_by_number`` for a page that is named by its number.
    """
    matching = filter_alerts(alerts, domain, severity)
    rows = matching
    if after is not None:
        seen, key = F.lit(after[0]), F.lit(after[1])
        rows = rows.filter(
            (F.col("last_seen") <= seen)
            & ((F.col("last_seen") < seen) | (F.col("alert_id") < key))
        )
    rows = newest_first(rows)
    if after is None and page > 1:
        rows = rows.offset((page - 1) * limit)
    return alert_summary(rows.limit(limit)).select(
        "*", alert_total(matching).scalar().alias("total"), F.lit(page).alias("page")
    )


def alerts_envelope(
    alerts: DataFrame, domain: str | None = None, severity: str | None = None, page: int = 1, limit: int = 10
) -> DataFrame:
    """One row: the page's alerts in order (``items``), the total under the filters, page and limit.

    A page past the end has no items and the same total.
    """
    rows = alerts_page(alerts, domain, severity, page, limit)
    # The struct starts with what the page is ordered by; ``limit`` bounds the list.
    key = ["last_seen", "alert_id"]
    item = F.struct(*key, *[c for c in ALERT_SUMMARY_COLUMNS if c not in key])
    return rows.agg(F.sort_array(F.collect_list(item), asc=False).alias("items")).select(
        "items",
        alert_total(filter_alerts(alerts, domain, severity)).scalar().alias("total"),
        F.lit(page).alias("page"), F.lit(limit).alias("limit"),
    )


def alert_feed(alerts: DataFrame, k: int = 10) -> DataFrame:
    return newest_first(alerts).limit(k).select(
        "alert_id", "domain", "actor_id", "alert_type", "total_amount", "severity", "fraud_score"
    )


def alert_detail(alerts: DataFrame, children: DataFrame, alert_id: str | None = None) -> DataFrame:
    """Alerts in full shape with their transactions, one row per transaction.

    An alert without transactions is kept with nulls.  Transaction columns are
    prefixed ``txn_``.
    """
    if alert_id is not None:
        alerts, children = alert_by_id(alerts, alert_id), alert_by_id(children, alert_id)
    detail = children.select("alert_id", *[F.col(c).alias(f"txn_{c}") for c in TRANSACTION_COLUMNS])
    return alert_full(alerts).join(detail, "alert_id", "left")
