"""Per-actor event-time windows.

A window is kept as one row of mergeable aggregates; its transactions stay separate
rows that share the window's key.  No group is ever collected into an array, so a
window or an actor that holds a large part of the data costs its reducer one row per
map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.functions.features import countries_differ, touches_high_risk
from fraudlens.functions.parsing import iso_instant
from fraudlens.schema import DETAIL_COLUMNS, WINDOW_DURATION

FIRST_FIELDS = ["transaction_id", "timestamp", "domain", "ip_address", *DETAIL_COLUMNS]


def arrival_order() -> Column:
    """Transactions are ordered by time, ties by id."""
    return F.struct("timestamp", "transaction_id")


def earliest_present(column: str) -> Column:
    """The first non-null value in arrival order."""
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), arrival_order()))


def detail_aggregates() -> list[Column]:
    """What an alert needs and scoring does not: patterns and first attributes.

    Together they cost several times the other aggregates.
    """
    fraud_pattern = F.when(F.col("is_fraud"), F.col("pattern"))
    return [
        F.mode(fraud_pattern, True).alias("top_fraud_pattern"),
        F.collect_set(fraud_pattern).alias("fraud_patterns"),
        F.min_by(F.struct(*FIRST_FIELDS), arrival_order()).alias("first_txn"),
    ]


def aggregate_transactions(tx: DataFrame, *keys: Column | str, more: tuple[Column, ...] = ()) -> DataFrame:
    """One row of mergeable aggregates per key, and ``more`` of them.  Unused columns are pruned by Catalyst."""
    return tx.groupBy(*keys).agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        F.sum(F.coalesce("session_length_sec", F.lit(0))).alias("session_total"),
        F.avg("session_length_sec").alias("session_mean_present"),
        F.max(countries_differ()).alias("any_country_mismatch"),
        F.max(touches_high_risk()).alias("any_high_risk_country"),
        F.count_if(F.col("is_fraud")).alias("fraud_count"),
        F.min_by(F.struct("domain", "payment_method", "transaction_id"), arrival_order()).alias("opened_by"),
        *detail_aggregates(),
        earliest_present("payment_method").alias("first_payment_method"),
        earliest_present("country_from").alias("first_country_from"),
        earliest_present("country_to").alias("first_country_to"),
        *more,
    )


def window_id(actor: Column | str = "actor_id", start: Column | str = "window_start") -> Column:
    return F.concat_ws(":", actor, F.unix_seconds(start).cast("string"))


def _flatten(windowed: DataFrame) -> DataFrame:
    return windowed.withColumns(
        {
            "window_start": F.col("window.start"),
            "window_end": F.col("window.end"),
            "window_seconds": F.unix_seconds("window.end") - F.unix_seconds("window.start"),
            "alert_id": window_id(start=F.col("window.start")),
            "domain": F.col("opened_by.domain"),
        }
    )


def tumbling_windows(
    tx: DataFrame, duration: str = WINDOW_DURATION, time_column: str = "timestamp", more: tuple[Column, ...] = ()
) -> DataFrame:
    """Aggregate each actor's transactions over tumbling event-time windows.

    On a stream, give the input a watermark on ``time_column`` first; a window is then
    emitted once, when the watermark passes its end.  ``window`` stays in the output
    because it carries the watermark.
    """
    return _flatten(aggregate_transactions(tx, "actor_id", F.window(time_column, duration), more=more))


def window_members(
    tx: DataFrame, duration: str = WINDOW_DURATION, time_column: str = "timestamp"
) -> DataFrame:
    """Every transaction with the key of the window it falls in."""
    slot = F.window(time_column, duration)
    return tx.withColumn("window", slot).withColumns(
        {
            "window_start": F.col("window.start"),
            "alert_id": window_id(start=F.col("window.start")),
        }
    )


def window_details(members: DataFrame) -> DataFrame:
    """The detail aggregates per window, from its transactions (see ``window_members``)."""
    return members.groupBy("alert_id").agg(*detail_aggregates())


def scoring_requests(windows: DataFrame) -> DataFrame:
    count, total = F.col("transaction_count"), F.col("total_amount").cast("double")
    return windows.select(
        "actor_id", "domain", "transaction_count",
        total.alias("total_amount"),
        F.when(count > 0, total / count).otherwise(0.0).alias("avg_amount"),
        F.col("window_seconds").alias("time_delta_sec"),
        iso_instant("window_start").alias("window_start"),
        iso_instant("window_end").alias("window_end"),
    )
