"""Feature definitions, in a training form and a serving form.

The two forms differ on purpose (the published system has this skew): the count
divisor, the base of the weekday, the payment default and the scope of the country
flags.  Score with the form the model was trained on, or name the other explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.functions.scoring import simplify_pattern
from fraudlens.schema import (
    HIGH_RISK_COUNTRIES,
    KNOWN_PAYMENT_METHODS,
    NEAR_THRESHOLD_MAX,
    NEAR_THRESHOLD_MIN,
    NIGHT_AFTER_HOUR,
    NIGHT_BEFORE_HOUR,
    RAPID_SESSION_SEC,
)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def countries_differ(origin: str = "country_from", target: str = "country_to") -> Column:
    return _flag(F.col(origin) != F.col(target))


def touches_high_risk(origin: str = "country_from", target: str = "country_to") -> Column:
    hit = [F.coalesce(F.col(c).isin(HIGH_RISK_COUNTRIES), F.lit(False)) for c in (origin, target)]
    return (hit[0] | hit[1]).cast("int")


def near_threshold(amount: Column) -> Column:
    return _flag((amount >= NEAR_THRESHOLD_MIN) & (amount < NEAR_THRESHOLD_MAX))


def rapid(session: Column) -> Column:
    return _flag(session < RAPID_SESSION_SEC)


def at_night(hour: Column) -> Column:
    return (hour < NIGHT_BEFORE_HOUR) | (hour > NIGHT_AFTER_HOUR)


def known_payment(payment: Column) -> Column:
    return F.when(payment.isin(KNOWN_PAYMENT_METHODS), payment).otherwise("credit_card")


def training_features(actors: DataFrame, fill_session_first: bool = True) -> DataFrame:
    """Column-wise features over one row per actor (see ``operators.rollup``).

    ``fill_session_first`` is the order of the batch job: an absent session counts as
    0 seconds and so as rapid.  With False it is filled afterwards and is not rapid.
    """
    session = F.col("session_length_sec")
    quick = rapid(F.coalesce(session, F.lit(0.0)) if fill_session_first else session)
    length = F.coalesce(session, F.lit(0.0))
    amount = F.col("amount").cast("double")
    hour = F.coalesce(F.hour("fraud_first_seen"), F.lit(12))
    weekday = F.dayofweek("fraud_first_seen")
    efficiency = amount / (length + 1)
    if not fill_session_first:
        efficiency = F.when(session.isNotNull(), efficiency)
    return actors.select(
        "actor_id", "fraud_label", "domain", "fraud_pattern", "fraud_first_seen", "timestamp",
        "country_from", "country_to",
        F.coalesce("payment_method", F.lit("unknown")).alias("payment_method"),
        amount.alias("amount"),
        "fraud_txn_count",
        length.alias("session_length_sec"),
        countries_differ().alias("country_mismatch"),
        touches_high_risk().alias("involves_high_risk_country"),
        hour.alias("hour_of_day"),
        F.coalesce(weekday, F.lit(3)).alias("day_of_week"),
        _flag(weekday.isin(1, 7)).alias("is_weekend"),
        near_threshold(F.col("amount")).alias("is_near_threshold"),
        quick.alias("is_rapid_session"),
        F.coalesce(amount / (F.col("fraud_txn_count") + 1), F.lit(0.0)).alias("amount_per_txn"),
        F.coalesce(efficiency, F.lit(0.0)).alias("session_efficiency"),
        (_flag(at_night(F.hour("fraud_first_seen"))) * quick).alias("night_rapid_combo"),
        simplify_pattern("fraud_pattern").alias("fraud_pattern_simplified"),
    )


def serving_features(groups: DataFrame, consistent: bool = False) -> DataFrame:
    """Features of transaction groups (see ``operators.windows.aggregate_transactions``).

    Keeps every input column.  ``consistent=True`` uses the training definitions, so
    that a model sees at scoring time what it saw when it was fitted.
    """
    amount = F.col("total_amount").cast("double")
    count = F.col("transaction_count")
    first_time = F.col("first_timestamp")
    hour = F.hour(first_time)
    if consistent:
        session = F.coalesce(F.col("session_mean_present"), F.lit(0.0))
        weekday = F.dayofweek(first_time)
        weekend = weekday.isin(1, 7)
        payment = F.coalesce(F.col("first_payment_method"), F.lit("unknown"))
        mismatch = countries_differ("first_country_from", "first_country_to")
        high_risk = touches_high_risk("first_country_from", "first_country_to")
        per_txn = amount / (count + 1)
    else:
        session = F.col("session_total") / count
        weekday = F.weekday(first_time) + 1
        weekend = weekday.isin(6, 7)
        payment = known_payment(F.col("opened_by.payment_method"))
        mismatch = F.col("any_country_mismatch")
        high_risk = F.col("any_high_risk_country")
        per_txn = amount / count
    quick = rapid(session)
    computed = {
        "amount": amount,
        "fraud_txn_count": count,
        "session_length_sec": session,
        "country_mismatch": mismatch,
        "involves_high_risk_country": high_risk,
        "is_near_threshold": near_threshold(F.col("total_amount")),
        "is_rapid_session": quick,
        "is_weekend": _flag(weekend),
        "night_rapid_combo": _flag(at_night(hour)) * quick,
        "hour_of_day": hour,
        "day_of_week": weekday,
        "amount_per_txn": per_txn,
        "session_efficiency": amount / (session + 1),
        "payment_method": payment,
        "time_delta_sec": (
            F.unix_micros("last_timestamp") - F.unix_micros("first_timestamp")
        ) / F.lit(1e6),
    }
    return groups.withColumns(computed)
