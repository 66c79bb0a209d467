"""Alert velocity over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fraudlens.functions.scoring import minute_label

# Most buckets of a domain that one task puts in order.
SEGMENT = 100_000


def velocity_buckets(alerts: DataFrame, bucket_seconds: int = 5) -> DataFrame:
    """Alerts and mean score per domain and time bucket since the first alert.

    The first time is a scalar subquery.  The mean is rounded half up to one decimal in
    integer arithmetic, so it does not depend on summation order.
    """
    start = alerts.agg(F.min("created_at").alias("start")).scalar()
    elapsed = F.unix_micros("created_at") - F.unix_micros(start)
    width = bucket_seconds * 1_000_000
    bucketed = alerts.select(
        "domain", "fraud_score", "created_at",
        ((elapsed - F.pmod(elapsed, F.lit(width))) / 1_000_000).alias("x"),
    )
    return (
        bucketed.groupBy("domain", "x")
        .agg(
            F.count("*").alias("y1_velocity"),
            F.sum(F.col("fraud_score").cast("long")).alias("_score_sum"),
            F.min("created_at").alias("bucket_start"),
            F.max("created_at").alias("bucket_end"),
        )
        .withColumn("y2_avg_score", F.expr("((20 * _score_sum + y1_velocity) div (2 * y1_velocity)) / 10"))
        .drop("_score_sum")
    )


def trend_status(current: Column, previous_sum: Column, previous_rows: Column) -> Column:
    """Compared in whole numbers: more than 1.5 times, more than 1.1 times the mean."""
    scaled = 10 * current * previous_rows
    return (
        F.when(previous_sum.isNull(), "BASELINE")
        .when(scaled > 15 * previous_sum, "SPIKE")
        .when(scaled > 11 * previous_sum, "TRENDING_UP")
        .otherwise("STABLE")
    )


def _running(buckets: DataFrame, bucket_seconds: int) -> DataFrame:
    """Buckets with their number (from 1) and running count per domain.

    A segment is a stretch of time with at most ``SEGMENT`` buckets.  Segments are added up
    separately and shifted by the totals of the domain's earlier ones, of which there are few.
    """
    cell = F.floor(F.col("x") / (bucket_seconds * SEGMENT)).alias("_segment")
    rows = buckets.select("domain", "x", "y1_velocity", "y2_avg_score", cell)
    inside = Window.partitionBy("domain", "_segment").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("domain").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy("domain", "_segment")
        .agg(F.count("*").alias("_rows"), F.sum("y1_velocity").alias("_alerts"))
        .select(
            F.col("domain").alias("_domain"), F.col("_segment").alias("_cell"),
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_rows", "_alerts")],
        )
    )
    own = rows.select(
        "*", F.row_number().over(inside).alias("_number"), F.sum("y1_velocity").over(inside).alias("_sum")
    )
    same = F.col("domain").eqNullSafe(F.col("_domain")) & (F.col("_segment") == F.col("_cell"))
    return own.join(before, same).select(
        "domain", "x", "y1_velocity", "y2_avg_score",
        (F.col("_number") + F.col("_rows_before")).alias("_place"),
        (F.col("_sum") + F.col("_alerts_before")).alias("y3_cumulative"),
    )


def velocity(alerts: DataFrame, bucket_seconds: int = 5, trend_rows: int = 1) -> DataFrame:
    """Velocity series per domain: count, mean score, running count and trend.

    ``trend_rows=1`` compares with the previous bucket; a larger value with the mean of
    that many previous buckets.  Their sum is a difference of two running counts, so each bucket
    meets the one ``trend_rows + 1`` places before it in an equi-join on (domain, place); no
    task orders a whole domain.
    """
    return velocity_series(velocity_buckets(alerts, bucket_seconds), bucket_seconds, trend_rows)


def velocity_series(buckets: DataFrame, bucket_seconds: int, trend_rows: int = 1) -> DataFrame:
    """The series of buckets (see ``velocity_buckets``), however they were counted."""
    series = _running(buckets, bucket_seconds)
    start = series.select(
        F.col("domain").alias("_domain"), (F.col("_place") + trend_rows + 1).alias("_at"),
        F.col("y3_cumulative").alias("_start"),
    )
    same = F.col("domain").eqNullSafe(F.col("_domain")) & (F.col("_place") == F.col("_at"))
    previous_rows = F.least(F.col("_place") - 1, F.lit(trend_rows))
    previous_sum = F.col("y3_cumulative") - F.col("y1_velocity") - F.coalesce("_start", F.lit(0))
    status = trend_status(F.col("y1_velocity"), F.when(F.col("_place") > 1, previous_sum), previous_rows)
    return series.join(start, same, "left").select(
        "domain", "x", "y1_velocity", "y2_avg_score", "y3_cumulative", status.alias("trend_status")
    )


def velocity_ordered(alerts: DataFrame, bucket_seconds: int = 5, trend_rows: int = 1) -> DataFrame:
    return velocity(alerts, bucket_seconds, trend_rows).orderBy("domain", "x")


def last_points(series: DataFrame, k: int = 15) -> DataFrame:
    newest = Window.partitionBy("domain").orderBy(F.desc("x"))
    return (
        series.withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") <= k)
        .drop("_rn")
        .withColumn("label", minute_label("x"))
    )


def velocity_summary(alerts: DataFrame, bucket_seconds: int = 5) -> DataFrame:
    """Totals of the series; the same as counting its points."""
    return alerts.agg(
        F.lit(bucket_seconds).alias("bucket_size_seconds"),
        F.count("*").alias("total_alerts"),
        F.array_sort(F.collect_set("domain")).alias("domains"),
    )
