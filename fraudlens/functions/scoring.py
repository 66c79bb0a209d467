"""Scalar rules over scores, patterns and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraudlens.schema import PATTERNS, SEVERITY_BANDS, SEVERITY_COLOURS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def score_from_confidence(confidence: Column | str) -> Column:
    """Truncates: 0.29 * 100 is 28.99…, hence 28."""
    return (_col(confidence) * 100).cast("int")


def severity(score: Column | str) -> Column:
    (top, name), *rest = SEVERITY_BANDS
    banded = F.when(_col(score) >= top, name)
    for bound, label in rest:
        banded = banded.when(_col(score) >= bound, label)
    return banded.otherwise("LOW")


def severity_colour(label: Column | str) -> Column:
    pairs = [F.lit(x) for pair in SEVERITY_COLOURS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(_col(label))), F.lit("secondary"))


def minute_label(seconds: Column | str) -> Column:
    return F.concat(F.floor(_col(seconds) / 60).cast("string"), F.lit("m"))


def is_fraud_pattern(pattern: Column | str) -> Column:
    return _col(pattern).startswith("fraud_")


def simplify_pattern(pattern: Column | str) -> Column:
    return F.when(_col(pattern).startswith("regular_"), "regular").otherwise(_col(pattern))


def alert_type(top_fraud_pattern: Column | str) -> Column:
    return F.coalesce(
        F.replace(_col(top_fraud_pattern), F.lit("fraud_"), F.lit("")), F.lit("suspicious_activity")
    )


def detected_patterns(fraud_patterns: Column | str) -> Column:
    return F.array_sort(F.array_remove(_col(fraud_patterns), "regular"))


def decode_label(index: Column | str, labels: list[str]) -> Column:
    """Class index to its name; an index beyond the list is ``unknown``."""
    names = F.array(*[F.lit(x) for x in labels])
    return F.coalesce(F.get(names, _col(index).cast("int")), F.lit("unknown"))


def pattern_dimension(spark: SparkSession, domain: str | None = None) -> DataFrame:
    """The fixed pattern catalogue: 16 patterns over three domains."""
    rows = [(p, d) for d, names in PATTERNS.items() for p in names if domain in (None, d)]
    table = spark.createDataFrame(rows, "pattern string, domain string")
    return table.withColumn("is_fraud", is_fraud_pattern("pattern"))
