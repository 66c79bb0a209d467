"""Text and JSON to typed columns, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fraudlens.schema import MONEY, TRANSACTION_COLUMNS, WIRE_SCHEMA


# ISO-8601 with microseconds; the JSON writer's default would cut them to milliseconds.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def iso_timestamp(text: Column | str) -> Column:
    """ISO-8601 text to a timestamp; unreadable text becomes null."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def iso_instant(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text column to typed transactions plus ``reject_reason``.

    Unknown properties are ignored.  A row that cannot be used keeps its raw text
    and gets a reason instead of stopping the job.
    """
    event = F.from_json(
        F.col(value).cast("string"), WIRE_SCHEMA,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    # ``inline`` parses each record once; a projection would be repeated by every filter
    # that the optimizer moves below it.
    parsed = raw.select(F.col(value).cast("string").alias("raw"), F.inline(F.array(event)))
    fields = parsed.withColumns(
        {"timestamp": iso_timestamp("timestamp"), "amount": F.col("amount").cast(MONEY)}
    )
    reason = (
        F.when(F.col("raw").isNull() | (F.trim("raw") == "") | F.col("_corrupt").isNotNull(), "malformed")
        .when(F.col("timestamp").isNull(), "bad_timestamp")
        .when(F.col("actor_id").isNull(), "missing_actor")
        .when(F.col("amount").isNull(), "missing_amount")
    )
    return fields.withColumn("reject_reason", reason).drop("_corrupt")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).select(*TRANSACTION_COLUMNS)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select("raw", "reject_reason")


# Null fields are written, so every record has the same shape.
JSON_OPTIONS = {"timestampFormat": TIMESTAMP_FORMAT, "ignoreNullFields": "false"}


def to_snake_json(df: DataFrame, *columns: str) -> Column:
    return F.to_json(F.struct(*(columns or df.columns)), JSON_OPTIONS)


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part.capitalize() for part in rest)


def to_camel_json(df: DataFrame, *columns: str) -> Column:
    fields = [F.col(c).alias(camel(c)) for c in (columns or df.columns)]
    return F.to_json(F.struct(*fields), JSON_OPTIONS)


def parse_id_list(text: Column | str) -> Column:
    """A JSON array held in a string column."""
    return F.from_json(text, T.ArrayType(T.StringType()))
