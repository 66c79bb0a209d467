"""Batch and stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def event_stream(
    spark: SparkSession,
    location: str,
    source: str = "kafka",
    topic: str = "all-transactions",
    **options: str,
) -> DataFrame:
    """JSON event stream with one string column ``value``.

    ``kafka``: ``location`` is the broker list, ``topic`` one or several names separated
    by commas; reads from the earliest offset.  ``text``: ``location`` is a folder of
    JSON-lines files.
    """
    if source == "kafka":
        stream = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", location)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .options(**options)
            .load()
        )
        return stream.selectExpr("CAST(value AS STRING) AS value")
    return spark.readStream.format("text").options(**options).load(location)


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", **options: str) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", glob).options(**options).parquet(folder)
    )


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; give a schema to avoid an inference pass over the data."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with header and quoted fields.

    Files are split between tasks.  Only with ``multi_line`` may fields hold line breaks; each
    file is then read by one task.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    reader = reader.option("multiLine", multi_line)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_alerts_jdbc(
    spark: SparkSession,
    url: str,
    bounds: tuple,
    table: str = "fraud_alerts",
    partition_column: str = "last_seen",
    partitions: int = 32,
    **properties: str,
) -> DataFrame:
    """Alerts table over JDBC, split on ``partition_column`` between ``bounds``.

    Rows outside the bounds are read too, by the first and the last task.
    """
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=low, upperBound=high,
        numPartitions=partitions, properties=properties,
    )
