"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the engine relies on.

    Event times are UTC, and stored as counts of microseconds: the other form (INT96) has no bounds in
    Parquet files, so filters on times could not skip anything.  Generated methods above 8000 bytes are not compiled by the JVM,
    so a stage with a very wide projection runs faster without whole-stage code.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a folder of its own; on a cluster the
    executors could not read one.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        root = configured
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
    else:
        root = context.getCheckpointDir()
        if root is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="fraudlens-")
            context.setCheckpointDir(root)
    return root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/fraudlens/{name}-{uuid.uuid4().hex}"
