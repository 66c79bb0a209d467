"""Connected components of a graph of long ids, as rounds of joins on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fraudlens.session import fresh_path


def _stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again: short lineage that outlives an executor."""
    path = fresh_path(df.sparkSession, "edges")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _hang(edges: DataFrame, to_larger: bool) -> DataFrame:
    """Link the neighbours of each node to the least of them and the node.

    ``to_larger``: of each node its larger neighbours are linked (large star), otherwise the node
    itself and its smaller ones (small star).
    """
    near = edges.select("a", "b")
    if to_larger:
        near = near.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = near.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    linked = near.join(least, "a")
    if to_larger:
        pairs = linked.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        pairs = linked.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))
    return pairs.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of an edge and the least id it can reach.

    ``edges`` has long columns ``a`` and ``b``; direction, repeats and loops do not matter.
    Rounds of large and small stars (logarithmic in the size of a component) go on until
    the edges stay the same; the driver sees one checksum a round.
    """
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current, last = _stored(down), None
    while True:
        sums = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if sums == last:
            break
        last = sums
        current = _stored(_hang(_hang(current, True), False))
    least = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(least)
