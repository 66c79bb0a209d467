"""Audit of how filters interact: what each removes in every order they may be applied in.

Rows are counted by part and by which filters they fail, a table of at most 2 x 2 x ... x 2 cells a
part.  Reshaped to a tensor with one axis a filter (0: passes, 1: fails), every figure of the audit is
a contraction: along each axis the vector ``PASS``, ``FAIL`` or ``ALL`` is applied.  One ``einsum``
computes a figure for all parts of a batch, all orders and all steps.

The rows meet in two shuffles only: the copies of a text by the text's hash, and the decided
(text, id) pairs.  Both are aggregated before they are sent, so a text, an id or a part that holds a
third of all rows costs a reducer one row a map task.

Defined cases: a null text is an empty one and fails only A (and E, as a copy); a null ``lang`` is the part
with the empty name; a null ``doc_id`` neither is a copy nor makes one, and has no labels; rows
that share id and text count one by one, none of them a copy of the other; several labels of one id count
as good (toxic) if any says so; labels of unknown ids are ignored; an empty table has no parts, so no rows.
Texts are identical if their SHA-256 is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import permutations
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 100, 80, 10

PASS, FAIL, ALL = np.array([[1, 0], [0, 1], [1, 1]], np.int64)

AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


# --- Failure conditions -----------------------------------------------------------


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions that one text decides alone."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, n_upper = F.size(words), F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": n_words < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n_words,
        "C": 100 * n_upper > MAX_UPPER_PERCENT * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, cell, n, good, toxic``: rows by the filters A to E they fail.

    Bit 4 of ``cell`` is A, bit 0 is E: the flat index of the tensor's cell.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bits = sum((fails.cast("int") * 2**bit for fails, bit in zip(text_failures(text).values(), (4, 3, 2, 1))), F.lit(0))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("key"), bits.alias("bits"),
    )
    rows = rows.groupBy("key", "doc_id", "part", "bits").agg(F.count("*").alias("n"))
    # By (key, id), not by key: the copies of a text spread over all tasks.
    first = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    cells = (
        rows.join(first, ["key", "doc_id"], "left")
        .select("doc_id", "part", (F.col("bits") + copy.cast("int")).alias("cell"), "n")
        .groupBy("doc_id", "part", "cell").agg(F.sum("n").alias("n"))
    )
    says = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)).cast("long")).alias(name)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
    known = known.groupBy("doc_id").agg(says("quality"), says("toxic"))
    lost = lambda name: F.sum(F.col("n") * F.coalesce(name, F.lit(0)))
    return cells.join(known, "doc_id", "left").groupBy("part", "cell").agg(
        F.sum("n").alias("n"), lost("quality").alias("good"), lost("toxic").alias("toxic")
    )


# --- Contractions -----------------------------------------------------------------


def selections(n_filters: int) -> dict[str, np.ndarray]:
    """For every order and step, which vector each axis is contracted with: orders x steps x axes x 2."""
    orders = list(permutations(range(n_filters)))
    shape = (len(orders), n_filters, n_filters, 2)
    kept, removed = np.broadcast_to(ALL, shape).copy(), np.broadcast_to(ALL, shape).copy()
    failing, alone = kept.copy(), np.broadcast_to(PASS, shape).copy()
    for o, order in enumerate(orders):
        for step, axis in enumerate(order):
            kept[o, step, list(order[: step + 1])] = PASS
            removed[o, step, list(order[:step])] = PASS
            for figure in (removed, failing, alone):
                figure[o, step, axis] = FAIL
    return {"kept": kept, "removed": removed, "failing": failing, "alone": alone}


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """parts x 2 x ... x 2 counts against chosen vectors, to parts x orders x steps.  Exact: all integers."""
    axes = ascii_lowercase[: chosen.shape[2]]
    spec = f"P{axes}," + ",".join(f"OS{a}" for a in axes) + "->POS"
    return np.einsum(spec, tensor, *np.moveaxis(chosen, 2, 0), optimize="greedy")


def figures(n: np.ndarray, good: np.ndarray, toxic: np.ndarray, filters: int) -> dict[str, np.ndarray]:
    """All figures from the tensors of rows, good rows and toxic rows."""
    chosen = selections(filters)
    removed = contract(n, chosen["removed"])
    orders = np.array(list(permutations(range(filters))))
    total = np.zeros((len(n), filters), np.int64)  # of each filter, over all orders
    for step in range(filters):
        np.add.at(total, (slice(None), orders[:, step]), removed[:, :, step])
    return {
        "kept": contract(n, chosen["kept"]), "removed": removed,
        "redundant": contract(n, chosen["failing"]) - removed, "unique_fails": contract(n, chosen["alone"]),
        "good_lost": contract(good, chosen["removed"]), "toxic_lost": contract(toxic, chosen["removed"]),
        "shapley": total[:, orders],
    }


def audit(counts: DataFrame, filters: Sequence[str] = "ABCDE") -> DataFrame:
    """Every order of ``filters`` and every step, one row each per part, zeros included.

    ``counts`` has ``part, cell, n, good, toxic``, at most one row a part and cell; the first filter is
    the highest bit of ``cell``.  A part has (number of filters)! x filters rows.
    """
    k, names = len(filters), ["".join(o) for o in permutations(filters)]
    cells = F.collect_list(F.struct("cell", "n", "good", "toxic"))  # at most 2 ** k entries
    parts = counts.groupBy("part").agg(cells.alias("cells"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                listed = piece.column(1)
                row, flat = listed.value_parent_indices().to_numpy(), listed.flatten()
                tensors = []
                for name in ("n", "good", "toxic"):
                    tensor = np.zeros((len(piece), 2**k), np.int64)
                    tensor[row, flat.field("cell").to_numpy()] = flat.field(name).to_numpy()
                    tensors.append(tensor.reshape(-1, *[2] * k))
                found = figures(*tensors, k)
                each = len(names) * k
                part = piece.column(0).take(pa.array(np.repeat(np.arange(len(piece)), each)))
                order = pa.array(np.tile(np.repeat(names, k), len(piece)), pa.string())
                step = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(piece) * len(names)))
                yield pa.RecordBatch.from_arrays(
                    [part.cast(pa.string()), order, step, *[pa.array(x.ravel()) for x in found.values()]],
                    ["part", "filter_order", "step", *found],
                )

    return parts.mapInArrow(run, AUDIT)
