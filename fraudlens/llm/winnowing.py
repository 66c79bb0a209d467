"""Benchmark decontamination by winnowing.

Of each run of ``width`` consecutive k-gram hashes the smallest is kept, for items and documents
alike, so a span of ``k + width - 1`` words that both share has a fingerprint in common.  The
fingerprints of a document are joined with those of the items; around each hit every window
of the full length is looked up and its words are compared, so no hash decides a result.

The benchmark is a query set: it is taken in blocks of at most ``block_words`` words (about
20 bytes of index a word, sent to every task), and each block runs against all documents.

Defined cases: a null or empty text has no words and no hits; items without words or with a null
text match nothing; an item of fewer words than a window is one window; equal windows of several
items count for each of them; items that share an ``item_id``, or have none, all match and are named
once; repeated documents are judged one by one; a null ``doc_id`` stays null; an empty benchmark
leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraudlens.llm.blocks import (
    STEP, blocks, documents, found_in, gram_hashes, mixed, separators, span_hashes, window_minima, words,
)
from fraudlens.session import fresh_path

#: Words are runs of ASCII letters and digits and of all characters beyond ASCII.
SEPARATOR = separators(bytes(c for c in range(128) if not chr(c).isalnum()))
#: A-Z in lower case, separators as a space.
FOLD = np.array([32 if SEPARATOR[c] else c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
WINDOW, K, WIDTH = 10, 5, 6
BLOCK_WORDS = 1_000_000


class Index(NamedTuple):
    names: list[str | None]  # item ids
    text: bytes  # the items' words, each followed by one space
    start: np.ndarray
    end: np.ndarray
    item: np.ndarray  # of each word
    prints: np.ndarray  # sorted fingerprints
    heads: np.ndarray  # sorted hashes of the first words of short items
    windows: dict[int, tuple[np.ndarray, np.ndarray]]  # length: sorted hashes, word where each begins


def hashes_at(values: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """What gram_hashes has at some positions."""
    out = np.zeros(len(at), np.uint64)
    for j in range(length):
        out = out * STEP + values[at + j]
    return mixed(out)


def fingerprints(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept k-grams; none crosses a row."""
    grams = gram_hashes(hashes, K)
    at = window_minima(grams, WIDTH)
    at = at[row[at] == row[at + K - 1]]
    return at, grams[at]


def build_index(items: list[tuple[str | None, bytes]]) -> Index:
    folded = [FOLD[np.frombuffer(text, np.uint8)].tobytes().split() for _, text in items]
    text = b"".join(word + b" " for item in folded for word in item)
    sizes = np.array([len(x) for x in folded], np.int64)
    data = np.frombuffer(text, np.uint8)
    found = words(data, np.array([0, len(data)]))
    item = np.repeat(np.arange(len(items)), sizes)
    hashes = span_hashes(data, found.start, found.end)
    first = np.concatenate([[0], np.cumsum(sizes)])
    windows = {}
    for length in sorted({min(n, WINDOW) for n in sizes.tolist() if n}):
        full = length == WINDOW
        begins = [np.arange(a, a + (n - length + 1 if full else 1)) for a, n in zip(first, sizes) if (n >= length if full else n == length)]
        at = np.concatenate(begins)
        keys = hashes_at(hashes, at, length)
        order = np.argsort(keys, kind="stable")
        windows[length] = keys[order], at[order]
    short = first[:-1][(sizes > 0) & (sizes < WINDOW)]
    long_enough = sizes[item] >= WINDOW
    at, prints = fingerprints(hashes, item) if len(hashes) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    return Index([name for name, _ in items], text, found.start, found.end, item, np.unique(prints[long_enough[at]]), np.unique(hashes[short]), windows)


def index_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Index]:
    """Indexes of consecutive items, each of at most ``block_words`` words (or one item)."""
    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string").cast("binary").alias("text")).where("text is not null")
    held, size = [], 0
    for name, text in rows.toLocalIterator():
        n = len(FOLD[np.frombuffer(text, np.uint8)].tobytes().split())
        if held and size + n > block_words:
            yield build_index(held)
            held, size = [], 0
        if n:
            held.append((name, bytes(text)))
            size += n
    if held:
        yield build_index(held)


def hits(index: Index, data: np.ndarray, offsets: np.ndarray):
    """Per row: how many words; spans of words hit (row, start, end); pairs (row, item)."""
    folded = FOLD[data]
    found = words(data, offsets, SEPARATOR)
    counts = np.diff(found.first)
    hashes = span_hashes(folded, found.start, found.end)
    candidates = []
    if WINDOW in index.windows and len(hashes) >= WINDOW:
        at, prints = fingerprints(hashes, found.row)
        at = at[found_in(index.prints, prints)]
        candidates.append((WINDOW, np.unique(at[:, None] - np.arange(WIDTH))))
    if len(index.heads):
        at = np.flatnonzero(found_in(index.heads, hashes))
        candidates += [(length, at) for length in index.windows if length < WINDOW]
    spans, pairs = [], set()
    for length, at in candidates:
        at = at[at >= 0]
        at = at[at + length <= found.first[1:][found.row[at]]]
        keys, begins = index.windows[length]
        values = hashes_at(hashes, at, length)
        low, high = np.searchsorted(keys, values), np.searchsorted(keys, values, "right")
        for s, a, b in zip(at[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
            row, seen = int(found.row[s]), b" ".join(folded[found.start[s] : found.end[s + length - 1]].tobytes().split())
            for w in begins[a:b].tolist():
                if index.text[index.start[w] : index.end[w + length - 1]] == seen:
                    spans.append((row, s - int(found.first[row]), s - int(found.first[row]) + length))
                    pairs.add((row, int(index.item[w])))
    return counts, spans, pairs


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


FOUND = "doc_id long, version long, n_words long, spans array<struct<start:int,end:int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _find(index):
    def run(batches):
        for block in blocks(batches):
            counts, spans, pairs = hits(index.value, block.data, block.offsets)
            by_row: dict[int, list] = {}
            for row, a, b in spans:
                by_row.setdefault(row, []).append((a, b))
            items: dict[int, dict] = {}
            for row, item in sorted(pairs):
                items.setdefault(row, {})[index.value.names[item]] = True
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    block.rows.column(0), block.rows.column(2), pa.array(counts, pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in _merged(by_row.get(i, []))] for i in range(n)], _SPANS),
                    pa.array([list(items.get(i, ())) for i in range(n)], pa.list_(pa.string())),
                ],
                ["doc_id", "version", "n_words", "spans", "items"],
            )

    return run


def find_contamination(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_words, spans`` (hit word ranges) and ``items`` found in it."""
    spark = docs.sparkSession
    rows = documents(docs).withColumn("version", F.xxhash64("text"))
    indexes = list(_broadcast(spark, items, block_words))
    passes = [rows.mapInArrow(_find(index), FOUND) for index in indexes]
    if len(passes) == 1:
        return passes[0].drop("version")
    merged = passes[0]
    for found in passes[1:]:
        merged = merged.unionByName(found)
    together = merged.groupBy("doc_id", "version").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        (F.count(F.lit(1)) / len(passes)).cast("int").alias("copies"),
    )
    return together.select("doc_id", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")


def _broadcast(spark: SparkSession, items: DataFrame, block_words: int):
    """Broadcasts of the index blocks; one empty index if there is no item."""
    empty = True
    for index in index_blocks(items, block_words):
        empty = False
        yield spark.sparkContext.broadcast(index)
    if empty:
        yield spark.sparkContext.broadcast(build_index([]))


def words_hit(spans: Column) -> Column:
    """How many words the spans cover; they may overlap."""
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("n"))
    fresh = lambda acc, s: F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["reach"]))
    step = lambda acc, s: F.struct(F.greatest(acc["reach"], s["end"]).alias("reach"), (acc["n"] + fresh(acc, s)).alias("n"))
    return F.aggregate(spans, start, step, lambda acc: acc["n"]).cast("long")


def clean_documents(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any hit: same columns, texts untouched, no shuffle.

    With several blocks of items, what one block leaves is stored and goes to the next.
    """
    spark, left = docs.sparkSession, docs
    for index in _broadcast(spark, items, block_words):
        if left is not docs:
            path = fresh_path(spark, "decontaminated")
            left.write.parquet(path)
            left = spark.read.parquet(path)
        left = left.mapInArrow(_keep(index), docs.schema)
    return left


def _keep(index):
    def run(batches):
        for block in blocks(batches):
            _, spans, _ = hits(index.value, block.data, block.offsets)
            clean = np.ones(block.rows.num_rows, bool)
            clean[[row for row, _, _ in spans]] = False
            yield block.rows.filter(pa.array(clean))

    return run
