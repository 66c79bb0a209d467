"""Vectorised helpers over blocks of texts inside Arrow tasks.

A block is a run of whole rows of about ``limit`` bytes (a longer text is a block of its own),
so a task holds a few blocks' worth of arrays however large its partition is.
Hashes here are 64 bits wide; where equality decides a result, callers compare the texts or
two independent hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: White space that ends a word: space, tab, line feed, vertical tab, form feed, return.
SPACES = b" \t\n\x0b\x0c\r"
STEP = np.uint64(0x9E3779B97F4A7C15)
LIMIT = 1 << 20
#: Longest run of powers that a worker keeps.
KEPT = (8 << 20) + 1


class Block(NamedTuple):
    rows: pa.RecordBatch
    data: np.ndarray  # the bytes of all texts
    offsets: np.ndarray  # where the rows start; one more entry than rows

    def texts(self) -> list[bytes]:
        whole, cuts = self.data.tobytes(), self.offsets.tolist()
        return [whole[a:b] for a, b in zip(cuts, cuts[1:])]


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # index of each row's first word; one more entry than rows


def binary(column: Column) -> Column:
    """Text as bytes, null as empty."""
    return F.coalesce(column.cast("string").cast("binary"), F.lit(b""))


def documents(docs: DataFrame) -> DataFrame:
    """The two columns that tasks need; other columns stay out of Python."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary(F.col("text")).alias("text"))


def blocks(batches: Iterable[pa.RecordBatch], limit: int = LIMIT, text: str = "text") -> Iterator[Block]:
    """The blocks of a task.  When they end, Arrow gives back what it holds: the worker lives on for other stages."""
    try:
        yield from _blocks(batches, limit, text)
    finally:
        pa.default_memory_pool().release_unused()


def _blocks(batches: Iterable[pa.RecordBatch], limit: int, text: str) -> Iterator[Block]:
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            cuts = offsets[at : end + 1]
            yield Block(batch.slice(at, end - at), data[cuts[0] : cuts[-1]], cuts - cuts[0])
            at = end


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


IS_SPACE = separators(SPACES)


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = IS_SPACE) -> Words:
    """Maximal runs of bytes that are no separators; runs end with their row."""
    inside = ~separator[data]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    before[cuts] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, row, first)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = LIMIT + 1 if n <= LIMIT + 1 else max(n, KEPT)
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            run = np.full(size, b, np.uint64)
            run[0] = 1
            made.append(np.cumprod(run, dtype=np.uint64))
        if n > KEPT:  # a giant text: not kept
            return made[0][:n], made[1][:n]
        _POWERS[base] = (made[0], made[1])
    up, down = _POWERS[base]
    return up[:n], down[:n]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = 0x2545F4914F6CDD1D) -> np.ndarray:
    """A hash of each span values[start:end], the same wherever the span stands."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:], dtype=np.uint64)
    found = mixed((total[end] - total[start]) * down[start])
    return mixed(found + (end - start).astype(np.uint64) * STEP)


def gram_hashes(values: np.ndarray, k: int, step: np.uint64 = STEP) -> np.ndarray:
    """A hash of every k consecutive values, crossing rows where they stand."""
    n = max(len(values) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= step
        out += values[j : j + n]
    return mixed(out)


def _sliding(best, values: np.ndarray, width: int) -> np.ndarray:
    """best over every window of ``width`` values: windows that double, then overlap."""
    span = 1
    while span < width:
        step = min(span, width - span)
        values = best(values[: len(values) - step], values[step:])
        span += step
    return values


def window_minima(order: np.ndarray, width: int) -> np.ndarray:
    """Positions whose value is the smallest of some window of ``width``; all of equal ones.

    A position is one if it equals the largest of the minima of the windows that cover it.
    """
    if len(order) < width or not len(order):
        return np.zeros(0, np.int64)
    least = _sliding(np.minimum, order, width)
    edge = np.zeros(width - 1, order.dtype)
    return np.flatnonzero(order == _sliding(np.maximum, np.concatenate([edge, least, edge]), width))


def found_in(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are in the sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values
