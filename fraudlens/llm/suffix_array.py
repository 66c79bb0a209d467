"""Repeated byte windows through a range-partitioned suffix array.

Splitters sampled from the leading bytes range-partition the suffixes; a bucket sorts its
suffixes by multikey quicksort, eight bytes at a time: suffixes that agree so far are divided by
their next eight bytes, and those that stand alone leave the sort.  Suffixes that agree over a
whole window are equal; all but the earliest lose it.  Splitters fall between different leads, so
equal windows never lie on both sides of a boundary; within a bucket the comparison runs across the
chunks it is read in, up to the next lead.

Only suffixes of text around repeated k-grams are sorted; why that loses nothing is said in
``repeats``, with the defined cases.  Texts are UTF-8 bytes, a null text is empty; matches never
cross documents; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from fraudlens.llm.repeats import byte_windows, divided, without_repeats

KEY = 8


def equal_suffixes(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes (text, start) that share their first ``length`` bytes with others, and their group."""
    size = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(size) - size
    data = np.frombuffer(b"".join(texts) + bytes(KEY), np.uint8)
    key = np.zeros(len(data) - KEY + 1, np.uint64)  # the next eight bytes at every place
    for j in range(KEY):
        key = key << np.uint64(8) | data[j : j + len(key)]
    starts = np.maximum(size - length + 1, 0)
    owner = np.repeat(np.arange(len(texts)), starts)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    member, group = np.arange(len(owner)), np.zeros(len(owner), np.int64)
    base = first[owner] + start
    for depth in range(0, length, KEY):
        rest = np.uint64(8 * max(KEY - (length - depth), 0))  # the last key ends with the window
        stay, group = divided(group, key[base[member] + depth] >> rest)
        member = member[stay]
    return owner[member], start[member], group


def remove_repeated_windows(docs: DataFrame, length: int = 100) -> DataFrame:
    """One row per document: ``doc_id, n_tokens`` (bytes), ``n_removed, n_spans, kept``.

    A byte goes if it lies in a string of ``length`` bytes that also starts earlier; strings are
    judged on the input.  ``kept`` has the remaining bytes.
    """
    return without_repeats(
        docs, byte_windows(length), lambda texts: texts.repartitionByRange("lead").sortWithinPartitions("lead"), equal_suffixes
    )
