"""Repeated word windows through prefix-partitioned suffix trees.

Suffixes meet by a prefix of their words: six for a start, a whole window where six words are not
enough to keep a group small (see ``repeats``).  Each group's part of the suffix tree is built
from the top: a node's suffixes are divided by their next word until a node has a single
leaf or is as deep as a window.  Inner nodes that deep are the repeats; all their leaves but
the earliest lose the window's words.  The nodes of one depth are divided together.

Only suffixes of text around repeated k-grams enter the trees; why that loses nothing is said in
``repeats``, with the defined cases.  A null or empty text has no words and loses none; an empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from fraudlens.llm.repeats import divided, without_repeats, word_windows


def deep_nodes(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves (text, first word) below the nodes of depth ``length``, with the node's number."""
    split = [t.split() for t in texts]
    number: dict[bytes, int] = {}
    word = np.array([number.setdefault(w, len(number)) for own in split for w in own], np.int64)
    first = np.concatenate([[0], np.cumsum([len(own) for own in split])])
    starts = np.maximum(np.diff(first) - length + 1, 0)  # suffixes that are long enough
    owner = np.repeat(np.arange(len(texts)), starts)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    leaf, node = np.arange(len(owner)), np.zeros(len(owner), np.int64)
    base = first[:-1][owner] + start
    for depth in range(length):
        stay, node = divided(node, word[base[leaf] + depth])
        leaf = leaf[stay]
    return owner[leaf], start[leaf], node


def remove_repeated_windows(docs: DataFrame, length: int = 20) -> DataFrame:
    """One row per document: ``doc_id, n_tokens`` (words), ``n_removed, n_spans, kept``.

    A word goes if it lies in a window of ``length`` words that also starts earlier; windows are
    judged on the input.  ``kept`` has the other words, one space between them, as UTF-8.
    """
    return without_repeats(
        docs, word_windows(length), lambda texts: texts.repartition("lead").sortWithinPartitions("lead"), deep_nodes
    )
