"""What the suffix-tree and suffix-array operators share: which suffixes to look at, and cutting.

A window is ``length`` consecutive tokens of one text.  Sorting every suffix of a corpus would move
its size times the window length, so only suffixes that can matter are taken on:

1. Of every window the k-gram with the smallest hash is an anchor, so equal windows have an anchor at
   the same place, and few suffixes (about 2 in ``length - k``) begin at one.  An anchor's
   surroundings are the windows whose smallest k-gram it is.  k-grams that are frequent in a
   bounded sample come last in the order, so a common line hardly ever gathers anchors; the order
   only has to be the same everywhere, so no result depends on the sample.
2. Anchors meet by their k-gram's hash.  Of those with equal surroundings only the earliest can hold
   a first occurrence; the windows of the others go.  Tasks settle their own equal ones first, so a
   group of copies brings one row a block.
3. A k-gram with one kind of surroundings is settled.  Otherwise the earliest of each kind sends its
   surroundings, as text, to the exact comparison of the operator, dealt by the suffix's leading
   tokens.  A k-gram with more than ``CROWD`` kinds sends its windows one by one: such a prefix is
   as long as a window, so equal windows are one key, and their earliest place is a minimum that
   tasks combine before the shuffle.  However often a window occurs, it is gathered nowhere.
4. What each document loses comes back as spans, and the texts are cut.

Order is (doc_id, hash of the text, position); a null ``doc_id`` comes first.  Rows that share id and text
are one document; rows that share only the id are told apart by their texts.  Two surroundings
count as equal if two independent 64-bit hashes agree (k-gram and surroundings); everything else
compares tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.blocks import Block, binary, blocks, mixed, span_hashes, window_minima, words
from fraudlens.session import fresh_path

CROWD, HELD, BLOCK = 4096, 10_000, 1 << 20
FIRST_ID = -(1 << 63)


class Alphabet(NamedTuple):
    """What a token is: values to hash, where each row's tokens begin, and texts of token ranges."""

    length: int
    k: int
    values: Callable[[Block], tuple[np.ndarray, np.ndarray]]
    split: Callable[[bytes], "bytes | list[bytes]"]
    joined: Callable[["bytes | list[bytes]"], bytes]


def _byte_values(block: Block):
    return block.data, block.offsets


def _word_values(block: Block):
    found = words(block.data, block.offsets)
    return span_hashes(block.data, found.start, found.end), found.first


def byte_windows(length: int = 100, k: int = 32) -> Alphabet:
    return Alphabet(length, min(k, length), _byte_values, lambda text: text, lambda part: part)


def word_windows(length: int = 20, k: int = 6) -> Alphabet:
    return Alphabet(length, min(k, length), _word_values, bytes.split, b" ".join)


def _docs(docs: DataFrame) -> DataFrame:
    text = binary(F.col("text"))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)).alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"))


# --- 1: anchors -----------------------------------------------------------------

ANCHORS = "gram long, around long, doc long, version long, at int, low int, high int, settled boolean"
PLACES = ["doc", "version", "at", "low", "high"]
SAMPLE, FREQUENT, SLOTS = 1000, 0.01, 1 << 20


def grams_of(values: np.ndarray, k: int) -> np.ndarray:
    at = np.arange(max(len(values) - k + 1, 0))
    return span_hashes(values, at, at + k, 0x9E3779B97F4A7C55)


def frequent_grams(rows: DataFrame, alphabet: Alphabet) -> np.ndarray:
    """Marks the slots of k-grams that at least ``FREQUENT`` of ``SAMPLE`` documents share."""
    table, seen = np.zeros(SLOTS, bool), []
    texts = [bytes(r[0]) for r in rows.select("text").limit(SAMPLE).collect()]
    for block in blocks([pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])]):
        values, first = alphabet.values(block)
        row = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
        grams = grams_of(values, alphabet.k) % np.uint64(SLOTS)
        seen.append(np.unique(grams << np.uint64(32) | row[: len(grams)]) >> np.uint64(32))
    if seen:
        slot, count = np.unique(np.concatenate(seen), return_counts=True)
        table[slot[count >= max(FREQUENT * len(texts), 4)]] = True
    return table


def _nearest_smaller(at: np.ndarray, order: np.ndarray, width: int, side: int, far: np.ndarray) -> np.ndarray:
    """The place of the next anchor on a side that is smaller, within a window; else ``far``."""
    out, open_, step = far.copy(), np.arange(len(at)), 1
    while len(open_):
        other = open_ + side * step
        open_ = open_[(other >= 0) & (other < len(at))]
        other = open_ + side * step
        near = np.abs(at[other] - at[open_]) < width
        open_, other = open_[near], other[near]
        smaller = order[other] < order[open_]
        out[open_[smaller]] = at[other[smaller]]
        open_, step = open_[~smaller], step + 1
    return out


def anchors_of(values: np.ndarray, first: np.ndarray, length: int, k: int, frequent: np.ndarray):
    """Rows, places in the row, bounds of the surroundings, and both hashes of a block's anchors."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    width = length - k + 1
    grams = grams_of(values, k)
    order = grams >> np.uint64(1) | frequent[grams % np.uint64(SLOTS)].astype(np.uint64) << np.uint64(63)
    at = window_minima(order, width)
    at = at[row[at] == row[at + k - 1]]
    begin, end = first[row[at]], first[row[at] + 1]
    left = _nearest_smaller(at, order[at], width, -1, at - width)
    right = _nearest_smaller(at, order[at], width, 1, at + width)
    low, high = np.maximum(begin, left + 1), np.minimum(end, right - 1 + k)
    holds = high - low >= length
    at, low, high, begin = at[holds], low[holds], high[holds], begin[holds]
    around = mixed(span_hashes(values, low, high) + (at - low).astype(np.uint64))
    return row[at], at - begin, low - begin, high - begin, grams[at], around


def _find(alphabet: Alphabet, frequent):
    def run(batches):
        for block in blocks(batches, BLOCK):
            values, first = alphabet.values(block)
            row, at, low, high, grams, around = anchors_of(values, first, alphabet.length, alphabet.k, frequent.value)
            if not len(row):
                continue
            doc, version = (block.rows.column(i).to_numpy(zero_copy_only=False)[row] for i in (0, 1))
            group = np.unique(mixed(grams) ^ around, return_inverse=True)[1]
            settled = np.zeros(len(row), bool)
            settled[later_ones(group, doc, version, at)] = True
            # settled rows are dealt anywhere
            grams[settled] = mixed(mixed(doc[settled].view(np.uint64)) + at[settled].astype(np.uint64))
            columns = [grams.view(np.int64), around.view(np.int64), doc, version, *(x.astype(np.int32) for x in (at, low, high)), settled]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "around", *PLACES, "settled"])

    return run


# --- 2: equal surroundings ------------------------------------------------------


def _settle(batches):
    """Spans of windows that occur earlier, and surroundings to compare (``open``).

    Rows come sorted by gram, surroundings and place; the state between batches is two rows.
    """
    kept = None  # first row of the gram, first row of its surroundings, whether the former was sent
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        lead = 0
        if kept is not None:  # put the carried rows in front
            columns = [np.concatenate([k, c]) for k, c in zip(kept[0], columns)]
            lead = len(kept[0][0])
        gram, around, doc, version, at = columns[:5]
        settled = columns[7].astype(bool)
        n = len(gram)
        new_gram, new_kind = np.ones(n, bool), np.ones(n, bool)
        new_gram[1:] = gram[1:] != gram[:-1]
        new_kind[1:] = new_gram[1:] | (around[1:] != around[:-1])
        count = np.arange(n)
        gram_first = np.maximum.accumulate(np.where(new_gram, count, 0))
        kind_first = np.maximum.accumulate(np.where(new_kind, count, 0))
        later = (doc != doc[kind_first]) | (version != version[kind_first]) | (at != at[kind_first])
        more = np.flatnonzero(new_kind & ~new_gram)
        opened = np.zeros(n, bool)
        opened[more] = True
        opened[gram_first[more]] = True
        sent = kept[1] if kept is not None else np.zeros(0, bool)
        opened[:lead] &= ~sent
        later[:lead] = False
        later |= settled & (np.arange(n) >= lead)
        out = np.flatnonzero(later | opened)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[out]) for c in (gram, *columns[2:7])] + [pa.array(opened[out])], ["gram", *PLACES, "open"]
        )
        ends = np.unique([gram_first[-1], kind_first[-1]])
        was = np.zeros(n, bool)
        was[:lead] = sent
        kept = [c[ends] for c in columns], (was | opened)[ends]


# --- 3: surroundings as text ----------------------------------------------------

#: ``text`` is null where ``lead`` is a whole window.
TEXTS = "lead binary, doc long, version long, low int, text binary"


def _surroundings(alphabet: Alphabet):
    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                tokens = alphabet.split(row["text"])
                for p in row["places"]:
                    if p["crowded"]:
                        for s in range(p["low"], p["high"] - alphabet.length + 1):
                            rows.append((alphabet.joined(tokens[s : s + alphabet.length]), row["doc"], row["version"], s, None))
                    else:
                        lead = alphabet.joined(tokens[p["at"] : p["at"] + alphabet.k])
                        rows.append((lead, row["doc"], row["version"], p["low"], alphabet.joined(tokens[p["low"] : p["high"]])))
                if len(rows) >= HELD:
                    yield _texts(rows)
                    rows = []
            if rows:
                yield _texts(rows)

    return run


def _texts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["lead", "doc", "version", "low", "text"])


def whole_leads(batches) -> Iterator[list[pa.Array]]:
    """Columns of about ``HELD`` rows that hold all rows of their leads; input sorted by lead."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lead = batch.column(0)
        if size >= HELD:
            # the rows that still belong to the last lead held
            last, n = held[-1].column(0)[-1].as_py(), 0
            while n < len(lead) and lead[n].as_py() == last:
                n += 1
            held.append(batch.slice(0, n))
            batch = batch.slice(n)
            if batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def divided(group: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups divided by the next symbol: which members stay (groups of two or more) and their group."""
    order = np.lexsort((symbol, group))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (group[order][1:] != group[order][:-1]) | (symbol[order][1:] != symbol[order][:-1])
    number = np.cumsum(fresh) - 1
    many = np.bincount(number)[number] > 1 if len(number) else np.zeros(0, bool)
    return order[many], number[many]


def later_ones(group: np.ndarray, doc: np.ndarray, version: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Members of groups of equal windows that are not the earliest place of their group."""
    order = np.lexsort((at, version, doc, group))
    fresh = np.ones(len(order), bool)
    fresh[1:] = group[order][1:] != group[order][:-1]
    least = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(order) else order
    same = (doc[order] == doc[least]) & (version[order] == version[least]) & (at[order] == at[least])
    return order[~same]


SPANS = "doc long, version long, low int, high int"


def _compare(alphabet: Alphabet, equal_windows):
    def run(batches):
        for table in whole_leads(batches):
            doc, version, low = (table.column(i).to_numpy() for i in (1, 2, 3))
            owner, start, group = equal_windows(table.column(4).to_pylist(), alphabet.length)
            at = low[owner] + start
            gone = later_ones(group, doc[owner], version[owner], at)
            d, v, a = doc[owner[gone]], version[owner[gone]], at[gone]
            order = np.lexsort((a, v, d))
            d, v, a = d[order], v[order], a[order]
            begins = np.ones(len(a), bool)  # windows that overlap make one span
            begins[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1]) | (a[1:] > a[:-1] + alphabet.length)
            first = np.flatnonzero(begins)
            last = np.append(first[1:], len(a))[: len(first)] - 1
            columns = [d[first], v[first], a[first].astype(np.int32), (a[last] + alphabet.length).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "version", "low", "high"])

    return run


def later_windows(windows: DataFrame, length: int) -> DataFrame:
    """Spans of the windows ``lead`` that also start earlier; only minima meet by key, the rest is joined."""
    place = F.struct("doc", "version", "low")
    earliest = windows.groupBy("lead").agg(F.min(place).alias("earliest"))
    later = windows.join(earliest, "lead").where(place != F.col("earliest"))
    return later.select("doc", "version", "low", (F.col("low") + length).alias("high"))


# --- 4: cutting -----------------------------------------------------------------

CUT = "doc_id long, n_tokens long, n_removed long, n_spans long, kept binary"


def merged(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of a row as one."""
    order = np.lexsort((low, row))
    row, low, high = row[order], low[order], high[order]
    reach = np.maximum.accumulate(row.astype(np.int64) << 32 | high)
    begins = np.ones(len(row), bool)
    begins[1:] = (row.astype(np.int64) << 32 | low)[1:] > reach[:-1]
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(row))[: len(first)] - 1
    return row[first], low[first], (reach[last] & 0xFFFFFFFF)


def _cut(alphabet: Alphabet):
    def run(batches):
        for batch in batches:
            n, lists = batch.num_rows, batch.column(2)
            size = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            row, low, high = merged(np.repeat(np.arange(n), size), flat.field(0).to_numpy(), flat.field(1).to_numpy())
            runs = np.bincount(row, minlength=n)
            edge = np.concatenate([[0], np.cumsum(runs)]).tolist()
            low, high = low.tolist(), high.tolist()
            sizes, removed, kept = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                tokens = alphabet.split(text)
                starts, ends = [0, *high[edge[i] : edge[i + 1]]], [*low[edge[i] : edge[i + 1]], len(tokens)]
                parts = [tokens[a:b] for a, b in zip(starts, ends)]
                left = b"".join(parts) if isinstance(tokens, bytes) else [w for p in parts for w in p]
                sizes.append(len(tokens))
                removed.append(len(tokens) - len(left))
                kept.append(alphabet.joined(left))
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            columns = [pa.array(doc, mask=doc == FIRST_ID), *(pa.array(c, pa.int64()) for c in (sizes, removed, runs)), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "n_removed", "n_spans", "kept"])

    return run


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def without_repeats(docs: DataFrame, alphabet: Alphabet, deal, equal_windows) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, n_removed, n_spans, kept`` (what stays, as bytes).

    ``deal`` partitions and sorts the surroundings by lead; ``equal_windows(texts, length)`` gives
    owner, start and group of all windows that occur more than once.
    """
    rows = _docs(docs)
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_grams(rows, alphabet))
    anchors = rows.mapInArrow(_find(alphabet, frequent), ANCHORS)
    dealt = anchors.repartition("gram").sortWithinPartitions("gram", "around", "doc", "version", "at")
    found = _stored(dealt.mapInArrow(_settle, "gram long, doc long, version long, at int, low int, high int, open boolean"), "anchors")
    opened = found.where("open")
    crowds = opened.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > CROWD)
    wanted = opened.join(crowds, "gram", "left").select(
        "doc", "version", F.struct("at", "low", "high", F.col("kinds").isNotNull().alias("crowded")).alias("place")
    )
    by_doc = wanted.groupBy("doc", "version").agg(F.collect_list("place").alias("places"))
    asked = rows.join(by_doc, ["doc", "version"]).select("doc", "version", "text", "places")
    texts = _stored(asked.mapInArrow(_surroundings(alphabet), TEXTS), "surroundings")
    compared = deal(texts.where("text is not null")).mapInArrow(_compare(alphabet, equal_windows), SPANS)
    crowded = later_windows(texts.where("text is null"), alphabet.length)
    spans = found.where("not open").select("doc", "version", "low", "high").union(compared).union(crowded)
    lost = spans.groupBy("doc", "version").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return rows.join(lost, ["doc", "version"], "left").select("doc", "text", "spans").mapInArrow(_cut(alphabet), CUT)
