"""Interpolated modified Kneser-Ney models of any order from 2, counted in Spark.

Counting: a first pass counts the words, in buckets of their 64-bit hashes; a word's id is its rank by
hash.  Tasks then combine the n-grams of their documents and send them, sorted, to buckets that are
ranges of (last word before, the one before that, ..., word).  The ranges follow from the words' counts
(see ``bucket_of``) and cut a frequent context by its next words, so neither a word nor a context gathers
in one bucket, and their number follows from the tokens.  A bucket writes its n-grams and sends each
without its first word to the next lower order's buckets, where the numbers of different first words
add up; pairs send how many different words precede each word.

The model is a folder of sorted arrays of ids, for each order and bucket a trie with counts at its
leaves.  Workers map the files into memory.  The folder must lie on a file system that all workers
mount (a ``file:`` or plain path).  Contexts that a bucket's bounds cut are few; their sums are in the model.

p(w|uv) = max(c(uvw) - D(c(uvw)), 0) / c(uv) + g(uv) p(w|v), with three discounts an order from the counts
of counts; lower orders are built the same way from the numbers of different predecessors, and the mass
that remains below the words is spread evenly over the vocabulary and one unknown word, so probabilities
sum to one.  A context that was not seen leaves its word to the next lower order.

Words are runs without white space, A-Z in lower case; each text ends with one end token and begins
after ``order - 1`` start marks.  Defined cases: a null or empty text is the end token alone; repeated rows
count as often as they occur; a null ``doc_id`` is kept; with nothing to learn from, every token has the
probability of the unknown word; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.blocks import IS_SPACE, Block, blocks, documents, span_hashes, words
from fraudlens.session import fresh_path

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
#: Tokens a task gathers before it combines them (and a bucket has on average at most), and bytes of text it scores at a time.
GATHERED, SCORED = 3_000_000, 8 << 20
#: Contexts with more next words than this have their sums stored.
FEW = 8
TOP = np.uint64(48)
#: Files a worker holds open, and rows whose buckets are found at a time.
OPEN, SLICE = 600, 1 << 18


class Model(NamedTuple):
    path: str
    order: int
    buckets: int
    sizes: list[int]  # words and tokens of the words' buckets
    masses: list[int]
    tokens: int
    vocabulary: int
    pairs: int
    discounts: tuple[tuple[float, ...], ...]  # from the highest order to single words; by count 0 to 3+
    rest: float  # mass of the even distribution
    cut: dict[int, dict[tuple[int, ...], tuple[int, ...]]]  # by order: sums of contexts that lie in several buckets


class Tokens(NamedTuple):
    word: np.ndarray
    place: np.ndarray  # in its text
    row: np.ndarray


def tokens(block: Block) -> Tokens:
    data = LOWER[block.data]
    found = words(data, block.offsets, IS_SPACE)
    n = len(block.offsets) - 1
    word = np.full(len(found.start) + n, END)
    word[np.arange(len(found.start)) + found.row] = span_hashes(data, found.start, found.end)
    size = np.diff(found.first) + 1
    return Tokens(word, np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size), np.repeat(np.arange(n), size))


def grams(word: np.ndarray, place: np.ndarray, start: int, order: int) -> list[np.ndarray]:
    """Columns of every token's n-gram: the word before, the one before that, ..., the token."""
    out = []
    for back in range(1, order):
        column = np.empty_like(word)
        column[back:] = word[:-back]
        column[place < back] = start
        out.append(column)
    return [*out, word]


def bucket_of(starts: list[np.ndarray], sizes: list[np.ndarray], total: int, buckets: int, last=None) -> np.ndarray:
    """Buckets of n-grams from the tokens before and of each column's word in the order of ids.

    A word has the share of the range that it has of the tokens, and within it a next word likewise.  All steps
    keep the order of the columns, also where they round.  ``last`` is a place (0 to 1) instead of the last column.
    """
    at = starts[-1] / total if last is None else last
    for start, size in zip(starts[-2::-1], sizes[-2::-1]):
        at = (start + size * at) / total
    return np.minimum((at * buckets).astype(np.int64), buckets - 1)


def buckets_of(start: np.ndarray, size: np.ndarray, columns: list[np.ndarray], total: int, buckets: int, last=None) -> np.ndarray:
    """``bucket_of`` for columns of places among words, a slice at a time."""
    out = np.empty(len(columns[0]), np.int64)
    for a in range(0, len(out), SLICE):
        part = [c[a : a + SLICE] for c in columns]
        out[a : a + SLICE] = bucket_of([start[c] for c in part], [size[c] for c in part], total, buckets, last)
    return out


def _ordered(columns: list[np.ndarray], words: int) -> np.ndarray:
    """The order of rows by their columns of ids below ``words``; several columns make one key where they fit."""
    bits, keys = max(int(words).bit_length(), 1), []
    for i in range(0, len(columns), 64 // bits):
        key = np.zeros(len(columns[0]), np.uint64)
        for column in columns[i : i + 64 // bits]:
            key = key << np.uint64(bits) | column.astype(np.uint64)
        keys.append(key)
    return np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])


def _fresh(columns: list[np.ndarray]) -> np.ndarray:
    """Which rows differ from the one before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.int64)


def _combined(columns: list[np.ndarray], count: np.ndarray | None, words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in order with their counts; each row counts once if there are none."""
    order = _ordered(columns, words)
    columns = [c[order] for c in columns]
    begin = np.flatnonzero(_fresh(columns))
    if count is None:
        return [c[begin] for c in columns], np.diff(np.append(begin, len(order)))
    return [c[begin] for c in columns], _sums(count[order], begin)


_SENT = "bucket int, a binary"


def _rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "a"])


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns of 32 bits, as differences where all columns before are equal; bytes of the same rank together."""
    out, same = [], np.ones(len(columns[0]), bool)
    same[:1] = False
    for column in columns:
        value = column.astype(np.uint32)
        step = value.copy()
        step[1:] -= np.where(same[1:], value[:-1], np.uint32(0))
        out.append(step)
        same[1:] &= value[1:] == value[:-1]
    planes = np.stack(out).view(np.uint8).reshape(len(out), -1, 4).transpose(0, 2, 1).tobytes()
    return len(columns[0]).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _unpacked(data: bytes, width: int) -> list[np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], 4 * n * width, asbytes=True), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(width, 4, n).transpose(0, 2, 1)).view(np.uint32)[:, :, 0]
    out, begin = [], np.zeros(1, np.int64)
    for step in steps:
        total = np.cumsum(step, dtype=np.uint32)
        before = np.concatenate([np.zeros(1, np.uint32), total])[begin]
        value = total - np.repeat(before, np.diff(np.append(begin, n)))
        out.append(value)
        fresh = np.zeros(n, bool)
        fresh[begin] = True
        fresh[1:] |= value[1:] != value[:-1]
        begin = np.flatnonzero(fresh)
    return out


def _sent(columns: list[np.ndarray], count: np.ndarray, bucket: np.ndarray, ids: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Sorted rows, to the buckets they are for; with ``ids``, columns are places among these."""
    cuts = np.append(np.flatnonzero(_fresh([bucket])), len(bucket))
    for a, z in zip(cuts, cuts[1:]):
        part = [c[a:z] if ids is None else ids[c[a:z]] for c in columns]
        yield _rows([(int(bucket[a]), _packed([*part, count[a:z]]))])


def _by_bucket(batches) -> Iterator[tuple[int, list[bytes]]]:
    """What was sent to each bucket; a partition is sorted by bucket."""
    bucket, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if bucket is not None and row["bucket"] != bucket:
                yield bucket, held
                held = []
            bucket = row["bucket"]
            held.append(row["a"])
    if held:
        yield bucket, held


def _write(path: str, array: np.ndarray) -> None:
    """Whole or not at all, so a repeated task leaves the same file."""
    part = f"{path}.{os.getpid()}"
    np.ascontiguousarray(array).tofile(part)
    os.replace(part, path)


def _counts_of_counts(values: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(values, 5), minlength=6)[1:5]


def _gathered(batches) -> Iterator[list[Tokens]]:
    held, size = [], 0
    for block in blocks(batches):
        held.append(tokens(block))
        size += len(held[-1].word)
        if size >= GATHERED:
            yield held
            held, size = [], 0
    if held:
        yield held


# --- Words -----------------------------------------------------------------------


def _count_words(buckets: int):
    def run(batches):
        for held in _gathered(batches):
            found, count = np.unique(np.concatenate([t.word for t in held]), return_counts=True)
            # texts begin as often as they end
            if (ends := count[found == END]).size:
                at = np.searchsorted(found, START)
                found, count = np.insert(found, at, START), np.insert(count, at, ends[0])
            cuts = np.searchsorted(((found >> TOP).astype(np.int64) * buckets) >> 16, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[b], cuts[b + 1])
                yield _rows([(b, found[part].tobytes() + count[part].astype(np.int64).tobytes())])

    return run


def _merge_words(path: str):
    def run(batches):
        for bucket, sent in _by_bucket(batches):
            word = np.concatenate([np.frombuffer(a, np.uint64, len(a) // 16) for a in sent])
            count = np.concatenate([np.frombuffer(a, np.int64, len(a) // 16, len(a) // 2) for a in sent])
            order = np.argsort(word, kind="stable")
            begin = np.flatnonzero(_fresh([word[order]]))
            word, count = word[order][begin], _sums(count[order], begin)
            _write(f"{path}/words-{bucket}", word)
            _write(f"{path}/mass-{bucket}", np.concatenate([[0], np.cumsum(count)]))
            sums = [bucket, len(word), int(count.sum()), int(count[word == START].sum())]
            yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.int64()))], ["sums"])

    return run


class Files:
    """The mapped files of a folder, opened as they are needed."""

    def __init__(self, path: str):
        self.path, self.open = path, {}

    def file(self, name: str, dtype, width: int = 1) -> np.ndarray:
        if name not in self.open:
            path = f"{self.path}/{name}"
            size = os.path.getsize(path) if os.path.exists(path) else 0  # a bucket may be empty
            data = np.memmap(path, dtype, "r") if size else np.zeros(0, dtype)
            if len(self.open) >= OPEN:
                self.open.pop(next(iter(self.open)))
            self.open[name] = data.reshape(-1, width) if width > 1 else data
        return self.open[name]


class Lexicon(Files):
    """Ids of words, their ranks by hash, and how many tokens have a smaller id."""

    def __init__(self, path: str, sizes: list[int], masses: list[int]):
        super().__init__(path)
        self.buckets = len(sizes)
        self.first, self.mass = (np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in (sizes, masses))
        self.words, self.total = int(self.first[-1]), max(int(self.mass[-1]), 1)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Of sorted hashes; -1 for an unknown word."""
        out = np.full(len(hashes), -1)
        cuts = np.searchsorted(((hashes >> TOP).astype(np.int64) * self.buckets) >> 16, np.arange(self.buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            part = slice(cuts[b], cuts[b + 1])
            keys = self.file(f"words-{b}", np.uint64)
            at = np.searchsorted(keys, hashes[part])
            there = at < len(keys)
            there[there] = keys[at[there]] == hashes[part][there]
            out[part][there] = self.first[b] + at[there]
        return out

    def parts(self, ids: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray]]:
        """For sorted ids: bucket, which of them, places in its files."""
        cuts = np.searchsorted(ids, self.first)
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            part = slice(cuts[b], cuts[b + 1])
            yield b, part, ids[part] - self.first[b]

    def weights(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted ids: tokens before and of the word."""
        start, size = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for b, part, at in self.parts(ids):
            mass = self.file(f"mass-{b}", np.int64)
            start[part], size[part] = self.mass[b] + mass[at], mass[at + 1] - mass[at]
        return start, size

    def weighed(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Tokens before and of the columns' words, and columns of places among those."""
        unique, at = np.unique(np.concatenate(columns), return_inverse=True)
        return *self.weights(unique.astype(np.int64)), np.split(at, len(columns))


# --- N-grams ---------------------------------------------------------------------


def _count(place: tuple, order: int, buckets: int):
    def run(batches):
        lexicon = Lexicon(*place)
        for held in _gathered(batches):
            word = np.concatenate([*(t.word for t in held), [START]])
            unique, word = np.unique(word, return_inverse=True)
            ids = lexicon.ids(unique)
            if ids.min() < 0:
                raise ValueError("the documents changed between two passes")
            # places among the sorted words are in the order of ids
            word = word.astype(np.uint32)
            columns = grams(word[:-1], np.concatenate([t.place for t in held]), word[-1], order)
            del held, word
            columns, count = _combined(columns, None, len(unique))
            bucket = buckets_of(*lexicon.weights(ids), columns, lexicon.total, buckets)
            ids = ids.astype(np.uint32)
            yield from _sent(columns, count, bucket, ids)

    return run


def _merge(place: tuple, buckets: int, order: int, top: int):
    """Writes the n-grams of one order, and sends what the next lower one counts."""
    def run(batches):
        lexicon = Lexicon(*place)
        for bucket, sent in _by_bucket(batches):
            parts = [_unpacked(a, order + 1) for a in sent]
            columns = [np.concatenate(c) for c in zip(*parts)]
            del parts, sent
            columns, count = _combined(columns[:-1], columns[-1].astype(np.int64), lexicon.words)
            name = lambda kind: f"{place[0]}/{kind}-{order}-{bucket}"  # noqa: E731, B023
            below = np.arange(len(count))
            for depth in range(order - 1, -1, -1):  # from the leaves up
                begin = np.flatnonzero(_fresh(columns[: depth + 1])) if depth < order - 1 else below
                _write(name(f"ids{depth}"), columns[depth][begin])
                if depth < order - 1:
                    _write(name(f"at{depth}"), np.append(np.searchsorted(below, begin), len(below)).astype(np.uint32))
                if depth == order - 2:
                    contexts = begin
                below = begin
            _write(name("counts"), np.minimum(count, 255).astype(np.uint8))
            large = np.flatnonzero(count >= 255)
            _write(name("large"), np.stack([large, count[large]], axis=1))
            kinds = [_sums((count == k if k < 3 else count >= 3).astype(np.int64), contexts) for k in (1, 2, 3)]
            stats = np.stack([_sums(count, contexts), *kinds], axis=1)
            many = np.flatnonzero(stats[:, 1:].sum(axis=1) > FEW)
            _write(name("many"), np.column_stack([many, stats[many]]))
            # only the first and the last context can pass the bucket's bounds
            ends = np.unique([0, len(contexts) - 1])
            *weights, own = lexicon.weighed([c[contexts[ends]] for c in columns])
            near, far = (buckets_of(*weights, own, lexicon.total, buckets, x) for x in (0.0, 1.0))
            cut = ends[near != far]
            said = {
                "counts": _counts_of_counts(count).tolist(), "grams": len(count),
                "cut": [([int(c[contexts[i]]) for c in columns[:-1]], stats[i].tolist()) for i in cut],
            }
            _write(name("said"), np.frombuffer(json.dumps(said).encode(), np.uint8))
            if order > 2:
                columns, count = _combined([*columns[:-2], columns[-1]], None, lexicon.words)
                *weights, own = lexicon.weighed(columns)
                yield from _sent(columns, count, buckets_of(*weights, own, lexicon.total, buckets))
            else:
                word, count = np.unique(columns[-1], return_counts=True)
                yield from _sent([word], count, np.searchsorted(lexicon.first, word, "right") - 1)

    return run


def _merge_heard(place: tuple):
    def run(batches):
        lexicon = Lexicon(*place)
        for bucket, sent in _by_bucket(batches):
            heard = np.zeros(lexicon.first[bucket + 1] - lexicon.first[bucket], np.int64)
            for a in sent:
                word, count = _unpacked(a, 2)
                heard[word - lexicon.first[bucket]] += count
            if heard.max(initial=0) >= 1 << 32:
                raise OverflowError("a word has more than 2**32 different neighbours")
            _write(f"{place[0]}/heard-{bucket}", heard.astype(np.uint32))
            sums = [*_counts_of_counts(heard[heard > 0]).tolist(), int((heard >= 3).sum())]
            yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.int64()))], ["sums"])

    return run


def discounts(counts: list[int]) -> tuple[float, ...]:
    """Discounts of counts 0, 1, 2 and 3 or more from the numbers of entries seen 1 to 4 times.

    Where those do not yield one between 0 and the count (tiny or odd corpora), 1/2, 1 and 3/2 hold.
    """
    n1, n2, n3, n4 = counts
    out = [0.0]
    base = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    for k, (low, high) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        value = k - (k + 1) * base * high / low if low else -1.0
        out.append(value if 0 < value < k else k / 2)
    return tuple(out)


def fit(docs: DataFrame, order: int = 2, buckets: int | None = None) -> Model:
    """Count the model of all documents into a new folder below the shared one."""
    if order < 2:
        raise ValueError("a model has an order of at least 2")
    spark = docs.sparkSession
    place = urlparse(fresh_path(spark, "ngrams"))
    if place.scheme not in ("", "file"):
        raise ValueError("the model is mapped into memory: its folder must be on a mounted file system")
    path = place.path
    os.makedirs(path, exist_ok=True)
    texts = documents(docs).select("text")

    def dealt(rows: DataFrame, n: int) -> DataFrame:
        return rows.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket")

    n_words = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 16)
    sizes, masses, begun = [0] * n_words, [0] * n_words, 0
    for (found,) in dealt(texts.mapInArrow(_count_words(n_words), _SENT), n_words).mapInArrow(_merge_words(path), "sums array<long>").collect():
        sizes[found[0]], masses[found[0]], begun = found[1], found[2], begun + found[3]
    total = sum(masses) - begun
    if sum(sizes) >= 1 << 32:
        raise OverflowError("more than 2**32 different words")
    buckets = buckets or max(n_words, total // GATHERED + 1)
    where = path, sizes, masses
    rows = texts.mapInArrow(_count(where, order, buckets), _SENT)
    for k in range(order, 1, -1):
        rows = dealt(rows, buckets).mapInArrow(_merge(where, buckets, k, order), _SENT)
    heard = np.zeros(5, np.int64)
    for (found,) in dealt(rows, n_words).mapInArrow(_merge_heard(where), "sums array<long>").collect():
        heard += found
    of, cut, pairs = [], {}, 0
    for k in range(order, 1, -1):
        counts, cut[k] = np.zeros(4, np.int64), {}
        pairs = 0
        for b in range(buckets):
            if not os.path.exists(file := f"{path}/said-{k}-{b}"):
                continue
            with open(file) as said:
                said = json.load(said)
            counts += said["counts"]
            pairs += said["grams"]
            for context, stats in said["cut"]:
                cut[k][tuple(context)] = tuple(map(sum, zip(stats, cut[k].get(tuple(context), (0,) * 4))))
        of.append(discounts(counts.tolist()))
    of.append(last := discounts(heard[:4].tolist()))
    mass = last[1] * heard[0] + last[2] * heard[1] + last[3] * heard[4]
    kinds = sum(sizes) - bool(begun)  # the start mark is no word
    return Model(path, order, buckets, sizes, masses, total, kinds, pairs, tuple(of), float(mass / pairs) if pairs else 1.0, cut)


# --- Scoring -------------------------------------------------------------------


def _within(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in their own sorted ranges, and whether they are there."""
    low, end = low.copy(), high
    high = high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        a, z = low[open_], high[open_]
        middle = (a + z) >> 1
        less = values[middle] < wanted[open_]
        low[open_] = a = np.where(less, middle + 1, a)
        high[open_] = z = np.where(less, z, middle)
        open_ = open_[a < z]
    there = low < end
    there[there] = values[low[there]] == wanted[there]
    return low, there


class Tables(Lexicon):
    def __init__(self, model: Model):
        super().__init__(model.path, model.sizes, model.masses)
        self.model = model

    def heard(self, ids: np.ndarray) -> np.ndarray:
        """Of sorted ids: how many different words precede the word."""
        out = np.zeros(len(ids), np.int64)
        for b, part, at in self.parts(ids):
            if len(heard := self.file(f"heard-{b}", np.uint32)):
                out[part] = heard[at]
        return out

    def _counts(self, order: int, bucket: int, at: np.ndarray) -> np.ndarray:
        count = self.file(f"counts-{order}-{bucket}", np.uint8)[at].astype(np.int64)
        if (full := count == 255).any():
            large = np.asarray(self.file(f"large-{order}-{bucket}", np.int64, 2))
            count[full] = large[np.searchsorted(large[:, 0], at[full]), 1]
        return count

    def _in_bucket(self, bucket: int, columns: list[np.ndarray], seen: np.ndarray, stats: np.ndarray) -> None:
        """Counts of a bucket's sorted n-grams and sums of their contexts; equal beginnings are looked up once."""
        order, n = len(columns), len(seen)
        name = f"{order}-{bucket}"
        if not len(top := self.file(f"ids0-{name}", np.uint32)):
            return
        begin, fresh = np.zeros(1, np.int64), np.zeros(n, bool)
        low, high = np.zeros(1, np.int64), np.full(1, len(top))
        for depth, column in enumerate(columns):
            fresh[1:] |= column[1:] != column[:-1]
            fresh[0] = True
            above, begin = begin, np.flatnonzero(fresh)
            own = np.searchsorted(above, begin, "right") - 1
            wanted = column[begin]
            if depth:
                at, there = _within(self.file(f"ids{depth}-{name}", np.uint32), low[own], high[own], wanted)
            else:
                at = np.searchsorted(top, np.maximum(wanted, 0).astype(np.uint32))
                there = (wanted >= 0) & (at < len(top))
                there[there] = top[at[there]] == wanted[there]
            if depth < order - 1:
                starts = self.file(f"at{depth}-{name}", np.uint32)
                at[~there] = 0
                low, high = (np.where(there, starts[at + x].astype(np.int64), 0) for x in (0, 1))
            if depth == order - 2:
                found = np.zeros((len(begin), 4), np.int64)
                size = high - low
                rows = np.flatnonzero((size > 0) & (size <= FEW))
                for step in range(FEW):
                    rows = rows[size[rows] > step]
                    count = self._counts(order, bucket, low[rows] + step)
                    found[rows, 0] += count
                    found[rows, np.minimum(count, 3)] += 1
                rows = np.flatnonzero(size > FEW)
                many = self.file(f"many-{name}", np.int64, 5)
                found[rows] = many[np.searchsorted(many[:, 0], at[rows]), 1:]
                stats[:] = np.repeat(found, np.diff(np.append(begin, n)), axis=0)
        count = np.zeros(len(begin), np.int64)
        count[there] = self._counts(order, bucket, at[there])
        seen[:] = np.repeat(count, np.diff(np.append(begin, n)))

    def grams(self, columns: list[np.ndarray], ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of n-grams: count, and of their contexts: count, next words seen once, twice, more often.

        Columns are places among the words, whose ids (-1 if unknown) and weights follow.
        """
        order, n = len(columns), len(columns[0])
        by = _ordered(columns, len(ids))
        places = [c[by] for c in columns]
        seen, stats = np.zeros(n, np.int64), np.zeros((n, 4), np.int64)
        bucket = buckets_of(start, size, places, self.total, self.model.buckets)
        cuts = np.append(np.flatnonzero(_fresh([bucket])), n)
        for a, z in zip(cuts, cuts[1:]):
            self._in_bucket(int(bucket[a]), [ids[c[a:z]] for c in places], seen[a:z], stats[a:z])
        begin = np.flatnonzero(_fresh(places[:-1]))
        contexts = [c[begin] for c in places]
        near, far = (buckets_of(start, size, contexts, self.total, self.model.buckets, x) for x in (0.0, 1.0))
        ends = np.append(begin[1:], n)
        for i in np.flatnonzero(near != far).tolist():
            stats[begin[i] : ends[i]] = self.model.cut[order].get(tuple(int(ids[c[i]]) for c in contexts[:-1]), (0,) * 4)
        back = np.empty(n, np.int64)
        back[by] = np.arange(n)
        return seen[back], stats[back]


def probabilities(tables: Tables, found: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Of every token: its count in training and its probability."""
    model = tables.model
    unique, word = np.unique(np.append(found.word, START), return_inverse=True)
    ids = tables.ids(unique)
    known = np.flatnonzero(ids >= 0)
    start, size, heard = (np.zeros(len(ids), np.int64) for _ in range(3))
    start[known], size[known] = tables.weights(ids[known])
    heard[known] = tables.heard(ids[known])
    # an unknown word stands, without width, after the known one before it
    last = np.maximum.accumulate(np.where(ids >= 0, np.arange(len(ids)), -1))
    start = np.where(ids >= 0, start, np.where(last >= 0, (start + size)[last], 0))
    of = np.array(model.discounts[-1])
    one = np.maximum(heard - of[np.minimum(heard, 3)], 0) / max(model.pairs, 1) + model.rest / (model.vocabulary + 1)
    columns = grams(word[:-1], found.place, word[-1], model.order)
    chance = one[columns[-1]]
    for order in range(2, model.order + 1):
        of = np.array(model.discounts[model.order - order])
        seen, stats = tables.grams([*columns[: order - 1], columns[-1]], ids, start, size)
        total = stats[:, 0]
        both = np.maximum(seen - of[np.minimum(seen, 3)], 0) + (stats[:, 1:] @ of[1:]) * chance
        chance = np.where(total > 0, both / np.maximum(total, 1), chance)
    return size[columns[-1]], chance


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score, perplexity`` of every text."""
    def run(batches):
        tables = Tables(model)
        bottom = model.tokens + 0.5 * (model.vocabulary + 1)
        for block in blocks(batches, SCORED):
            found = tokens(block)
            count, chance = probabilities(tables, found)
            n = len(block.offsets) - 1
            add = lambda x: np.bincount(found.row, weights=x, minlength=n)
            size, total = np.bincount(found.row, minlength=n), add(np.log10(chance))
            yield pa.RecordBatch.from_arrays(
                [
                    block.rows.column(0), pa.array(size, pa.int64()), pa.array(add(count > 0).astype(np.int64)),
                    pa.array(add(np.log10((count + 0.5) / bottom))), pa.array(total), pa.array(10 ** (-total / size)),
                ],
                ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
            )

    return documents(docs).mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double"
    )
