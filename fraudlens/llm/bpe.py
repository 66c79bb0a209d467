"""Byte-pair encoding with a segment tree over adjacent pair ranks, and decoding.

The leaves of a word's tree hold the ranks of its adjacent pairs, combined with their positions;
an inner node holds the smaller of its children.  The root is therefore the leftmost pair of
lowest rank.  A merge changes at most three leaves (the pair, its left and its right neighbour),
each updated up to the root, until the root holds no mergeable pair.

Trees of short words of one size are stacked as rows of one array and advance together, merge
by merge; a longer word has a tree of its own.  Both follow the same steps.  Words between white
space are encoded once while they are in a bounded cache.

The vocabulary file is the JSON of the tokenizers library for a BPE model with word ends
(lower-cased, white space dropped); its path is a parameter and it is read by the workers.

Defined cases: a null or empty text has no ids and decodes to an empty text; special-token strings
in a text become their ids, as the library does; rows are independent, so repeated rows and null
``doc_id`` give equal and kept rows; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from fraudlens.llm.blocks import blocks, documents

#: Separators that str.split() takes for white space and the library does not.
NOT_WHITE = "\x1c\x1d\x1e\x1f"
CHUNK = re.compile(r"(?:[^\s]|[\x1c-\x1f])+")
#: Rows of small trees that advance together, and the longest word they take.
SMALL = 32
NONE = np.int64(1 << 62)
#: Bytes of the words kept with their ids, at about 200 an entry beside its characters.
CACHE = 64 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Numbering(dict):
    """Numbers keys in the order of their first lookup."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def category_class(*kinds: str) -> str:
    """The characters of some general categories, as the inside of a character class."""
    ranges, last = [], -2
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)).startswith(kinds):
            if c == last + 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
            last = c
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


@lru_cache(maxsize=1)
def patterns() -> tuple[re.Pattern, re.Pattern]:
    """The word pattern of the vocabulary file, and the characters this Python's tables lack."""
    letter, number = category_class("L"), category_class("N")
    # white space is gone by now, so the last kind needs no \\s
    piece = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{letter}{number}]+")
    return piece, re.compile(f"[{category_class('Cn')}]")


class Encoder:
    """A vocabulary with its merges; encodes white-space-free chunks and whole texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocabulary = spec["model"], spec["model"]["vocab"]
        self.ending = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token = {i: t for t, i in {**vocabulary, **self.special}.items()}
        symbols = byte_symbols()
        self.inner = np.array([vocabulary[s] for s in symbols], np.int64)
        self.final = np.array([vocabulary[s + self.ending] for s in symbols], np.int64)
        self.byte = {s: b for b, s in enumerate(symbols)}
        self.size = max(self.token) + 1
        pairs = np.array([[vocabulary[a], vocabulary[b], vocabulary[a + b]] for a, b in model["merges"]], np.int64)
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order, pairs[order, 2]
        self.piece, self.unassigned = patterns()
        self.path = path
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache = Numbering()
        self.flat, self.first, self.held = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    # --- Merging -------------------------------------------------------------

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs; NONE and -1 for pairs that do not merge or lack a side."""
        keys = left * self.size + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = (left >= 0) & (right >= 0) & (self.keys[at] == keys)
        return np.where(known, self.ranks[at], NONE), np.where(known, self.merged[at], -1)

    def merge_small(self, ids: np.ndarray) -> np.ndarray:
        """Merge the rows of ``ids`` (a power of two wide, -1 behind the end) to their ends.

        Merged rows have -1 where a symbol went into its left neighbour.
        """
        n, width = ids.shape
        place = np.arange(width)
        after = np.where(place + 1 < width, place + 1, -1) * np.ones((n, 1), np.int64)
        before = (place - 1) * np.ones((n, 1), np.int64)
        right = np.full_like(ids, -1)
        right[:, :-1] = ids[:, 1:]
        rank, _ = self.pair(ids.ravel(), right.ravel())
        tree = np.full((n, 2 * width), NONE)
        tree[:, width:] = np.where(rank.reshape(n, width) < NONE, rank.reshape(n, width) * width + place, NONE)
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            at = tree[row, 1] % width
            gone = after[row, at]
            _, made = self.pair(ids[row, at], ids[row, gone])
            ids[row, at], ids[row, gone] = made, -1
            beyond = after[row, gone]
            after[row, at] = beyond
            linked = beyond >= 0
            before[row[linked], beyond[linked]] = at[linked]
            prior = before[row, at]
            value = self.pair(made, np.where(linked, ids[row, beyond], -1))[0]
            self._update(tree, row, at, np.where(value < NONE, value * width + at, NONE))
            self._update(tree, row, gone, np.full(len(row), NONE))
            some = prior >= 0
            r, p = row[some], prior[some]
            value = self.pair(ids[r, p], made[some])[0]
            self._update(tree, r, p, np.where(value < NONE, value * width + p, NONE))
            row = row[tree[row, 1] < NONE]
        return ids

    @staticmethod
    def _update(tree: np.ndarray, row: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        node = leaf + tree.shape[1] // 2
        tree[row, node] = value
        while len(node) and node[0] > 1:  # all leaves lie at one depth
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    @property
    def table(self) -> dict[int, tuple[int, int]]:
        if not hasattr(self, "_table"):
            self._table = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))
        return self._table

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same for one word of any length, with a tree of its own."""
        n, none = len(ids), (1 << 62, -1)
        width = 1 << max(n - 1, 1).bit_length()
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        look = lambda a, b: self.table.get(ids[a] * self.size + ids[b], none) if a >= 0 and b >= 0 else none
        # a node holds (rank, position): the smaller tuple is the lower rank, then the leftmost
        tree = [(none[0], 0)] * (2 * width)
        tree[width : width + n] = [(look(i, after[i])[0], i) for i in range(n)]
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf: int, rank: int) -> None:
            node = width + leaf
            tree[node] = (rank, leaf)
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while tree[1][0] < none[0]:
            at = tree[1][1]
            gone = after[at]
            ids[at], ids[gone] = look(at, gone)[1], -1
            beyond = after[at] = after[gone]
            if beyond >= 0:
                before[beyond] = at
            put(at, look(at, beyond)[0])
            put(gone, none[0])
            if before[at] >= 0:
                put(before[at], look(before[at], at)[0])
        return [i for i in ids if i >= 0]

    def merge_words(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each word, given as its bytes."""
        out: list = [None] * len(pieces)
        sizes = np.array([len(p) for p in pieces], np.int64)
        for i in np.flatnonzero(sizes > SMALL).tolist():
            ids = self.inner[np.frombuffer(pieces[i], np.uint8)]
            ids[-1] = self.final[pieces[i][-1]]
            out[i] = self.merge_long(ids.tolist())
        width = 2
        while width <= SMALL:
            low = 0 if width == 2 else width // 2
            chosen = np.flatnonzero((sizes > low) & (sizes <= width))
            if len(chosen):
                raw = np.frombuffer(b"".join([pieces[i].ljust(width, b"\0") for i in chosen.tolist()]), np.uint8).reshape(-1, width)
                ids = self.inner[raw]
                last = sizes[chosen] - 1
                every = np.arange(len(chosen))
                ids[every, last] = self.final[raw[every, last]]
                ids[np.arange(width) > last[:, None]] = -1
                ids = self.merge_small(ids)
                left = ids >= 0
                flat, ends = ids[left].tolist(), np.cumsum(left.sum(axis=1)).tolist()
                begin = 0
                for i, end in zip(chosen.tolist(), ends):
                    out[i] = flat[begin:end]
                    begin = end
            width *= 2
        return out

    # --- Texts ---------------------------------------------------------------

    @property
    def library(self) -> Tokenizer:
        if not hasattr(self, "_library"):
            self._library = Tokenizer.from_file(self.path)
        return self._library

    def words(self, part: str) -> list[str]:
        """Words of a part without white space and special tokens, normalised."""
        if not part.isascii():
            if self.unassigned.search(part):  # newer than Python's tables: as the library splits it
                split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                return [bytes(self.byte[c] for c in word).decode() for word, _ in split]
            # each character by itself, so a final sigma is no exception
            part = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3")
        part = part.lower()
        return [part] if part.isalpha() else self.piece.findall(part)

    def pieces(self, chunk: str) -> list:
        """A chunk's words as bytes; a special token as its id."""
        if "<|" not in chunk:
            return [w.encode() for w in self.words(chunk)]
        out: list = []
        for part in self.cut.split(chunk) if self.cut else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(w.encode() for w in self.words(part))
        return out

    def add(self, chunks: list[str]) -> None:
        """Encode chunks into the cache."""
        parts = [self.pieces(c) for c in chunks]
        plain = list(dict.fromkeys(p for own in parts for p in own if isinstance(p, bytes)))
        known = dict(zip(plain, self.merge_words(plain)))
        lists = [[i for p in own for i in (known[p] if isinstance(p, bytes) else (p,))] for own in parts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        self.held += sum(map(len, chunks)) + 200 * len(chunks)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins (one more entry than texts)."""
        if self.held > CACHE:
            self.cache, self.flat, self.first, self.held = Numbering(), np.zeros(0, np.int32), np.zeros(1, np.int64), 0
        chunks = [CHUNK.findall(t) if any(c in t for c in NOT_WHITE) else t.split() for t in texts]
        known, had = self.cache, len(self.cache)
        total = sum(map(len, chunks))
        at = np.fromiter(map(known.__getitem__, chain.from_iterable(chunks)), np.int64, total)
        if len(known) > had:
            self.add(list(islice(known, had, None)))
        size = self.first[at + 1] - self.first[at]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.first[at] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        cuts = np.cumsum([0, *map(len, chunks)])
        return ids, np.concatenate([[0], ends])[cuts]

    # --- Decoding ------------------------------------------------------------

    def tokens(self, ids: list[int]) -> str:
        """The tokens joined by spaces, as the library decodes when the file names no decoder."""
        return " ".join([self.token[i] for i in ids])

    def text(self, ids: list[int]) -> str:
        """Readable text: words restored from their bytes, one space behind each."""
        names, out = set(self.special.values()), []
        for i in ids:
            token = self.token[i]
            ends = bool(self.ending) and token.endswith(self.ending) and i not in names
            body = token[: -len(self.ending)] if ends else token
            out.append(body.encode() if i in names else bytes(self.byte[c] for c in body))
            if ends or i in names:
                out.append(b" ")
        return b"".join(out).decode("utf-8", "replace").rstrip(" ")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker."""
    return Encoder(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, tokens``: token ids of each text and its tokens joined by spaces."""
    def run(batches):
        coder = encoder(path)
        names = np.array([coder.token.get(i, "") for i in range(coder.size)], object)
        for block in blocks(batches):
            ids, cuts = coder.encode([t.decode("utf-8", "replace") for t in block.texts()])
            text = names[ids].tolist()
            ends = cuts.tolist()
            joined = [" ".join(text[a:b]) for a, b in zip(ends, ends[1:])]
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([block.rows.column(0), lists, pa.array(joined, pa.string())], ["doc_id", "ids", "tokens"])

    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>, tokens string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from a table with ``doc_id, ids``; null ids give an empty text."""
    def run(batches):
        coder = encoder(path)
        for batch in batches:
            texts = [coder.text(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
