"""Token ids of texts packed into rows of one length by best fit decreasing.

Texts become ids of a byte-level vocabulary (lossless).  A text longer than a row is split into full
rows and a rest.  Pieces are packed in groups of about ``GROUP`` tokens, which a task holds one at a
time: longest first, each into the open row with the least room that takes it.  The rows lie in
buckets by their room, and a segment tree over the capacities says where the next non-empty bucket
is, so a search costs the logarithm of the row length, whatever the number of rows.

A packed row has its ids (two or four bytes each, little-endian, padded behind the last segment),
the cumulative lengths of its segments, positions that start again at each segment, and where
each segment comes from (document and offset in its tokens), so the texts can be restored.

Defined cases: a text of any length and kind is encoded whole, also one run of white space, letters or signs; a null or empty text has no tokens and takes no room; a null ``doc_id`` keeps its
segments under null; rows that share a ``doc_id`` are packed one by one; ties in length go in order of
appearance; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import re
import uuid
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from fraudlens.llm.blocks import blocks, documents

LENGTH, GROUP = 2048, 1 << 20
#: Fixed value: the pattern that splits text before the merges of this kind of vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Runs of white space that the pattern above is kept from: its lookahead needs a stack as long as the run.
LONG = 20_000
LONG_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG)


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """A vocabulary of ranks; the id behind the last rank is free and pads."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(coder: tiktoken.Encoding, texts: list[str]) -> list[list[int]]:
    """Ids of each text, also of one with very long runs of white space.

    The pattern takes such a run as one piece, but for its last character where something follows: that one goes
    with what follows.  So the run is cut off there and merged as the piece it is, and the rest is encoded by itself.
    """
    long = [i for i, t in enumerate(texts) if len(t) >= LONG and LONG_WHITE.search(t)]
    out = coder.encode_ordinary_batch([t if i not in long else "" for i, t in enumerate(texts)], num_threads=1)
    for i in long:
        text, at = texts[i], 0
        for run in LONG_WHITE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out[i] += coder.encode_ordinary(text[at : run.start()])
            if end > run.start():
                out[i] += coder._encode_single_piece(text[run.start() : end].encode())
            at = end
        out[i] += coder.encode_ordinary(text[at:])
    return out


class Rooms:
    """Open rows by room left; finds the least room that is enough."""

    def __init__(self, length: int):
        self.width = 1 << length.bit_length()
        self.tree = [False] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _mark(self, room: int) -> None:
        node = self.width + room
        self.tree[node] = bool(self.rows[room])
        while node > 1:
            node >>= 1
            self.tree[node] = self.tree[2 * node] or self.tree[2 * node + 1]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._mark(room)

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the fullest row with at least ``size`` left, which leaves."""
        node = self.width + size
        while not self.tree[node]:
            while node & 1:  # a right child: go up
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.width:
            node = 2 * node if self.tree[2 * node] else 2 * node + 1
        room = node - self.width
        row = self.rows[room].pop()
        self._mark(room)
        return room, row


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of pieces (by index), longest pieces first."""
    rooms, rows = Rooms(length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        room, row = rooms.take(sizes[i]) or (length, len(rows))
        if row == len(rows):
            rows.append([])
        rows[row].append(i)
        if room > sizes[i]:
            rooms.add(room - sizes[i], row)
    return rows


PACKED = (
    "ids binary, cu_seqlens array<int>, position_ids binary, doc_ids array<long>, offsets array<int>, n_tokens int"
)


def _rows(pieces: list[tuple], length: int, pad: int, kind) -> pa.RecordBatch:
    out: list[list] = [[] for _ in range(6)]
    for row in best_fit([len(p[2]) for p in pieces], length):
        own = [pieces[i] for i in row]
        ids, position = np.full(length, pad, kind), np.zeros(length, kind)
        ends = np.cumsum([0, *(len(p[2]) for p in own)])
        ids[: ends[-1]] = np.concatenate([p[2] for p in own])
        position[: ends[-1]] = np.concatenate([np.arange(len(p[2])) for p in own])
        values = (ids.tobytes(), ends.tolist(), position.tobytes(), [p[0] for p in own], [p[1] for p in own], int(ends[-1]))
        for column, value in zip(out, values):
            column.append(value)
    kinds = [pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32()]
    names = [part.split()[0] for part in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def pack(docs: DataFrame, path: str, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """One row per packed sequence of ``length`` ids; see ``PACKED`` for the columns."""
    if not 0 < length < 1 << 16:
        raise ValueError("a row has 1 to 65535 tokens")

    def run(batches):
        coder = encoding(path)
        kind = np.uint16 if coder.n_vocab < 1 << 16 else np.uint32
        pieces, held = [], 0
        for block in blocks(batches):
            texts = [t.decode("utf-8", "replace") for t in block.texts()]
            for doc, ids in zip(block.rows.column(0).to_pylist(), encode(coder, texts)):
                own = np.array(ids, kind)
                pieces.extend((doc, at, own[at : at + length]) for at in range(0, len(own), length))
                held += len(own)
                if held >= group:
                    yield _rows(pieces, length, coder.n_vocab, kind)
                    pieces, held = [], 0
        if pieces:
            yield _rows(pieces, length, coder.n_vocab, kind)

    return documents(docs).mapInArrow(run, PACKED)


def write_matrices(packed: DataFrame, folder: str, length: int = LENGTH) -> DataFrame:
    """Write the rows as raw id matrices below a mounted ``folder``, one file for each Arrow batch.

    Returns ``file, n_rows, first_doc``; a file is renamed into place whole and its name follows from its
    content, so a repeated task leaves the same files.
    """
    place = urlparse(folder)
    if place.scheme not in ("", "file"):
        raise ValueError("raw matrices need a mounted folder")
    os.makedirs(place.path, exist_ok=True)

    def run(batches):
        import hashlib

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, segments = b"".join(batch.column(0).to_pylist()), batch.column(1).to_pylist()
            stem = f"{place.path}/{hashlib.sha256(ids).hexdigest()[:24]}"
            lengths = np.array([len(segments), *(len(s) for s in segments), *(x for s in segments for x in s)], "<i4")
            for name, data in ((f"{stem}.ids", ids), (f"{stem}.segments", lengths.tobytes())):
                with open(f"{name}.{uuid.uuid4().hex}", "wb") as file:
                    file.write(data)
                os.replace(file.name, name)
            docs = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{stem}.ids"]), pa.array([batch.num_rows], pa.int32()), pa.array([docs[0][0]], pa.int64())],
                ["file", "n_rows", "first_doc"],
            )

    return packed.select("ids", "cu_seqlens", "doc_ids").mapInArrow(run, "file string, n_rows int, first_doc long")
