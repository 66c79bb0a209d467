"""Quality rules on documents, with a linear-chain conditional random field over their lines.

Every line that has a word is a step of the chain.  Viterbi decoding marks it as content or
boilerplate; a document stays if the base rules pass and content lines hold at least
``MIN_CONTENT`` of its words.

The field is trained on labelled documents: lines of good documents count as content, lines of
bad ones as boilerplate.  Training uses at most ``SAMPLE`` documents of each class (those with the
smallest hash of their id), cut into pieces of ``PIECE`` lines; decoding always sees all lines.

Defined cases: a null or empty text has no words, so it fails the base rules; without labelled
documents of both classes there is no field and the base rules decide alone; ties between the two
states go to content; a text with words but no line break is one line; repeated rows are judged
one by one; a null ``doc_id`` stays null; an empty table gives an empty table.
Lines and word windows of one text are compared by 64-bit hashes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.blocks import IS_SPACE, STEP, Block, blocks, documents, gram_hashes, mixed, separators, span_hashes, words

SAMPLE, PIECE, MIN_CONTENT = 1000, 8, 0.5
MIN_WORDS, MAX_REPEAT_PERCENT, GRAM = 10, 20, 5
IS_SYMBOL = separators(b"#*$%&|<>")
IS_UPPER = separators(bytes(range(65, 91)))
IS_DIGIT = separators(bytes(range(48, 58)))
IS_SHOUT = separators(b"!")


class Field(NamedTuple):
    """Weights of the states (boilerplate, content) and of the moves between them."""

    weight: np.ndarray  # features x 2
    move: np.ndarray  # from x to
    begin: np.ndarray


class Lines(NamedTuple):
    base: dict[str, np.ndarray]  # per document
    first: np.ndarray  # first line of each document; one more entry than documents
    words: np.ndarray  # words of each line
    place: np.ndarray  # position among all lines of the text
    features: np.ndarray


def _sums(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of the stretches between cuts."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[cuts])


def _seen(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys equal an earlier one, and which occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, many = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    many[order[1:]] = same
    many[order[:-1]] |= same
    return later, many


def lines_of(block: Block) -> Lines:
    """Counts of the documents and features of their lines that have a word."""
    data, offsets = block.data, block.offsets
    found = words(data, offsets)
    hashes = span_hashes(data, found.start, found.end)
    breaks = np.flatnonzero(data == 10)
    start = np.union1d(breaks + 1, offsets[:-1])  # of every line, also of lines without words
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))
    row = np.searchsorted(offsets, start, "right") - 1
    end = np.where(end < offsets[row + 1], end - 1, end)  # without the line break
    last = (end > start) & (end == offsets[row + 1]) & (data[end - 1] == 10)  # a break ends the text
    end = np.where(last, end - 1, end)
    of_word = np.searchsorted(start, found.start, "right") - 1
    first_word = np.searchsorted(found.start, np.append(start, len(data)))
    n_words = np.diff(first_word)
    has = n_words > 0

    salt = lambda rows: mixed(rows.astype(np.uint64) + STEP)
    repeated = np.zeros(len(start), bool)
    repeated[has] = _seen(mixed(span_hashes(data, start[has], end[has]) ^ salt(row[has])))[0]
    in_repeat = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) >= GRAM:
        whole = np.flatnonzero(found.row[: len(hashes) - GRAM + 1] == found.row[GRAM - 1 :])
        at = whole[_seen(mixed(gram_hashes(hashes, GRAM)[whole] ^ salt(found.row[whole])))[1]]
        np.add.at(in_repeat, at, 1)
        np.add.at(in_repeat, at + GRAM, -1)
    in_repeat = np.cumsum(in_repeat)[:-1] > 0

    character = ~IS_SPACE[data] & ((data & 0xC0) != 0x80)
    base = {
        "n_words": np.diff(found.first),
        "word_chars": _sums(character, offsets),
        "n_symbols": _sums(IS_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(row[repeated], minlength=len(offsets) - 1)[: len(offsets) - 1],
        "n_repeat_words": _sums(in_repeat, found.first),
    }
    cuts = np.append(start, len(data))
    chars = np.maximum(_sums(character, cuts), 1)
    count = np.maximum(n_words, 1)
    # shares count full from a half (an eighth) of the characters on
    share = lambda flag, times: np.minimum(_sums(flag[data], cuts) / chars * times, 1)
    echo = np.zeros(len(hashes), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    lone = (found.end - found.start == 1) & IS_SYMBOL[data[found.start]]
    features = np.stack(
        [
            np.ones(len(start)), share(IS_SYMBOL, 8), share(IS_UPPER, 2), share(IS_SHOUT, 8), share(IS_DIGIT, 2),
            np.minimum(_sums(lone, first_word) / count * 3, 1), _sums(echo, first_word) / count, _sums(in_repeat, first_word) / count,
            np.log1p(n_words) / 5, np.minimum(chars / count / 10, 3), repeated,
        ],
        axis=1,
    ).astype(np.float64)
    n = len(offsets) - 1
    # the place counts lines without words too; a text may begin with line breaks
    place = np.arange(len(start)) - np.searchsorted(row, np.arange(n))[row]
    return Lines(base, np.searchsorted(row[has], np.arange(n + 1)), n_words[has], place[has], features[has])


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])


# --- The field -----------------------------------------------------------------


def viterbi(field: Field, features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The likeliest states (1: content) of all chains; chain i has the lines first[i]:first[i+1]."""
    emit = features @ field.weight
    state, back = np.zeros(len(emit), np.int8), np.zeros((len(emit), 2), np.int8)
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0))  # chains longer than t
    score = np.zeros((len(size), 2))
    for t, n in enumerate(alive.tolist()):
        at = begin[:n] + t
        if t == 0:
            score[:n] = field.begin + emit[at]
            continue
        paths = score[:n, :, None] + field.move
        content = paths[:, 1] >= paths[:, 0]
        back[at] = content
        score[:n] = np.where(content, paths[:, 1], paths[:, 0]) + emit[at]
    now = (score[:, 1] >= score[:, 0]).astype(np.int8)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = begin[:n] + t
        state[at] = now[:n]
        if t:
            now[:n] = back[at, now[:n]]
    return state


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def train(features: np.ndarray, state: np.ndarray, first: np.ndarray, steps: int = 400, decay: float = 1e-4) -> Field:
    """Maximum likelihood with Adam on exact gradients (forward and backward sums)."""
    cuts = np.unique(np.concatenate([first, *[np.arange(a, b, PIECE) for a, b in zip(first, first[1:])]]))
    size = np.diff(cuts)
    n, longest = len(size), int(size.max())
    at = cuts[:-1, None] + np.arange(longest)
    real = np.arange(longest) < size[:, None]
    at = np.where(real, at, 0)
    x, y = features[at] * real[:, :, None], np.where(real, state[at], 0)
    one = np.eye(2)[y] * real[:, :, None]
    both = real[:, 1:]
    moves = np.einsum("nti,ntj,nt->ij", one[:, :-1], one[:, 1:], both)
    want = np.concatenate([np.einsum("ntf,nts->fs", x, one).ravel(), moves.ravel(), one[:, 0].sum(0)])
    theta, m, v = np.zeros(len(want)), np.zeros(len(want)), np.zeros(len(want))
    width = features.shape[1]
    for step in range(1, steps + 1):
        weight, move, begin = theta[: 2 * width].reshape(width, 2), theta[2 * width : -2].reshape(2, 2), theta[-2:]
        emit = x @ weight
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = begin + emit[:, 0]
        for t in range(1, longest):
            new = _log_sum(forward[:, t - 1, :, None] + move, 1) + emit[:, t]
            forward[:, t] = np.where(real[:, t, None], new, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = _log_sum(move + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], new, 0)
        total = _log_sum(forward[:, -1], 1)
        single = np.exp(forward + backward - total[:, None, None]) * real[:, :, None]
        pair = np.exp(forward[:, :-1, :, None] + move + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None])
        have = np.concatenate(
            [np.einsum("ntf,nts->fs", x, single).ravel(), (pair * both[:, :, None, None]).sum((0, 1)).ravel(), single[:, 0].sum(0)]
        )
        slope = (have - want) / real.sum() + decay * theta
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(theta[: 2 * width].reshape(width, 2), theta[2 * width : -2].reshape(2, 2), theta[-2:])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | None:
    """A field from at most ``sample`` documents of either ``quality`` (0 or 1)."""
    rated = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)")
    chosen = [
        rated.where(F.col("quality") == q).dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        for q in (0, 1)
    ]
    rows = documents(docs).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select("quality", "text")
    taken = sorted((int(q), bytes(t)) for q, t in rows.toLocalIterator())
    if len({q for q, _ in taken}) < 2:
        return None
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in taken], pa.binary())], ["text"])
    features, state, sizes = [], [], []
    done = 0
    for block in blocks([batch]):
        lines = lines_of(block)
        size = np.diff(lines.first)
        features.append(lines.features)
        state.append(np.repeat([q for q, _ in taken[done : done + len(size)]], size))
        sizes.append(size)
        done += len(size)
    first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    if not first[-1]:
        return None
    return train(np.concatenate(features), np.concatenate(state), first)


# --- Operators -----------------------------------------------------------------

JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "content_lines array<int>, n_content_words long, base_failed boolean, kept boolean"
)


def _judge(field: Field | None, block: Block, min_content: float):
    lines = lines_of(block)
    content = np.ones(len(lines.words), bool) if field is None else viterbi(field, lines.features, lines.first) == 1
    n_content = _sums(np.where(content, lines.words, 0), lines.first)
    failed = base_failed(lines.base)
    return lines, content, n_content, failed, ~failed & (n_content >= min_content * lines.base["n_words"])


def judge(docs: DataFrame, field: Field | None, min_content: float = MIN_CONTENT) -> DataFrame:
    """One row per document: its counts, the positions of its content lines, and the verdict."""
    def run(batches):
        for block in blocks(batches):
            lines, content, n_content, failed, kept = _judge(field, block, min_content)
            cuts = np.concatenate([[0], np.cumsum(content)])[lines.first]
            places = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(lines.place[content], pa.int32()))
            counts = [pa.array(c, pa.int64()) for c in lines.base.values()]
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(0), *counts, places, pa.array(n_content, pa.int64()), pa.array(failed), pa.array(kept)],
                ["doc_id", *lines.base, "content_lines", "n_content_words", "base_failed", "kept"],
            )

    return documents(docs).mapInArrow(run, JUDGED)


def keep_good(docs: DataFrame, field: Field | None, min_content: float = MIN_CONTENT) -> DataFrame:
    """The documents that pass: same columns, texts untouched."""
    def run(batches):
        for block in blocks(batches):
            yield block.rows.filter(pa.array(_judge(field, block, min_content)[-1]))

    return docs.mapInArrow(run, docs.schema)
