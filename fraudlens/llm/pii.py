"""Personal data in texts: patterns, and a skip-chain conditional random field over number-like tokens.

The base spans are what four patterns match, leftmost and without overlap, each kind by itself:
e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers; a match that fails its check is dropped and
not tried again.  The patterns are evaluated on byte arrays in a few passes, so no text makes them backtrack.

The field finds what they miss, such as a number glued to the next one, or a phone number written
elsewhere in the text without its plus.  Its variables are the words with an ``@`` or with digits that could belong to
an entity (``could_be``), its states none and the four kinds.  Adjacent variables share a chain potential.
Variables of one text that repeat each other share a skip potential, however far apart they stand: equal words, equal
names before an ``@``, numbers with equal last nine digits (a number may be spread over four words).  Each group of them is linked
as a star, so the number of links is linear in the text.  Words of base spans are observed.  Loopy belief propagation (sums,
damped) passes messages along all links; a word takes its likeliest state if its probability is ``SURE`` or more.
Runs of words of one kind become spans if they pass that kind's check; base spans always stay, and a span that
touches one is not added.

Training: pseudo-likelihood of the base labels on at most ``SAMPLE`` texts, a sample drawn by hash, with at most
``PIECE`` variables each; the texts are labelled in tasks, and only these bounded arrays reach the driver.  Matches that
failed their check over several words say nothing and are left out.  Copies of linked variables without their own features teach
the skip potentials to stand alone.  Decoding has no bounds: it sees all words of all texts.

Defined cases: a null or empty text has no spans; offsets count code points, ends are exclusive; repeated rows and null ids are
kept and found alike; without any base span to learn from there is no field and the base spans are all; an empty table gives an
empty table.  A task holds a block of texts (one longer text is a block), and at most about 100 bytes a byte of it where a text
consists of numbers only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.blocks import Block, blocks, documents, mixed, separators, span_hashes, words

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
CARD_DIGITS, PHONE_DIGITS, MAX_PART = (13, 19), (9, 15), 255

SAMPLE, PIECE, SURE = 2000, 200, 0.9
ROUNDS, DAMPING = 12, 0.3
CHUNK = 1 << 16  # links whose messages are computed at once
SUFFIX, REACH = 9, 4  # digits that two numbers share; words a number may be spread over
STATES = 1 + len(KINDS)
LINKS = ("word", "name", "number")

DIGIT = separators(b"0123456789")
LETTER = separators(bytes([*range(65, 91), *range(97, 123)]))
LABEL = separators(bytes([*range(48, 58), *range(65, 91), *range(97, 123)]) + b"-")
LOCAL = LABEL | separators(b"._%+")
PHONE_BODY = DIGIT | separators(b" ().-")


class Text(NamedTuple):
    """The bytes of a block's texts, each followed by a zero byte, with the arrays all steps share."""

    data: np.ndarray
    begin: np.ndarray  # of each text; one more entry than texts
    is_digit: np.ndarray
    digits: np.ndarray  # positions of the digits
    value: np.ndarray  # their values
    before: np.ndarray  # digits before each position


class Spans(NamedTuple):
    kind: np.ndarray
    start: np.ndarray
    end: np.ndarray


def text_of(block: Block) -> Text:
    n = len(block.offsets) - 1
    data = np.zeros(len(block.data) + n, np.uint8)
    row = np.repeat(np.arange(n), np.diff(block.offsets))
    data[np.arange(len(block.data)) + row] = block.data
    is_digit = DIGIT[data]
    digits = np.flatnonzero(is_digit)
    before = np.concatenate([[0], np.cumsum(is_digit)])
    return Text(data, block.offsets + np.arange(n + 1), is_digit, digits, data[digits].astype(np.int64) - 48, before)


def _neighbours(flag: np.ndarray) -> np.ndarray:
    """Where both neighbours have the flag."""
    out = np.zeros(len(flag), bool)
    out[1:-1] = flag[:-2] & flag[2:]
    return out


def _runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flag.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _next_without(flag: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first position from ``at`` on without the flag; texts end with a byte that has none."""
    bare = np.flatnonzero(~flag)
    return bare[np.searchsorted(bare, at)] if len(at) else at


def luhn(value: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which digit runs (first index, count of up to 19) have a valid check digit."""
    total = np.zeros(len(first), np.int64)
    for j in range(CARD_DIGITS[1]):
        has = j < count
        d = np.where(has, value[np.where(has, first + count - 1 - j, 0)], 0) if len(value) else total
        if j % 2:
            d = np.where(d > 4, 2 * d - 9, 2 * d)
        total += d
    return total % 10 == 0


# --- Patterns ------------------------------------------------------------------------


def _emails(t: Text) -> Spans:
    at = np.flatnonzero(t.data == 64)
    label = LABEL[t.data]
    dot = (t.data == 46) & _neighbours(label)
    at = at[label[at + 1]]
    end = _next_without(label | dot, at + 1)
    dots = np.concatenate([[0], np.cumsum(dot)])
    bare = np.flatnonzero(~LOCAL[t.data])
    start = np.concatenate([[0], bare + 1])[np.searchsorted(bare, at)]
    good = (dots[end] > dots[at + 1]) & (start < at)
    found, last = [], 0
    for s, p, e in zip(start[good].tolist(), at[good].tolist(), end[good].tolist()):
        s = max(s, last)
        if s < p:
            found.append((s, e))
            last = e
    found = np.array(found, np.int64).reshape(-1, 2)
    return Spans(np.full(len(found), EMAIL), found[:, 0], found[:, 1])


def _small_parts(t: Text, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which digit runs are numbers of at most MAX_PART, leading zeros allowed."""
    nonzero = np.concatenate([[0], np.cumsum(t.value > 0)])
    last, n = t.before[end], end - start
    number = np.zeros(len(start), np.int64)
    for j in range(3):
        has = j < n
        number += np.where(has, t.value[np.where(has, last - 1 - j, 0)] if len(t.value) else 0, 0) * 10**j
    head = nonzero[np.maximum(last - 3, last - n)] - nonzero[last - n]
    return (head == 0) & (number <= MAX_PART)


def _addresses(t: Text) -> tuple[Spans, np.ndarray]:
    """Four numbers with dots between; every fourth number of a longer row starts the next match."""
    start, end = _runs(t.is_digit)
    if not len(start):
        return Spans(np.zeros(0, np.int64), start, end), np.zeros(0, bool)
    follows = np.concatenate([[False], (start[1:] == end[:-1] + 1) & (t.data[end[:-1]] == 46)])
    chain = np.cumsum(~follows) - 1
    head = np.flatnonzero(~follows)
    place = np.arange(len(start)) - head[chain]
    size = np.diff(np.append(head, len(start)))[chain]
    first = np.flatnonzero((place % 4 == 0) & (place + 4 <= size))
    fit = _small_parts(t, start, end)
    good = fit[first[:, None] + np.arange(4)].all(1) if len(first) else np.zeros(0, bool)
    return Spans(np.full(len(first), IP), start[first], end[first + 3]), good


def _cards(t: Text) -> tuple[Spans, np.ndarray]:
    gap = ((t.data == 32) | (t.data == 45)) & _neighbours(t.is_digit)
    start, end = _runs(t.is_digit | gap)
    n = t.before[end] - t.before[start]
    good = (n >= CARD_DIGITS[0]) & (n <= CARD_DIGITS[1])
    good[good] = luhn(t.value, t.before[start[good]], n[good])
    return Spans(np.full(len(start), CARD), start, end), good


def _phones(t: Text) -> tuple[Spans, np.ndarray]:
    plus = np.flatnonzero(t.data == 43)
    plus = plus[t.is_digit[plus + 1]]
    stop = _next_without(PHONE_BODY[t.data], plus + 2)
    end = t.digits[t.before[stop] - 1] + 1 if len(plus) else stop
    real = end >= plus + 4
    plus, end = plus[real], end[real]
    n = t.before[end] - t.before[plus]
    return Spans(np.full(len(plus), PHONE), plus, end), (n >= PHONE_DIGITS[0]) & (n <= PHONE_DIGITS[1])


def base_spans(t: Text) -> tuple[Spans, Spans]:
    """The matches that pass their checks, and the ones dropped."""
    mails = _emails(t)
    found = [(mails, np.ones(len(mails.start), bool)), _addresses(t), _cards(t), _phones(t)]
    good = np.concatenate([ok for _, ok in found])
    every = [np.concatenate([getattr(spans, f) for spans, _ in found]).astype(np.int64) for f in Spans._fields]
    return Spans(*(x[good] for x in every)), Spans(*(x[~good] for x in every))


# --- The graph of a block ------------------------------------------------------------


class Graph(NamedTuple):
    row: np.ndarray  # text of each variable
    start: np.ndarray  # its word, cut to its core
    end: np.ndarray
    features: np.ndarray
    follows: np.ndarray  # it stands right behind the variable before it
    links: list[np.ndarray]  # per kind of link: pairs of variables
    state: np.ndarray  # 0, or 1 + kind where a base span covers a part of it
    trusted: np.ndarray  # no dropped match of several words touches it


def _count(flag: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag)])
    return total[end] - total[start]


def could_be(at_signs: np.ndarray, digits: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Words with an ``@``, and those in a row of REACH adjacent words (or fewer, where a row begins) with SUFFIX - 2 digits."""
    here = np.arange(len(digits))
    first = np.maximum(np.maximum.accumulate(np.where(follows, 0, here)), here - REACH + 1)
    total = np.concatenate([[0], np.cumsum(digits)])
    row_end = np.flatnonzero(total[here + 1] - total[first] >= SUFFIX - 2)
    out = at_signs > 0
    for back in range(REACH):
        out[row_end[first[row_end] <= row_end - back] - back] = True
    return out


def _stars(row: np.ndarray, key: np.ndarray, who: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Links of each group of equal (row, key) with its first member, observed ones first."""
    group = mixed(key ^ mixed(row.astype(np.uint64) + np.uint64(1)))
    order = np.lexsort([who, state[who] == 0, group])
    group, who = group[order], who[order]
    new = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
    hub = who[np.flatnonzero(new)][np.cumsum(new) - 1] if len(group) else who
    return np.stack([hub[~new], who[~new]], axis=1).reshape(-1, 2)


def graph(block: Block, t: Text, kept: Spans, dropped: Spans) -> Graph:
    found = words(block.data, block.offsets)
    start, end = found.start + found.row, found.end + found.row
    n_at, n_digits = _count(t.data == 64, start, end), t.before[end] - t.before[start]
    has = np.flatnonzero((n_at > 0) | (n_digits > 0))
    adjacent = lambda at, row: np.concatenate([[False], (np.diff(at) == 1) & (row[1:] == row[:-1])])[: len(at)]
    keep = has[could_be(n_at[has], n_digits[has], adjacent(has, found.row[has]))] if len(has) else has
    row, start, end = found.row[keep], start[keep], end[keep]
    follows = adjacent(keep, row)

    # the core of a word: from its first letter, digit, plus or parenthesis to its last letter or digit
    body = LETTER[t.data] | t.is_digit
    opening, closing = np.flatnonzero(body | (t.data == 43) | (t.data == 40)), np.flatnonzero(body)
    first = opening[np.minimum(np.searchsorted(opening, start), len(opening) - 1)] if len(opening) else start
    last = closing[np.maximum(np.searchsorted(closing, end) - 1, 0)] + 1 if len(closing) else end
    bare = (first >= end) | (last <= first)
    start, end = np.where(bare, start, first), np.where(bare, end, last)

    n_at, n_digits = _count(t.data == 64, start, end), t.before[end] - t.before[start]
    n_letters = _count(LETTER[t.data], start, end)
    n_dots = _count((t.data == 46) & _neighbours(t.is_digit), start, end)
    hyphens = _count((t.data == 45) & _neighbours(t.is_digit), start, end)
    length = end - start
    in_card = (n_digits >= CARD_DIGITS[0]) & (n_digits <= CARD_DIGITS[1])
    valid = np.zeros(len(start), bool)
    valid[in_card] = luhn(t.value, t.before[start[in_card]], n_digits[in_card])
    steps = np.searchsorted([1, 3, 4, 5, 9, 13, 20], n_digits, "right")
    opens = t.data[start] if len(start) else np.zeros(0, np.uint8)
    features = np.concatenate(
        [
            np.eye(8)[steps],
            np.stack(
                [
                    np.ones(len(start)), valid, in_card & ~valid, (n_dots == 3) & (n_letters == 0), n_dots > 0, hyphens > 0, n_at > 0,
                    (n_at > 0) & (_count((t.data == 46) & _neighbours(LABEL[t.data]), start, end) > 0), opens == 43, opens == 40,
                    n_letters > 0, n_letters > n_digits, length > n_digits + n_letters + n_dots + hyphens + n_at,
                ],
                axis=1,
            ),
        ],
        axis=1,
    ).astype(np.float32)

    state, trusted = np.zeros(len(start), np.int8), np.ones(len(start), bool)
    for spans, mark in ((dropped, False), (kept, True)):
        low, high = np.searchsorted(end, spans.start, "right"), np.searchsorted(start, spans.end)
        several = high > low + 1
        for kind, a, b, many in zip(spans.kind.tolist(), low.tolist(), high.tolist(), several.tolist()):
            if mark:
                state[a:b] = 1 + kind
            elif many:
                trusted[a:b] = False
    trusted |= state > 0

    folded = np.where((t.data >= 65) & (t.data <= 90), t.data + 32, t.data).astype(np.uint8)
    here = np.arange(len(start))
    links = []
    long_ = here[length >= 4]
    links.append(_stars(row[long_], span_hashes(folded, start[long_], end[long_]), long_, state))
    signs = np.flatnonzero(t.data == 64)
    named = here[n_at > 0]
    sign = signs[np.searchsorted(signs, start[named])] if len(named) else named
    named, sign = named[sign - start[named] >= 3], sign[sign - start[named] >= 3]
    links.append(_stars(row[named], span_hashes(folded, start[named], sign), named, state))
    plain = (n_letters == 0) & (n_at == 0) & (n_digits > 0)
    link = follows & plain & np.concatenate([[False], plain[:-1]])[: len(plain)]
    from_ = here.copy()
    for _ in range(REACH - 1):  # each word back to at most REACH - 1 words before it
        back = from_[np.maximum(here - 1, 0)]
        from_ = np.where(link, np.maximum(back, here - REACH + 1), here)
    last_digit = t.before[end]
    numbered = here[plain & (last_digit - t.before[start[from_]] >= SUFFIX)] if len(here) else here
    key = np.zeros(len(numbered), np.uint64)
    for j in range(SUFFIX):
        key = key * np.uint64(10) + t.value[last_digit[numbered] - SUFFIX + j].astype(np.uint64)
    links.append(_stars(row[numbered], mixed(key + np.uint64(1)), numbered, state))
    return Graph(row, start, end, features, follows, links, state, trusted)


# --- The field ---------------------------------------------------------------------------


class Field(NamedTuple):
    weight: np.ndarray  # features x states
    chain: np.ndarray  # state before x state
    skip: np.ndarray  # kind of link x states x states, symmetric


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(1, keepdims=True)
    return np.log(np.exp(x - top).sum(1)) + top[:, 0]


def beliefs(field: Field, g: Graph) -> np.ndarray:
    """Probabilities of the states of all variables after loopy message passing."""
    local = (g.features @ field.weight).astype(np.float32)
    seen = np.flatnonzero(g.state)
    local[seen] = -60
    local[seen, g.state[seen]] = 0
    behind = np.flatnonzero(g.follows)
    pairs = [np.stack([behind - 1, behind], axis=1), *g.links]
    # both ways of every link; way i ^ 1 is the other way of way i
    ways = []
    for pair, table in zip(pairs, [field.chain, *field.skip]):
        ways += [(pair[:, 0], pair[:, 1], table.astype(np.float32)), (pair[:, 1], pair[:, 0], table.T.astype(np.float32))]
    sent = [np.zeros((len(a), STATES), np.float32) for a, _, _ in ways]
    belief = local
    for _ in range(ROUNDS if any(len(a) for a, _, _ in ways) else 0):
        fresh = []
        for i, (a, _, table) in enumerate(ways):
            out = np.empty_like(sent[i])
            for low in range(0, len(a), CHUNK):
                part = slice(low, low + CHUNK)
                cavity = belief[a[part]] - sent[i ^ 1][part]
                new = _log_sum(cavity[:, :, None] + table)
                out[part] = (new - new.max(1, keepdims=True)) * (1 - DAMPING) + sent[i][part] * DAMPING
            fresh.append(out)
        sent, belief = fresh, local.copy()
        for (_, b, _), out in zip(ways, sent):
            for k in range(STATES):
                belief[:, k] += np.bincount(b, out[:, k], len(belief))
    p = np.exp(belief - belief.max(1, keepdims=True)) if len(belief) else belief
    return p / p.sum(1, keepdims=True)


# --- Training ------------------------------------------------------------------------------

FEATURES = 21


def examples(g: Graph) -> tuple[np.ndarray, np.ndarray]:
    """What pseudo-likelihood needs of each trusted variable, as small numbers, and its text.

    Columns: features, states before and behind (one-hot), states linked by each kind of link, own state.
    """
    n = len(g.row)
    one = np.eye(STATES, dtype=np.uint8)[g.state]
    behind = np.flatnonzero(g.follows)
    before, after = np.zeros((n, STATES), np.uint8), np.zeros((n, STATES), np.uint8)
    usable = behind[g.trusted[behind] & g.trusted[behind - 1]]
    before[usable], after[usable - 1] = one[usable - 1], one[usable]
    linked = np.zeros((n, len(LINKS), STATES), np.uint8)
    for i, pair in enumerate(g.links):
        pair = pair[g.trusted[pair].all(1)]
        for a, b in (pair.T, pair.T[::-1]):
            linked[b, i, g.state[a]] = 1
    table = np.concatenate([g.features.astype(np.uint8), before, after, linked.reshape(n, len(LINKS) * STATES), g.state[:, None].astype(np.uint8)], axis=1)
    return table[g.trusted], g.row[g.trusted]


def train(table: np.ndarray, steps: int = 300, decay: float = 2e-5) -> Field | None:
    """The field of largest pseudo-likelihood, by Adam on exact gradients."""
    if not len(table) or not table[:, -1].any():
        return None
    cuts = np.cumsum([FEATURES, STATES, STATES, STATES * len(LINKS)])
    alone = table[table[:, cuts[2] : cuts[3]].any(1)].copy()
    alone[:, :FEATURES] = 0
    alone[:, 8] = 1  # what all variables have
    # equal examples weigh by their number
    table, weight = np.unique(np.concatenate([table, alone]), axis=0, return_counts=True)
    x, before, after, linked = (part.astype(np.float32) for part in np.split(table[:, :-1], cuts[:-1], axis=1))
    want = np.eye(STATES, dtype=np.float32)[table[:, -1]]
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    shapes = [(FEATURES, STATES), (STATES, STATES), (len(LINKS) * STATES, STATES)]
    theta = [np.zeros(shape) for shape in shapes]
    first, second = [np.zeros(shape) for shape in shapes], [np.zeros(shape) for shape in shapes]

    def symmetric(skip: np.ndarray) -> np.ndarray:
        cube = skip.reshape(len(LINKS), STATES, STATES)
        return (cube + cube.transpose(0, 2, 1)).reshape(skip.shape)

    for step in range(1, steps + 1):
        own, chain, skip = theta
        score = x @ own + before @ chain + after @ chain.T + linked @ symmetric(skip)
        p = np.exp(score - score.max(1, keepdims=True))
        off = (p / p.sum(1, keepdims=True) - want) * weight
        slopes = [x.T @ off, before.T @ off + (after.T @ off).T, symmetric(linked.T @ off)]
        for i, slope in enumerate(slopes):
            slope = slope + decay * theta[i]
            first[i], second[i] = 0.9 * first[i] + 0.1 * slope, 0.999 * second[i] + 0.001 * slope**2
            theta[i] = theta[i] - 0.1 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Field(theta[0], theta[1], symmetric(theta[2]).reshape(len(LINKS), STATES, STATES))


def _labelled(block: Block) -> tuple[Text, Spans, Graph]:
    t = text_of(block)
    kept, dropped = base_spans(t)
    return t, kept, graph(block, t, kept, dropped)


def fit(docs: DataFrame, sample: int = SAMPLE, piece: int = PIECE) -> Field | None:
    """A field from at most ``sample`` texts that have variables, the first ``piece`` of each.

    They are those of smallest hash among about 16 times as many texts, drawn by hash as well.
    """
    def run(batches):
        for block in blocks(batches):
            table, row = examples(_labelled(block)[2])
            cuts = np.searchsorted(row, np.arange(block.rows.num_rows + 1))
            some = np.flatnonzero(np.diff(cuts))
            packed = [table[cuts[i] : min(cuts[i + 1], cuts[i] + piece)].tobytes() for i in some]
            yield pa.RecordBatch.from_arrays([block.rows.column(0).take(pa.array(some)), pa.array(packed, pa.binary())], ["h", "rows"])

    rows = documents(docs).select(F.xxhash64("doc_id", "text").alias("h"), "text")
    share = min(1.0, 16 * sample / max(docs.count(), 1))
    drawn = rows.where(F.col("h") <= F.lit(int(min(-(2**63) + share * 2**64, 2**63 - 1024))) if share < 1 else F.lit(True))
    chosen = drawn.mapInArrow(run, "h long, rows binary").orderBy("h", "rows").limit(sample)
    packed = b"".join(bytes(r["rows"]) for r in chosen.collect())  # sample x piece rows of FEATURES + 26 bytes at most
    width = FEATURES + 2 * STATES + len(LINKS) * STATES + 1
    return train(np.frombuffer(packed, np.uint8).reshape(-1, width))


# --- Decoding ------------------------------------------------------------------------------


def _of_run(t: Text, kind: int, run: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The spans that a run of adjacent words of one kind holds; what fails the kind's check holds none."""
    if kind == EMAIL:
        for a, b in run:
            sign = a + int(np.argmax(t.data[a:b] == 64))
            local, label = LOCAL[t.data[a:sign]][::-1], LABEL[t.data[sign + 1 : b]] | (t.data[sign + 1 : b] == 46)
            left = int(np.argmin(np.append(local, False)))
            right = int(np.argmin(np.append(label, False)))
            while right and t.data[sign + right] == 46:
                right -= 1
            if t.data[sign] == 64 and left and right:
                yield sign - left, sign + 1 + right
        return
    first = [int(t.digits[t.before[a]]) if t.before[b] > t.before[a] else a for a, b in run]
    last = [int(t.digits[t.before[b] - 1]) + 1 if t.before[b] > t.before[a] else a for a, b in run]
    if kind == IP:
        for a, b in zip(first, last):
            parts = t.data[a:b].tobytes().split(b".")
            if len(parts) == 4 and all(p.isdigit() and int(p.lstrip(b"0")[:4] or 0) <= MAX_PART for p in parts):
                yield a, b
        return
    least, most = CARD_DIGITS if kind == CARD else PHONE_DIGITS
    at = 0
    while at < len(run):
        found, size = None, 0
        for to in range(at, len(run)):
            if kind == PHONE and to > at and t.data[run[to][0]] == 43:
                break
            size += int(t.before[last[to]] - t.before[first[to]])
            if size > most:
                break
            if size >= least and (kind == PHONE or luhn(t.value, t.before[[first[at]]], np.array([size]))[0]):
                found = to
                if kind == CARD:
                    break
        if found is None:
            at += 1
            continue
        opens = run[at][0] if kind == PHONE and t.data[run[at][0]] in (40, 43) else first[at]
        yield opens, last[found]
        at = found + 1


def added_spans(t: Text, g: Graph, field: Field) -> Spans:
    """The spans of words that no base span touches."""
    p = beliefs(field, g)
    state = np.where((g.state == 0) & (p.max(1, initial=0) >= SURE), p.argmax(1) if len(p) else 0, 0)
    named = np.flatnonzero(state)
    joined = np.concatenate([[False], (np.diff(named) == 1) & g.follows[named[1:]] & (state[named[1:]] == state[named[:-1]])])[: len(named)]
    runs = np.split(named, np.flatnonzero(~joined)[1:]) if len(named) else []
    found = []
    for run in runs:
        kind = int(state[run[0]]) - 1
        places = list(zip(g.start[run].tolist(), g.end[run].tolist()))
        found += [(kind, a, b) for a, b in _of_run(t, kind, places)]
    return Spans(*np.array(found, np.int64).reshape(-1, 3).T)


SPAN = "array<struct<kind:string,start:int,end:int>>"
_SPAN_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _listed(t: Text, spans: Spans, n: int) -> tuple[pa.ListArray, np.ndarray, Spans]:
    """Spans as one list a text, by kind, then start, in code points; also their texts and the sorted spans."""
    row = np.searchsorted(t.begin, spans.start, "right") - 1
    order = np.lexsort([spans.start, spans.kind, row])
    row, spans = row[order], Spans(*(x[order] for x in spans))
    points = np.concatenate([[0], np.cumsum((t.data & 0xC0) != 0x80)])
    zero = points[t.begin[row]]
    entries = pa.StructArray.from_arrays(
        [
            pa.array(np.array(KINDS, object)[spans.kind], pa.string()), pa.array(points[spans.start] - zero, pa.int32()),
            pa.array(points[spans.end] - zero, pa.int32()),
        ],
        fields=list(_SPAN_TYPE),
    )
    cuts = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), entries), row, spans


def _all_spans(block: Block, field: Field | None) -> tuple[Text, Spans, Spans]:
    if field is None:
        t = text_of(block)
        kept = base_spans(t)[0]
        return t, kept, kept
    t, kept, g = _labelled(block)
    added = added_spans(t, g, field)
    return t, kept, Spans(*(np.concatenate([a, b]) for a, b in zip(kept, added)))


def find(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id, base, spans``: base spans and all spans of each text, by kind, then start."""
    def run(batches):
        for block in blocks(batches):
            n = block.rows.num_rows
            t, kept, every = _all_spans(block, field)
            yield pa.RecordBatch.from_arrays([block.rows.column(0), _listed(t, kept, n)[0], _listed(t, every, n)[0]], ["doc_id", "base", "spans"])

    return documents(docs).mapInArrow(run, f"doc_id long, base {SPAN}, spans {SPAN}")


def redact(docs: DataFrame, field: Field | None) -> DataFrame:
    """The documents with every found span replaced by its kind in brackets; same rows and columns, null texts stay."""
    def run(batches: Iterable[pa.RecordBatch]):
        for block in blocks(batches):
            t, _, every = _all_spans(block, field)
            order = np.lexsort([-every.end, every.start])
            whole, texts = t.data.tobytes(), []
            spans = [(a, b, KINDS[k]) for k, a, b in zip(*(x[order].tolist() for x in every))]
            at = 0
            for low, high in zip(t.begin.tolist(), (t.begin[1:] - 1).tolist()):
                parts, done = [], low
                while at < len(spans) and spans[at][0] < high:
                    a, b, kind = spans[at]
                    if a >= done:
                        parts += [whole[done:a], f"[{kind}]".encode()]
                    done, at = max(done, b), at + 1
                texts.append(b"".join([*parts, whole[done:high]]))
            place = block.rows.schema.get_field_index("text")
            old = block.rows.column(place)
            new = pa.array([x.decode("utf-8", "replace") if ok else None for x, ok in zip(texts, old.is_valid().to_pylist())], old.type)
            yield block.rows.set_column(place, block.rows.schema.field(place), new)

    return docs.mapInArrow(run, docs.schema)
