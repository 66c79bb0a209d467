"""Each operator against a brute-force version on small tables with the awkward cases."""

import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fraudlens.llm import (
    bpe, components, kneser_ney, line_dedup, line_quality, packing, repeats, simhash, suffix_array, suffix_tree, warc, winnowing,
)
from fraudlens.llm.blocks import blocks, window_minima

DOCS = "doc_id long, text string, doc string, version int, spans string"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def made(seed, n=60):
    """Texts with nulls, empties, copies, shared passages, a repeated id and a null id; clashing columns."""
    rng = random.Random(seed)
    passages = [" ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 4))) for _ in range(40)) for _ in range(5)]
    rows = [(None, passages[0]), (3, None), (4, ""), (5, " \n\t"), (7, passages[1]), (7, passages[1])]
    for i in range(10, 10 + n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            parts.append(p[a : a + rng.randint(5, 120)] + rng.choice(["", "x", "\nY z"]))
        rows.append((i, "".join(parts)))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(d, t, "c", 1, None) for d, t in rows], DOCS)


# --- 1 -------------------------------------------------------------------------


def test_best_fit_matches_a_plain_search():
    rng = random.Random(1)
    for _ in range(50):
        length = rng.randint(1, 40)
        sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 60))]
        plain = []
        for size in sorted(sizes, reverse=True):
            fits = [r for r in plain if r >= size]
            if fits:
                plain.remove(min(fits))
                plain.append(min(fits) - size)
            else:
                plain.append(length - size)
        rows = packing.best_fit(sizes, length)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert sorted(length - sum(sizes[i] for i in r) for r in rows) == sorted(plain)


def test_packed_rows_restore_the_texts(spark, tmp_path):
    rows = made(2) + [(900, "word " * 300)]
    packed = packing.pack(table(spark, rows), public_tokenizers.path("byte_bpe_50k.tiktoken"), length=64, group=500)
    coder = packing.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    pieces = []
    for r in packed.collect():
        ids, position = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == 64 and r.cu_seqlens[-1] == r.n_tokens and (ids[r.n_tokens :] == coder.n_vocab).all()
        for a, b, doc, at in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.offsets):
            assert position[a:b].tolist() == list(range(b - a))
            pieces.append((doc, at, ids[a:b].tolist()))
    expected = [(d, a, ids[a : a + 64]) for d, t in rows for ids in [coder.encode_ordinary(t or "")] for a in range(0, len(ids), 64)]
    assert sorted(pieces, key=str) == sorted(expected, key=str)
    files = packing.write_matrices(packed, str(tmp_path / "m"), 64).collect()
    assert sum(f.n_rows for f in files) == packed.count()
    assert all(len(open(f.file, "rb").read()) == f.n_rows * 128 for f in files)
    assert packing.pack(table(spark, []), public_tokenizers.path("byte_bpe_50k.tiktoken")).count() == 0


def test_long_white_space_is_encoded_like_the_library(spark, monkeypatch):
    """With a low bound every run is cut; the ids stay the library's."""
    coder = packing.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(8)
    kinds = [" ", "  ", "\n", "\t", "\xa0", "\u3000", "\x1c", "a", "é", "1", "'s", "$", "\r\n"]
    texts = ["".join(rng.choice(kinds) * rng.randint(1, 6) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    for low in (1, 2, 3):
        with monkeypatch.context() as m:
            m.setattr(packing, "LONG", low)
            m.setattr(packing, "LONG_WHITE", re.compile(packing.LONG_WHITE.pattern.replace("20000", str(low))))
            assert packing.encode(coder, texts) == [coder.encode_ordinary(t) for t in texts]
    spaces = " " * 10_000_000
    (ids,) = packing.encode(coder, [f"x{spaces}y"])
    assert coder.decode(ids) == f"x{spaces}y" and ids[-1:] == coder.encode_ordinary(" y")
    rows = [(1, " " * 1_000_000), (2, "\n" * 1_000_000 + "end"), (3, "a" * 1_000_000), (4, "$" * 1_000_000), (5, None)]
    packed = packing.pack(table(spark, rows), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    sizes = {d: len(i) for (d, t), i in zip(rows, packing.encode(coder, [t or "" for _, t in rows]))}
    got = Counter()
    for r in packed.collect():
        for a, b, doc in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids):
            got[doc] += b - a
    assert got == {d: n for d, n in sizes.items() if n}


# --- 2 -------------------------------------------------------------------------


def test_kneser_ney_matches_its_formulas(spark):
    rows = made(3)
    train, texts = [t for d, t in rows if (d or 0) % 3], [t for _, t in rows] + ["unseen words"]
    cut = lambda t: SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</e>"]
    pairs, single = Counter(), Counter()
    for t in train:
        words = cut(t)
        single.update(words)
        pairs.update(zip(["<s>", *words], words))
    total, spread, heard = Counter(), defaultdict(lambda: [0] * 4), Counter()
    for (v, w), c in pairs.items():
        total[v] += c
        spread[v][min(c, 3)] += 1
        heard[w] += 1
    seen = lambda values: [sum(x == k for x in values) for k in (1, 2, 3, 4)]
    d2, d1 = kneser_ney.discounts(seen(pairs.values())), kneser_ney.discounts(seen(heard.values()))
    rest = sum(d1[min(a, 3)] for a in heard.values()) / len(pairs)
    n, kinds = sum(single.values()), len(single)

    def chance(v, w):
        low = max(heard[w] - d1[min(heard[w], 3)], 0) / len(pairs) + rest / (kinds + 1)
        if not total[v]:
            return low
        c = pairs[v, w]
        return (max(c - d2[min(c, 3)], 0) + sum(d2[k] * spread[v][k] for k in (1, 2, 3)) * low) / total[v]

    for v in [*total][:5]:
        assert sum(chance(v, w) for w in single) + chance(v, "<unknown>") == pytest.approx(1)
    model = kneser_ney.fit(table(spark, [(d, t) for d, t in rows if (d or 0) % 3]))
    assert (model.tokens, model.vocabulary, model.pairs) == (n, kinds, len(pairs))
    got = kneser_ney.score(table(spark, list(enumerate(texts))), model).collect()
    for r in got:
        words = cut(texts[r.doc_id])
        assert (r.n_tokens, r.n_known) == (len(words), sum(single[w] > 0 for w in words))
        assert r.score == pytest.approx(sum(math.log10(chance(v, w)) for v, w in zip(["<s>", *words], words)))
        assert r.base_score == pytest.approx(sum(math.log10((single[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in words))
    empty = kneser_ney.fit(table(spark, []))
    assert empty.tokens == 0 and kneser_ney.score(table(spark, [(1, None)]), empty).first().n_tokens == 1


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("buckets", [1, 4, 97])
def test_kneser_ney_of_any_order_matches_its_formulas(spark, order, buckets):
    rng = random.Random(order)
    # one word is a third of the tokens, so bounds of many buckets cut it and its pairs
    rows = made(3) + [(i, " ".join(rng.choice(["the", "of", f"w{rng.randint(0, 60)}"]) for _ in range(60))) for i in range(200, 212)]
    rows.append((301, "the of " * 400))  # counts above 255
    train, texts = [t for d, t in rows if (d or 0) % 3], [t for _, t in rows] + ["unseen words", "the the unseen of the"]
    cut = lambda t: SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</e>"]
    around = lambda t: [tuple((["<s>"] * (order - 1) + cut(t))[i : i + order]) for i in range(len(cut(t)))]
    count = {order: Counter(g for t in train for g in around(t))}
    for k in range(order - 1, 0, -1):
        count[k] = Counter(g[1:] for g in count[k + 1])
    single = Counter(w for t in train for w in cut(t))
    cuts = {k: kneser_ney.discounts([sum(c == n for c in count[k].values()) for n in (1, 2, 3, 4)]) for k in count}
    after = {k: defaultdict(list) for k in count}
    for k in count:
        for g, c in count[k].items():
            after[k][g[:-1]].append(c)
    rest = sum(cuts[1][min(c, 3)] for c in count[1].values()) / len(count[2])

    def chance(g):
        k = len(g)
        c = count[k][g]
        if k == 1:
            return max(c - cuts[1][min(c, 3)], 0) / len(count[2]) + rest / (len(single) + 1)
        seen = after[k][g[:-1]]
        if not seen:
            return chance(g[1:])
        return (max(c - cuts[k][min(c, 3)], 0) + sum(cuts[k][min(x, 3)] for x in seen) * chance(g[1:])) / sum(seen)

    for g in [*count[order]][:5]:
        assert sum(chance((*g[:-1], w)) for w in [*single, "<unknown>"]) == pytest.approx(1)
    model = kneser_ney.fit(table(spark, [(d, t) for d, t in rows if (d or 0) % 3]), order=order, buckets=buckets)
    assert (model.order, model.tokens, model.vocabulary, model.pairs) == (order, sum(single.values()), len(single), len(count[2]))
    assert max(count[order].values()) > 255 and (buckets < 97 or all(model.cut.values()))
    for r in kneser_ney.score(table(spark, list(enumerate(texts))), model).collect():
        assert (r.n_tokens, r.n_known) == (len(cut(texts[r.doc_id])), sum(single[w] > 0 for w in cut(texts[r.doc_id])))
        assert r.score == pytest.approx(sum(math.log10(chance(g)) for g in around(texts[r.doc_id])))
    empty = kneser_ney.fit(table(spark, []), order=order, buckets=buckets)
    assert empty.tokens == 0 and kneser_ney.score(table(spark, [(1, None)]), empty).first().n_tokens == 1


def test_kneser_ney_spreads_a_frequent_word_over_buckets(spark, monkeypatch):
    texts = [" ".join(f"the w{i}x{j} y{i % 3}" for j in range(100)) for i in range(60)]
    model = kneser_ney.fit(table(spark, list(enumerate(texts))), buckets=12)
    held = [os.path.getsize(f"{model.path}/counts-2-{b}") for b in range(12) if os.path.exists(f"{model.path}/counts-2-{b}")]
    assert sum(held) == model.pairs and max(held) < model.pairs / 4
    monkeypatch.setattr(kneser_ney, "GATHERED", 500)
    assert kneser_ney.fit(table(spark, list(enumerate(texts)))).buckets == model.tokens // 500 + 1


# --- 3 -------------------------------------------------------------------------


def plain_fingerprint(text):
    words = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                label[root(a)] = root(b)
    return {p: root(p) for p in prints}


def test_every_pair_within_two_bits_shares_a_key():
    rng = random.Random(4)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 2)):
            b ^= 1 << bit
        keys = simhash.keys_of(np.array([a, b], np.uint64).view(np.int64))
        assert set(keys[0]) & set(keys[1])


@pytest.mark.parametrize("bucket", [64, 2])
def test_near_duplicates(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rows = made(5)
    got = simhash.near_duplicates(table(spark, rows)).collect()
    prints = {t: plain_fingerprint(t) for _, t in rows}
    root = plain_components(set(prints.values()))
    least = {}
    for d, t in rows:
        if d is not None:
            least[root[prints[t]]] = min(d, least.get(root[prints[t]], d))
    expected = Counter((d, prints[t], least.get(root[prints[t]])) for d, t in rows)
    assert Counter((r.doc_id, r.bits & (1 << 64) - 1, r.component_id) for r in got) == expected
    kept = simhash.one_of_each(table(spark, rows))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(least.values()))
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def test_one_of_each_keeps_by_component_where_ids_are_shared_or_missing(spark):
    rng = random.Random(9)
    a, b, c = (" ".join(f"w{rng.randint(0, 9999)}" for _ in range(40)) for _ in range(3))
    # b is the copy of a row with a smaller id but shares its own id with c, which is kept; a text without any id stays, a's copy does not
    rows = [(1, a), (None, a), (None, "alone"), (None, "alone"), (2, b), (5, b), (5, c)]
    kept = simhash.one_of_each(table(spark, rows))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, a), (None, "alone"), (2, b), (5, c)])


def test_crowded_fingerprints_are_linked_exactly(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 3)
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(150)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "bits long"))
    label = {r.node: r.component for r in components.components(edges).collect()}
    root = plain_components(prints)
    groups = defaultdict(set)
    for p in prints:
        own = p - (1 << 64) if p >> 63 else p
        groups[label.get(own, own)].add(root[p])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(root.values()))


# --- 4, 5 ----------------------------------------------------------------------


def plain_repeats(rows, length, words):
    seen, out = {}, []
    ordered = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for d, t in ordered:
        data = (t or "").encode()
        tokens = data.split() if words else data
        gone = set()
        for i in range(len(tokens) - length + 1):
            w = tuple(tokens[i : i + length])
            if w in seen:
                gone.update(range(i, i + length))
            seen[w] = 1
        kept = [x for i, x in enumerate(tokens) if i not in gone]
        runs = sum(i in gone and i - 1 not in gone for i in range(len(tokens)))
        out.append((d, len(tokens), len(gone), runs, b" ".join(kept) if words else bytes(kept)))
    return Counter(x for x, row in zip(out, ordered) for _ in range(rows.count(row)))


@pytest.mark.parametrize("crowd", [4096, 2])
@pytest.mark.parametrize("module, length, words", [(suffix_array, 24, False), (suffix_array, 100, False), (suffix_tree, 8, True), (suffix_tree, 20, True)])
def test_repeated_windows(spark, monkeypatch, module, length, words, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    monkeypatch.setattr(repeats, "FREQUENT", 0.2 if crowd == 2 else 2.0)
    rows = made(7) + [(500, "ab " * 200), (501, "ab " * 150)]
    got = module.remove_repeated_windows(table(spark, rows).repartition(3), length).collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == plain_repeats(rows, length, words)


def test_repeated_windows_of_nothing(spark):
    assert suffix_array.remove_repeated_windows(table(spark, [])).count() == 0


def test_leads_stay_whole_across_chunks(monkeypatch):
    monkeypatch.setattr(repeats, "HELD", 3)
    leads = [b"a"] * 4 + [b"b"] * 7 + [b"c"] * 2
    batches = [pa.RecordBatch.from_arrays([pa.array(leads[i : i + 2], pa.binary())], ["lead"]) for i in range(0, len(leads), 2)]
    chunks = [t.column(0).to_pylist() for t in repeats.whole_leads(iter(batches))]
    assert sum(chunks, []) == leads and all(not set(a) & set(b) for a, b in zip(chunks, chunks[1:]))


def test_window_minima():
    values = np.random.default_rng(8).integers(0, 50, 300).astype(np.uint64)
    for width in (1, 2, 6, 69):
        plain = {i + j for i in range(301 - width) for j in range(width) if values[i + j] == values[i : i + width].min()}
        assert window_minima(values, width).tolist() == sorted(plain)


# --- 6 -------------------------------------------------------------------------


def test_revisits(spark):
    fields = "record_id long, type string, url string, at long, headers map<string,string>, body string, key string"
    tag = lambda x: {"ETag": x}
    rows = [
        (1, "response", "http://www.A.com/x/", 10, {"ETag": "1", "Content-Type": "h", "Date": "old"}, "one", "k"),
        (2, "response", "https://a.com/x?utm_source=f", 20, tag("2"), "two", "k"),
        (3, "revisit", "https://a.com:443/x#top", 15, {"etag": "1", "date": "new", "content-type": "no"}, None, "k"),
        (4, "revisit", "http://a.com/x", 30, tag("1"), None, "k"),
        (5, "revisit", "http://a.com/x", 5, tag("1"), None, "k"),
        (6, "revisit", None, 30, tag("1"), None, "k"),
        (7, "revisit", "http://a.com/x", None, None, None, "k"),
        (8, "revisit", "http://a.com/x", 20, tag("2"), None, "k"),
        (8, "revisit", "http://a.com/x", 20, tag("2"), None, "k"),
        (9, "response", "http://b.com/?b=2&a=1&ref=z", 1, {"Last-Modified": "m"}, "bee", "k"),
        (10, "revisit", "//b.com?a=1&b=2", 2, {"last-modified": "m"}, None, "k"),
        (11, "revisit", "http://b.com/?a=1&b=2", 2, None, None, "k"),
    ]
    found = warc.resolve_revisits(spark.createDataFrame(rows, fields).repartition(3)).collect()
    got = sorted((r.record_id, r.refers_to, r.outcome, r.body) for r in found)
    assert got == [
        (3, 1, "resolved", "one"), (4, 2, "mismatch", None), (5, None, "unmatched", None), (6, None, "unmatched", None),
        (7, None, "unmatched", None), (8, 2, "resolved", "two"), (8, 2, "resolved", "two"), (10, 9, "resolved", "bee"), (11, 9, "mismatch", None),
    ]
    assert next(r.headers for r in found if r.record_id == 3) == {"etag": "1", "content-type": "h", "date": "new"}
    assert warc.resolve_revisits(spark.createDataFrame([], fields)).count() == 0


def test_as_of_join_of_one_hot_url(spark):
    rng = random.Random(9)
    rows = [("k", rng.randint(0, 300), i, rng.random() < 0.1) for i in range(2000)]
    got = {r.record_id: r.refers_to for r in warc.latest_response(spark.createDataFrame(rows, "key string, at long, record_id long, full boolean")).collect()}
    last = None
    for _, _, i, full in sorted(rows, key=lambda r: (r[1], r[2])):
        assert got[i] == last
        last = i if full else last


# --- 7 -------------------------------------------------------------------------


@pytest.mark.parametrize("block_words", [10**6, 30])
def test_contamination(spark, block_words):
    rows = made(10)
    rng = random.Random(10)
    items = [("i1", None), ("i2", " . "), ("i3", "é"), ("i4", "a b zz")]
    for k in range(8):
        words = re.findall(r"[a-zé]+", rng.choice([t for _, t in rows if t and len(t) > 150]))
        a = rng.randint(0, len(words) // 2)
        # some ids are null, and some items share theirs
        name = None if k in (2, 5) else f"j{k % 6}"
        items.append((name, "!".join(w.upper() if w.isascii() else w for w in words[a : a + rng.randint(3, 20)])))
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    expected = Counter()
    for d, t in rows:
        words, hit, names = cut(t), set(), set()
        for name, text in items:
            w = cut(text)
            n = min(len(w), 10)
            for gram in {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else ():
                for i in range(len(words) - n + 1):
                    if tuple(words[i : i + n]) == gram:
                        hit.update(range(i, i + n))
                        names.add(name)
        expected[d, len(words), len(hit), tuple(sorted(names, key=str))] += 1
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = winnowing.find_contamination(table(spark, rows), bench, block_words)
    got = found.select("doc_id", "n_words", winnowing.words_hit(F.col("spans")).alias("n"), "items").collect()
    assert Counter((r.doc_id, r.n_words, r.n, tuple(sorted(r["items"], key=str))) for r in got) == expected
    clean = winnowing.clean_documents(table(spark, rows), bench, block_words)
    assert clean.count() == sum(c for k, c in expected.items() if not k[2])
    assert winnowing.clean_documents(table(spark, rows), bench.limit(0)).count() == len(rows)


# --- 8 -------------------------------------------------------------------------


def test_line_counts():
    rng = random.Random(11)
    texts = ["", "\n", "\n\n a\n", "x\n\nx", "a b c d e a b c d e\n"] + ["".join(rng.choice("ab \n\t#é|") for _ in range(rng.randint(0, 80))) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts], pa.binary())], ["text"])
    got, places = [], []
    for block in blocks([batch], limit=3000):
        lines = line_quality.lines_of(block)
        got += list(zip(*(v.tolist() for v in lines.base.values())))
        places += [lines.place[a:b].tolist() for a, b in zip(lines.first, lines.first[1:])]
    for text, counts, place in zip(texts, got, places):
        words = SPACE.findall(text)
        grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        marked = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [(i, x) for i, x in enumerate(text.split("\n")) if SPACE.search(x)]
        repeated = len(lines) - len({x for _, x in lines})
        assert counts == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(marked))
        assert place == [i for i, _ in lines]


def test_viterbi_finds_the_best_path():
    from itertools import product

    rng = np.random.default_rng(12)
    field = line_quality.Field(rng.normal(size=(4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    first = np.concatenate([[0], np.cumsum(rng.integers(0, 7, 40))])
    features = rng.normal(size=(first[-1], 4))
    state = line_quality.viterbi(field, features, first)
    for a, b in zip(first, first[1:]):
        emit = features[a:b] @ field.weight
        score = lambda p: field.begin[p[0]] + sum(emit[i, s] for i, s in enumerate(p)) + sum(field.move[s, t] for s, t in zip(p, p[1:]))  # noqa: E731, B023
        if a < b:
            assert list(max(product((0, 1), repeat=int(b - a)), key=score)) == state[a:b].tolist()


def test_the_field_separates_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.xxhash64("doc_id") % 2 == 0
    field = line_quality.fit(docs.where(~held), labels)
    judged = line_quality.judge(docs.where(held), field).join(labels, "doc_id").where("not base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    good, bad = counts.get((1, True), 0), counts.get((0, False), 0)
    assert good >= 0.98 * (good + counts.get((1, False), 0)) and bad >= 0.8 * (bad + counts.get((0, True), 0))


def test_quality_of_awkward_documents(spark):
    rows = made(13)
    kept = line_quality.keep_good(table(spark, rows), None)
    judged = line_quality.judge(table(spark, rows), None).collect()
    assert len(judged) == len(rows) and kept.count() == sum(r.kept for r in judged)
    assert not any(r.kept for r in judged if r.doc_id in (3, 4, 5))
    assert line_quality.fit(table(spark, rows), spark.createDataFrame([], "doc_id long, quality int")) is None
    assert line_quality.judge(table(spark, []), None).count() == 0


# --- 9 -------------------------------------------------------------------------

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_encoding_is_that_of_the_library(spark):
    library, rng = Tokenizer.from_file(VOCABULARY), random.Random(14)
    letters = "aAbΣσς<|>'stÉé́İ\x1c\x85  \t\n12½Ⅷ中文한😀ﬁẞDžstartoftext՘Ᲊ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["<|endoftext|>hi<|startoftext|><|ENDOFTEXT|>", "x" * 500, "ab" * 3000, "It's we'LL", None, "", " \n"]
    got = {r.doc_id: r for r in bpe.encode(table(spark, list(enumerate(texts))), VOCABULARY).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(got[i].ids) == ids
        assert got[i].tokens == library.decode(ids, skip_special_tokens=False)


def test_small_and_long_trees_merge_alike():
    coder, rng = bpe.encoder(VOCABULARY), random.Random(15)
    for _ in range(300):
        word = bytes(rng.choice(b"theandingst") for _ in range(rng.randint(1, 32)))
        ids = [*coder.inner[list(word[:-1])].tolist(), int(coder.final[word[-1]])]
        assert coder.merge_words([word]) == [coder.merge_long(ids)]


def test_decoding_restores_words(spark):
    rows = [(1, "the cat sat naïvely"), (2, None), (None, "a <|endoftext|> b")]
    back = bpe.decode(bpe.encode(table(spark, rows), VOCABULARY), VOCABULARY)
    assert {r.doc_id: r.text for r in back.collect()} == {1: "the cat sat naïvely", 2: "", None: "a <|endoftext|> b"}
    assert bpe.encode(table(spark, []), VOCABULARY).count() == 0


# --- 10 ------------------------------------------------------------------------


def test_line_dedup(spark):
    line = "A line that is long enough to be counted, É!"
    rows = [(d, f"  {line}\t\nown {d}\n{line.replace('A line', 'a LINE')}") for d in range(1, 7)]
    rows += [(6, f"{line}\nother text, same id"), (None, f"{line}\nx"), (20, None), (21, ""), (22, "short\nshort"), (23, "z" * 50 + "\n")]
    rows += [(30, "y" * 45)] * 9  # repeated rows are one document
    got = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(table(spark, rows)).collect())
    cut = lambda d, t: (d, "\n".join(x for x in t.split("\n") if "line" not in x.lower()))
    expected = Counter((d, t) if t is None or d == 6 else cut(d, t) for d, t in rows)
    assert got == expected
    assert line_dedup.dedup_lines(table(spark, [])).count() == 0
    lines = [f"line {i} of a long text that others hold too, É" for i in range(2000)]
    long = [(d, "\n".join(f"own {d} {i}\n{x}" for i, x in enumerate(lines))) for d in range(5)]
    left = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(table(spark, long)).collect())
    assert left == Counter([*((d, "\n".join(f"own {d} {i}" for i in range(2000))) for d in range(4)), long[4]])
    plan = line_dedup.mark_repeated_lines(table(spark, rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
