"""Filter audit, personal data and centroid clusters against brute force, with the awkward cases."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fraudlens.llm import centroids, filter_audit, pii, queries
from fraudlens.llm.blocks import blocks

DOCS = "doc_id long, text string, lang string, source string, part string, bits int, first string, base string"


def table(spark, rows, lang="en"):
    rows = [(*r, lang) if len(r) == 2 else r for r in rows]
    return spark.createDataFrame([(d, t, g, "s", "x", 1, "y", "z") for d, t, g in rows], DOCS)


# --- 11 ----------------------------------------------------------------------------


def failing(rows):
    """The filters each row fails, by the contract's words."""
    out = []
    for d, t, _ in rows:
        text = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if d is not None and any(e is not None and e < d and (u or "") == text for e, u, _ in rows):
            fails.add("E")
        out.append(fails)
    return out


def audit_by_hand(rows, labels):
    fails = failing(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {g or "" for _, _, g in rows}:
        mine = [(d, f) for (d, _, g), f in zip(rows, fails) if (g or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                removed = [d for d, f in left if name in f]
                total[name] += len(removed)
                failed = sum(name in f for _, f in mine)
                left = [(d, f) for d, f in left if name not in f]
                out[part, "".join(order), step] = [
                    len(left), len(removed), failed - len(removed), sum(f == {name} for _, f in mine),
                    sum(d in good for d in removed), sum(d in toxic for d in removed), name,
                ]
        for key in [k for k in out if k[0] == part]:
            out[key][-1] = total[out[key][-1]]
    return out


def awkward_rows(seed):
    rng = random.Random(seed)
    many = " ".join(f"w{i}" for i in range(120))
    few = "same words " * 80
    texts = [None, "", " \t", "ABC DEF", "a#b", many, many.upper(), few, many + " $", few.upper() + "|", "é" * 30 + "Ab", "\x0b".join("xyz" for _ in range(101))]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(80)]
    return rows + [(None, many, "en"), (None, many, "en"), (3, many, "fr"), (3, many, "fr"), (200, "long " * 30_000, "fr")]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_matches_filtering_by_hand(spark, seed):
    rows = awkward_rows(seed)
    rng = random.Random(seed)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 100, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (9999, 1, 1)]
    counts = filter_audit.failure_counts(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in filter_audit.audit(counts).collect()}
    assert got == audit_by_hand(rows, labels)


def test_audit_of_other_filters_and_empty_tables(spark):
    counts = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 0, 2)], "part string, cell int, n long, good long, toxic long")
    rows = {(r.filter_order, r.step): r for r in filter_audit.audit(counts, "XY").collect()}
    assert len(rows) == 4 and rows["XY", 1].removed == 2 and rows["XY", 2].redundant == 2 and rows["YX", 1].shapley == 2
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.failure_counts(table(spark, []), labels)).count() == 0
    parts = spark.createDataFrame([(f"p{i}", i % 4, i + 1, 0, 1) for i in range(700)], counts.schema)
    got = filter_audit.audit(parts, "XY").where("step = 2 and filter_order = 'XY'").collect()
    assert len(got) == 700 and all(r.kept == (r.part[1:].isdigit() and int(r.part[1:]) % 4 == 0) * (int(r.part[1:]) + 1) for r in got)


# --- 12 ----------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_by_hand(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def spans_of(texts, field=None):
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts], pa.binary())], ["text"])
    out = []
    for block in blocks([batch]):
        t, _, every = pii._all_spans(block, field)
        out += pii._listed(t, every, len(block.offsets) - 1)[0].to_pylist()
    return [[f"{s['kind']}:{s['start']}:{s['end']}" for s in row] for row in out]


@pytest.mark.parametrize("alphabet", ["0123456789 -.", "01@.a-+ é", "+0123 ().-a", "12.", "a@.-b%", "4 -1", "0123456789.@+ -aé\n#("])
def test_base_spans_equal_the_patterns(alphabet):
    rng = random.Random(alphabet)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 30, 120]))) for _ in range(400)]
    assert spans_of(texts) == [base_by_hand(t) for t in texts]


@pytest.mark.parametrize("unit", ["a", "1", ".", "@", "+", "1.", "a@", "+1", "1 ", "é"])
def test_long_runs_take_linear_time(unit):
    text = unit * (2_000_000 // len(unit))
    assert len(spans_of([text])[0]) == (len(text) // 8 if unit == "1." else 0)


def people(n, seed=3):
    """Texts with entities between words, as the field's training finds them in a corpus."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card():
        body = "4" + digits(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    makers = [
        card, lambda: f"+1 ({digits(3)}) 555-{digits(4)}", lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
        lambda: f"u{digits(2)}@mail.example.com", lambda: digits(4), lambda: f"{digits(2)}:{digits(2)}", lambda: digits(16),
    ]
    rows = []
    for i in range(n):
        words = [rng.choice(["the", "of", "order", "ref", "and", "né"]) for _ in range(40)]
        for _ in range(3):
            thing = rng.choice(makers)()
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), thing)
        rows.append((i, " ".join(words)))
    return rows, card


@pytest.fixture(scope="module")
def trained(spark):
    rows, card = people(500)
    field = pii.fit(table(spark, rows))
    assert field is not None and np.isfinite(field.weight).all()
    return field, rows, card


def test_field_adds_repeats_and_nothing_else(spark, trained):
    field, rows, card = trained
    number = card()
    phone = "+1 (743) 555-3824"
    far = "word " * 500
    again = f"call {phone} {far} or 743-555-3824 please"
    at = again.index("743-555")
    cases = {
        f"pay {number} {number} now": ["card:4:20", "card:21:37"],  # glued: the pattern sees 32 digits
        again: [f"phone:5:{5 + len(phone)}", f"phone:{at}:{at + 12}"],
        "call 743-55-38 or 2024-01-05 or 12:30 of 4381893757741600": [],
        f"{far} 1234567890123456 and 999.1.1.1 and v1.2.3": [],
        "nothing here": [], "": [],
    }
    got = spans_of(list(cases), field)
    assert got == list(cases.values())
    found = pii.find(table(spark, [*rows, (None, None), (7, rows[7][1])]), field).collect()
    assert len(found) == len(rows) + 2
    text = dict(rows)
    for r in found:
        base = [f"{s.kind}:{s.start}:{s.end}" for s in r.base]
        assert base == base_by_hand(text.get(r.doc_id)) and set(r.base) <= set(r.spans)
        for s in set(r.spans) - set(r.base):
            digits = re.sub("[^0-9]", "", text[r.doc_id][s.start : s.end])
            assert s.kind in ("card", "phone") and (s.kind != "card" or luhn(digits))


def test_messages_pass_along_skip_links_exactly_on_a_tree(trained):
    """On a graph without loops belief propagation gives the exact marginals."""
    rng = np.random.default_rng(2)
    k, f = pii.STATES, pii.FEATURES
    skip = rng.normal(size=(len(pii.LINKS), k, k))
    field = pii.Field(rng.normal(size=(f, k)), rng.normal(size=(k, k)), skip + skip.transpose(0, 2, 1))
    features = (rng.random((4, f)) < 0.3).astype(np.float32)
    links = [np.array([[0, 2]]), np.zeros((0, 2), int), np.array([[2, 3]])]
    g = pii.Graph(np.zeros(4, int), np.arange(4), np.arange(4), features, np.array([False, True, False, False]), links, np.zeros(4, np.int8), np.ones(4, bool))
    local = features @ field.weight
    weight = np.zeros((k, k, k, k))
    for y in np.ndindex(k, k, k, k):
        weight[y] = np.exp(sum(local[i, y[i]] for i in range(4)) + field.chain[y[0], y[1]] + field.skip[0][y[0], y[2]] + field.skip[2][y[2], y[3]])
    weight /= weight.sum()
    exact = np.stack([weight.sum(tuple(j for j in range(4) if j != i)) for i in range(4)])
    saved, pii.ROUNDS = pii.ROUNDS, 60
    try:
        assert np.allclose(pii.beliefs(field, g), exact, atol=1e-4)
    finally:
        pii.ROUNDS = saved


def test_training_slopes_fit_the_labels(trained):
    """Held-out words of known entities are labelled like their patterns, from their look and neighbours alone."""
    field, _, _ = trained
    texts = [t for _, t in people(200, seed=11)[0]]
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts], pa.binary())], ["text"])
    right = total = 0
    for block in blocks([batch]):
        g = pii._labelled(block)[2]
        hidden = g._replace(state=np.zeros_like(g.state))
        guess = pii.beliefs(field, hidden).argmax(1)
        right, total = right + (guess == g.state)[g.trusted].sum(), total + g.trusted.sum()
    assert right / total > 0.95


def test_redaction_and_empty_tables(spark, trained):
    field, _, card = trained
    number = card()
    docs = table(spark, [(1, f"é {number} {number}, a.b@c.de!"), (2, None), (3, "plain")])
    rows = {r.doc_id: r for r in pii.redact(docs, field).collect()}
    assert rows[1].text == "é [card] [card], [email]!" and rows[2].text is None and rows[3].text == "plain" and rows[1].base == "z"
    empty = table(spark, [])
    assert pii.fit(empty) is None and pii.find(empty, None).count() == 0
    assert pii.fit(table(spark, [(1, "no entity 12 here")])) is None


def test_query_of_personal_data_against_the_patterns(spark):
    small = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_personal_data"](spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        base = base_by_hand(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in base) for k in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) or not base


# --- 13 ----------------------------------------------------------------------------


def test_bounds_hold_and_keep_the_nearest():
    rng = np.random.default_rng(1)
    opened = 0
    for case in range(150):
        d, n, k = int(rng.integers(1, 70)), int(rng.integers(1, 400)), int(rng.integers(1, 20))
        v = rng.integers(-20, 20, (n, d)) * int(rng.choice([1, 1, 1000, 2**21]))
        if case % 4 == 0:
            v[:, d // 2 :] = 0
        if case % 7 == 0:
            v[:] = v[0]
        points = v[rng.integers(0, n, k)]
        shape = centroids.simplex(points)
        moved = points + rng.integers(-3, 4, points.shape)
        full = centroids.squared(v, moved)
        tops = np.zeros((n, 1))
        if shape is not None:
            tops = centroids.apex(shape, centroids.squared(v, shape.pivots))
            lower, upper = centroids.bounds(shape, tops, centroids.apex(shape, centroids.squared(moved, shape.pivots)))
            assert (lower <= full).all() and (full <= upper).all()
            opened += (lower <= upper.min(1, keepdims=True)).mean()
        number, distance = centroids.nearest(shape, v, tops, moved)
        assert (number == full.argmin(1)).all() and (distance == full.min(1)).all()
    assert opened < 150


def cluster_by_hand(rows):
    kept = [(i, [int(np.floor(64 * np.float64(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:16]
    centre = [v for _, v in starts]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((gap(v, c), j) for j, c in enumerate(centre))
    for _ in range(3):
        mine = [near(v)[1] for _, v in kept]
        for j in range(len(centre)):
            members = [v for (_, v), m in zip(kept, mine) if m == j]
            if members:
                centre[j] = [sum(x) // len(members) for x in zip(*members)]
    final = [(i, *near(v)) for i, v in kept]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return sorted(((i, j, d, sum(e for _, e, m in final if m == j), sum(e for _, e, _ in final), digest[j]) for i, d, j in final), key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, apex string, v string"


def vectors(spark, tmp_path, rows):
    data = spark.createDataFrame([(i, v, 0, "c", "a", "v") for i, v in rows], SCHEMA)
    path = str(tmp_path / f"t{len(rows)}")
    data.write.parquet(f"{path}/embeddings.parquet")
    return path


def test_clusters_match_brute_force(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.3, 64).astype(np.float32).tolist()) for i in range(120)]
    rows += [(i, rows[5][1]) for i in range(200, 260)] + [(7, rows[7][1]), (None, rows[9][1])]
    rows += [(300, None), (301, [0.1] * 63), (302, [0.1] * 63 + [None]), (303, [float("nan")] * 64), (304, [float("inf")] * 64), (305, []), (306, [0.0] * 64)]
    got = queries.QUERIES["op13_centroid_clusters"](spark, vectors(spark, tmp_path, rows)).collect()
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == cluster_by_hand(rows)


@pytest.mark.parametrize("rows", [[], [(1, [0.5] * 64)], [(i, [0.25] * 64) for i in range(40)], [(None, [0.5] * 64)]])
def test_clusters_of_few_or_equal_vectors(spark, tmp_path, rows):
    got = queries.QUERIES["op13_centroid_clusters"](spark, vectors(spark, tmp_path, rows)).collect()
    assert len(got) == sum(i is not None for i, _ in rows)
    assert all(r.cluster == 0 and r.distance == 0 and r.inertia == 0 for r in got)


def test_too_large_components_are_left_out(spark):
    data = spark.createDataFrame([(1, [float(2**20)] * 64), (2, [float(2**20) - 1] * 64)], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in centroids.whole_numbers(data).collect()] == [2]


def test_awkward_columns_survive(spark):
    docs = table(spark, [(1, "x 4111111111111111")])
    assert pii.find(docs, None).select(F.size("base")).first()[0] == 1
