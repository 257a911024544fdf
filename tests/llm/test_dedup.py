"""Near-duplicates, repeated strings and embeddings against plain versions."""

import hashlib
import random

import brute
import numpy as np
import pytest
from compare import duck
from frames import frame, odd_rows  # noqa: F401

from realmwatch.llm import suffix_dedup
from realmwatch.llm.components import connected_components
from realmwatch.llm.embedding_dedup import collision, link_embeddings, plan
from realmwatch.llm.minhash_dedup import _bands, drop_near_duplicates, near_duplicates, shingles, signatures, text_key
from realmwatch.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    random.seed(seed)
    edges = [(random.randrange(80), random.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 140)]
    edges += [(200, i) for i in range(201, 240)]
    sets = brute.Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: sets.root(x) for a, b in edges if a != b for x in (a, b)}
    none = spark.createDataFrame([], "u long, v long")
    assert connected_components(none).count() == 0


def test_registers_agree_as_often_as_texts_are_similar():
    random.seed(1)
    shared, own = [f"s{i}" for i in range(300)], [f"o{i}" for i in range(100)]
    left, right = shingles(" ".join(shared)), shingles(" ".join(shared + own))
    a, b = signatures([(left, np.ones(len(left))), (right, np.ones(len(right)))], 4000)
    assert abs((a == b).mean() - len(left) / len(right)) < 0.03


def test_near_duplicates_query(spark):
    got = {r.doc_id: (r.class_id, r.kept) for r in QUERIES["op1_minhash_dedup"](spark, SF_DIR).collect()}
    want = brute.near_classes(documents(spark))
    assert got == {i: (c, c == i) for i, c in want.items()}


def test_passages_repeated_unequally_are_found():
    """Equal sets of shingles share their buckets, however often each shingle occurs."""
    apart = []
    for i in range(30):
        passage, rest = [f"p{i}_{j}" for j in range(15)], [f"r{i}_{j}" for j in range(21)]
        few, many = (" ".join(passage * n + rest) for n in (2, 300))
        assert set(shingles(few)) == set(shingles(many)) and few != many
        left, right = _bands([few, many], 24, 5)
        if not set(left) & set(right):
            apart.append(i)
    assert apart == []


def family(seed):
    """A base with light and heavy edits, copies of copies, exact copies and strangers."""
    random.seed(seed)
    base = [f"b{i}" for i in range(120)]
    rows, texts = [], [base]
    for i in range(60):
        text = list(random.choice(texts if i % 3 else [base]))
        for _ in range(random.choice([0, 1, 2, 3, 5, 8])):
            text[random.randrange(len(text))] = f"e{seed}_{i}_{random.random()}"
        texts.append(text)
        rows.append((i, " ".join(text)))
    return rows + [(60 + i, f"short {i % 2}") for i in range(4)] + [(70, ""), (71, None), (72, "  "), (73, "!!")]


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates_lose_no_link(spark, frame, seed):
    rows = family(seed)
    got = {r.doc_id: r.class_id for r in near_duplicates(frame([(i, t, "s") for i, t in rows])).collect()}
    assert got == brute.near_classes(rows)


def test_dropping_near_duplicates_keeps_one_whole_row(frame, odd_rows):
    docs = frame(odd_rows)
    rows = drop_near_duplicates(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "3", "4", "5", "7", "None"]
    assert rows[0].asDict().keys() == set(docs.columns)
    assert drop_near_duplicates(frame([])).count() == 0
    assert near_duplicates(frame([])).count() == 0
    classes = near_duplicates(docs).collect()
    assert len(classes) == len(odd_rows) and {r.class_id for r in classes if r.doc_id in (1, 2)} == {1}


@pytest.mark.parametrize("seed", range(60))
def test_deep_shallow_order(seed):
    random.seed(seed)
    letters = b"ab" if seed % 2 else b"abcdef"
    base = bytes(random.choice(letters) for _ in range(60))
    texts = [base[: random.randrange(61)] + bytes(random.choice(letters) for _ in range(3)) for _ in range(30)]
    order, shared = suffix_dedup.deep_shallow(texts, shallow=random.choice([0, 2, 24]))
    assert [texts[i] for i in order] == sorted(texts) and sorted(order) == list(range(30))
    for i in range(1, 30):
        assert shared[i] == suffix_dedup.common_prefix(texts[order[i - 1]], texts[order[i]])


@pytest.mark.parametrize("seed", range(60))
def test_repeated_offsets_find_every_repeat(seed):
    random.seed(seed)
    length, gram = 20, 6
    letters = b"ab" if seed % 3 == 0 else b"abcdefgh"
    parts = [bytes(random.choice(letters) for _ in range(random.randrange(5, 60))) for _ in range(4)]
    texts = [
        b"".join(random.choice(parts)[random.randrange(5) :] for _ in range(random.randrange(5)))
        + bytes(random.choice(letters) for _ in range(9))
        for _ in range(random.choice([3, 45]))
    ]
    groups = {}
    for i, x in enumerate(texts):
        for h, *where in zip(*(y.tolist() for y in suffix_dedup.anchors(x, length, gram, stretch=64)), strict=True):
            groups.setdefault(h, []).append((i, *where))
    found = [set() for _ in texts]
    for group in groups.values():
        cut = [(texts[i][a : b + length], p - a, p - b, p - a) for i, p, a, b in group]
        if len(group) > 1:
            for (i, p, *_), ranges in zip(group, suffix_dedup.repeated_offsets(cut, length, gram), strict=True):
                for a, b in ranges:
                    found[i] |= set(range(p - b, p - a + 1))
    seen = [x[s : s + length] for x in texts for s in range(len(x) - length + 1)]
    want = [{s for s in range(len(x) - length + 1) if seen.count(x[s : s + length]) > 1} for x in texts]
    assert found == want


def check_removal(rows, texts, report):
    data, marks = brute.without_repeats(texts)
    want = []
    for (i, *_), d, m in zip(rows, data, marks, strict=True):
        kept = bytes(b for b, gone in zip(d, m, strict=True) if not gone)
        runs = sum(1 for s in range(len(m)) if m[s] and (s == 0 or not m[s - 1]))
        want.append((str(i), len(d), sum(m), runs, hashlib.sha256(kept).hexdigest()))
    got = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in report]
    assert sorted(got) == sorted(want)


def test_repeats_query(spark):
    rows = documents(spark)
    check_removal(rows, [t for _, t in rows], QUERIES["op6_suffix_dedup"](spark, SF_DIR).collect())


def passages(seed):
    random.seed(seed)
    def words(n):
        return " ".join("".join(random.choice("abcdeé") for _ in range(5)) for _ in range(n))
    shared = [words(60), words(50), "Ha " * 150]
    rows = []
    for i in range(25):
        text = words(20) + random.choice(shared)[random.randrange(30) :] + words(10) + (shared[0] if i % 2 else "")
        rows.append((i, text, "s"))
    return rows + [(90, "x" * 700, "s"), (91, "y" * 200, "s"), (92, "z" * 201, "s"), rows[3], (93, rows[4][1], "s")]


@pytest.mark.parametrize("most", [2000, 3])
def test_repeats_of_passages(frame, odd_rows, most, monkeypatch):
    rows = passages(most) + odd_rows
    spans = suffix_dedup.repeated_spans
    monkeypatch.setattr(suffix_dedup, "repeated_spans", lambda docs, text: spans(docs, text, most=most))
    check_removal(rows, [t for _, t, _ in rows], suffix_dedup.repeat_report(frame(rows)).collect())


@pytest.mark.parametrize("copies, most", [(5000, 2000), (600, 20)])
def test_many_near_copies_make_a_few_rows_each(frame, copies, most, monkeypatch):
    """Of a large group of near copies no string by string list is made, whatever one task sorts at once."""
    random.seed(copies)
    base = bytes(random.choice(b"abcdefgh ") for _ in range(600))
    texts = []
    for i in range(copies):
        text = bytearray(base)
        for at in random.sample(range(600), 1 + i % 3):
            text[at] = random.choice(b"stuvwxyz")
        texts.append(bytes(text).decode())
    counts, kept = {}, suffix_dedup.stored

    def stored(df, name):
        made = kept(df, name)
        counts[name] = made.where("kind <> 0").count() if name == "met" else made.count()
        return made

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    spans = suffix_dedup.repeated_spans(frame([(i, t, "s") for i, t in enumerate(texts)]), "text", most=most)
    got = {bytes(r.k): sorted(i for a, b in map(tuple, r.spans) for i in range(a, b)) for r in spans.collect()}
    got = {k: sorted(set(v)) for k, v in got.items()}
    seen = {}
    for t in texts:
        for s in range(401):
            name = hash(t[s : s + 200])
            seen[name] = seen.get(name, 0) + 1
    keys = dict(frame([(i, t, "s") for i, t in enumerate(texts)]).select("text", text_key("text")).collect())
    for t in texts:
        want = {i for s in range(401) if seen[hash(t[s : s + 200])] > 1 for i in range(s, s + 200)}
        assert got.get(bytes(keys[t]), []) == sorted(want)
    assert counts["met"] > copies and counts["sorted"] < 10 * counts["met"]


def test_removing_repeats_keeps_rows_and_whole_characters(frame, odd_rows):
    rows = passages(1) + odd_rows
    docs = frame(rows)
    got = suffix_dedup.remove_repeats(docs).collect()
    data, marks = brute.without_repeats([t for _, t, _ in rows])
    assert len(got) == len(rows) and got[0].asDict().keys() == set(docs.columns)
    want = []
    for (i, text, _), d, m in zip(rows, data, marks, strict=True):
        kept = bytes(b for b, gone in zip(d, m, strict=True) if not gone)
        want.append((str(i), None if text is None else len(kept)))
    for (_, size), r in zip(sorted(want, key=str), sorted(got, key=lambda r: str((str(r.doc_id), None))), strict=False):
        assert r.text is None or size is None or "�" not in r.text
    assert suffix_dedup.remove_repeats(frame([])).count() == 0


def linked(rows, least=0.9):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    good = [(i, v / np.abs(v).max()) for i, v in good if np.isfinite(v).all() and v.any()]
    sets = brute.Sets({i for i, _ in good})
    links = [0] * len(good)
    for a in range(len(good)):
        for b in range(a):
            x, y = good[a][1], good[b][1]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[a] += 1
                links[b] += 1
                sets.join(good[a][0], good[b][0])
    return [(i, links[k], sets.root(i), sets.root(i) == i) for k, (i, _) in enumerate(good)]


@pytest.mark.parametrize("block", [4096, 5])
def test_embeddings_against_all_pairs(spark, block):
    random = np.random.default_rng(block)
    centres = random.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] + 0.12 * random.standard_normal(16)).tolist()) for i in range(150)]
    chain = [[float(np.cos(a)), float(np.sin(a)), 0.0] for a in np.arange(0, 3, 0.3)]  # each near its neighbours only
    rows += [(200 + i, v) for i, v in enumerate(chain)] + [(300 + i, rows[0][1]) for i in range(7)]
    rows += [(320, [2 * x for x in rows[0][1]]), (321, [1e300] * 16), (322, [1e-300] * 16)]
    odd = [(400, None), (401, []), (402, [0.0] * 16), (403, [None] * 16), (404, [float("nan")] * 16)]
    odd += [(405, [float("inf")] * 16), (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in link_embeddings(df, block=block, miss=1e-9).collect()]
    want = linked(rows) + [(i, 0, i, i is not None) for i, _ in odd]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_embeddings_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    want = linked(rows)
    got = [tuple(r) for r in QUERIES["op10_embedding_dedup"](spark, SF_DIR).collect()]
    assert sorted(got) == sorted(want)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert link_embeddings(none).count() == 0


def test_tables_follow_the_rows():
    assert plan(10**3, 0.9, 0.001) < plan(10**6, 0.9, 0.001) < plan(10**9, 0.9, 0.001)
    assert collision(0.1) > collision(0.4) > collision(1.4) > 0


@pytest.mark.parametrize("name", ["op1_minhash_dedup", "op6_suffix_dedup", "op10_embedding_dedup"])
def test_query_matches_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    relation = duck(sf_dir).sql(ORACLES[name])
    rows = QUERIES[name](spark, sf_dir).select(*relation.columns).collect()
    assert sorted(map(tuple, rows)) == sorted(relation.fetchall())


def test_weighted_bands_follow_the_probability_jaccard():
    """Registers of weighted sets agree as often as the probability Jaccard of their rates says."""
    draw = np.random.default_rng(4)
    element = draw.integers(1, 2**60, 60).astype(np.uint64)
    left, right = 1 + np.log(draw.integers(1, 50, 50)), 1 + np.log(draw.integers(1, 50, 50))
    sets = [(element[:50], left), (element[10:], right)]
    one, two = signatures(sets, 8192)
    want = sum(
        1 / sum(max(left[k] / left[x] if k < 50 else 0, right[k - 10] / right[x - 10] if k >= 10 else 0) for k in range(60))
        for x in range(10, 50)
    )
    assert abs((one == two).mean() - want) < 0.02


def test_repetition_changes_weighted_bands_only():
    words = [f"w{i}" for i in range(40)]
    once, often = " ".join(words), " ".join(words + words[:5] * 300)
    a, b = _bands([once, often], 24, 5, 64)
    assert len(a) == len(b) == 88
    near = [x == y for x, y in zip(a, b, strict=True)]
    assert sum(near[:24]) / 24 > sum(near[24:]) / 64
    c, d = _bands([once, once], 24, 5, 6)
    assert c == d and len(set(c)) == 30
