"""Periodic runs against a search of all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from frames import frame, odd_rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from realmwatch.llm.periodic_runs import (
    Run,
    collapsed,
    detect_runs,
    find_runs,
    run_digest,
    run_report,
    strongest,
    with_planted_runs,
)
from realmwatch.llm.queries import QUERIES
from realmwatch.llm.suffix_tree import SuffixTree



def plain_runs(w, least_words=24, least_exponent=3):
    found = []
    for q in range(1, len(w) // least_exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            part = w[i : i + size]
            smaller = any(all(part[k] == part[k + p] for k in range(size - p)) for p in range(1, q))
            if size >= max(least_words, least_exponent * q) and not smaller:
                found.append(Run(i, size, q))
            i = j
    return sorted(found, key=lambda r: (r.start, r.period))


def plain_report(doc_id, text):
    """The contract's row, word by word."""
    w = (text or "").encode().split()
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = plain_runs(w)
    dropped = {i for r in runs for i in range(r.start + r.period, r.start + r.length)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in dropped)
    best = min(runs, key=lambda r: (-r.length / r.period, r.start, r.period), default=None)
    named = (best.start, best.length, best.period, 1000 * best.length // best.period) if best else (None,) * 4
    return (doc_id, len(runs), *named, run_digest(runs), hashlib.sha256(kept).hexdigest())


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(1, 9), st.integers(0, 60))
def test_runs_equal_search_of_all_periods(numbers, period, tail):
    w = [b"w%d" % x for x in numbers]
    w += [w[k % period] if w[k % period :] and len(w) > period else b"z%d" % (k % period) for k in range(tail)]
    for least_words, least_exponent in ((24, 3), (2, 2), (6, 3), (10, 2)):
        assert find_runs(w, least_words, least_exponent) == plain_runs(w, least_words, least_exponent)


def test_nested_runs_and_collapse():
    inner = [b"a", b"b"] * 12
    w = [b"x", *(inner + [b"c"]) * 4, b"y"]
    runs = find_runs(w)
    assert runs == plain_runs(w) and len(runs) == 5
    assert strongest(runs) == Run(1, 24, 2)
    kept = collapsed(w, runs)
    dropped = {i for r in runs for i in range(r.start + r.period, r.start + r.length)}
    assert kept == [x for i, x in enumerate(w) if i not in dropped]


def test_extensions_of_the_tree_equal_plain_comparison():
    rng = random.Random(3)
    for top in (1, 2, 4):
        text = [rng.randint(1, top) for _ in range(80)]
        tree = SuffixTree(text, top)
        pairs = [(i, j) for i in range(80) for j in range(80) if i != j]
        plain = []
        for i, j in pairs:
            k = 0
            while max(i, j) + k < 80 and text[i + k] == text[j + k]:
                k += 1
            plain.append(k)
        i, j = np.array(pairs).T
        assert tree.common(i, j).tolist() == plain
        assert np.argsort(tree.rank).tolist() == sorted(range(81), key=lambda k: text[k:] + [0])
        assert np.argsort(tree.reverse_rank()).tolist() == sorted(range(81), key=lambda k: [-x for x in text[k:]] + [-9])


def test_rows_of_the_query_equal_the_plain_version(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    short = docs.where("length(text) < 6000").select("doc_id", "text").collect()
    assert len(got) == docs.count()
    planted = 0
    for row in short:
        assert got[row.doc_id] == plain_report(row.doc_id, row.text)
        planted += got[row.doc_id][1] > 0
    assert planted > 5


def test_odd_rows(spark, frame, odd_rows):  # noqa: F811
    odd = [*odd_rows, (11, "\t a \x0b b \n" * 30, "c"), (12, "ha " * 100, None), (12, "ha " * 100, None)]
    docs = frame(odd)
    got = run_report(detect_runs(with_planted_runs(docs), ["doc_id"])).select(*NAMES).collect()
    expected = [plain_report(i, t) for i, t, _ in odd if len(t or "") < 9000]
    rows = [tuple(r) for r in got]
    assert len(rows) == len(odd)
    for row in expected:
        assert rows.count(row) == expected.count(row)
    assert detect_runs(docs, ["doc_id", "k"]).columns == ["doc_id", "k", "n_words", "runs", "collapsed"]
    assert run_report(detect_runs(with_planted_runs(frame([])), ["doc_id"])).count() == 0


def test_a_word_repeated_all_through_a_long_text(spark, frame):  # noqa: F811
    (row,) = detect_runs(frame([(1, "na " * 150_000, "a")]), ["doc_id"]).collect()
    assert [tuple(r) for r in row.runs] == [(0, 150_000, 1)] and row.collapsed == "na"


@pytest.mark.parametrize("words, exponent", [(1, 3), (24, 1)])
def test_bounds_without_a_meaning_are_refused(words, exponent):
    with pytest.raises(ValueError):
        find_runs([b"a"] * 30, words, exponent)
