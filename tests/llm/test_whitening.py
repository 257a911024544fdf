"""Whitening against exact sums and a covariance taken in one piece."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from realmwatch.llm import whitening
from realmwatch.llm.queries import QUERIES
from realmwatch.llm.whitening import fit_whitening, whiten, whitening_report

SF_DIR = "/root/testdata/sf0.001"


def plain(vectors, components=16):
    """n, and for every (id, vector) its deviation and whitened values up to their signs; eigenvalues; trace."""
    rows = [
        (i, [math.floor(64 * float(c)) + 1_000_000 for c in v])
        for i, v in vectors
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({tuple(x) for _, x in rows})
    n = len(fit)
    sums = [sum(column) for column in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)] for x in fit])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:components]
    values, directions = values[order], directions[:, order]
    out = []
    for i, x in rows:
        away = [n * a - s for a, s in zip(x, sums, strict=True)]
        out.append((i, sum(a * a for a in away), np.array(away) / n @ directions / np.sqrt(values)))
    return n, out, values, np.trace(centred.T @ centred / n)


def agree(frame, vectors, components=16):
    n, expected, values, trace = plain(vectors, components)
    got = {}
    rows = frame.collect()
    for r in rows:
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    kept = min(components, len(values))
    assert len(rows) == len(expected) * kept
    whitened = np.array([[got[i][c + 1][0].whitened for c in range(kept)] for i, _, _ in expected])
    plainly = np.array([w for _, _, w in expected])
    signs = np.sign((whitened * plainly).sum(0))
    np.testing.assert_allclose(whitened, plainly * signs, rtol=1e-6, atol=1e-7)
    for i, deviation, _ in expected:
        for c, same in got[i].items():
            assert {r.deviation for r in same} == {deviation} and {r.n for r in same} == {n}
            assert same[0].explained == pytest.approx(values[c - 1] / trace, rel=1e-6)
            assert same[0].identity_error < 1e-8
            assert len({r.whitened for r in same}) == 1
    return got


def test_query_equals_the_plain_version(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    agree(QUERIES["op11_embedding_whitening"](spark, SF_DIR), [tuple(r) for r in vectors])


def test_many_blocks_of_rows_and_columns(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(203, 7)) * [5, 4, 3, 2, 1, 1, 0.5])]
    vectors += [(1000 + i, vectors[0][1]) for i in range(150)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5)
    monkeypatch.setattr(whitening, "_BLOCK_BYTES", 8 * 7 * 10)
    monkeypatch.setattr(whitening, "_BLOCK_COLUMNS", 3)
    monkeypatch.setattr(whitening, "_BLOCKS_A_TASK", 4)
    agree(whitening_report(frame), vectors)
    # whitened with their signs, over the fit list: mean 0 and unit covariance
    model = fit_whitening(frame)
    got = whiten(frame.where("vec_id < 203"), model).groupBy("vec_id").pivot("component").agg(F.first("whitened"))
    z = np.array([tuple(r)[1:] for r in got.collect()])
    np.testing.assert_allclose(z.T @ z / 203, np.eye(7), atol=1e-9)
    np.testing.assert_allclose(z.mean(0), 0, atol=1e-9)


def test_odd_rows(spark):
    odd = [
        (1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (None, [2.0, 1.0, 0.5]), (3, None), (4, []), (5, [1.0, None, 2.0]),
        (6, [1.0, float("nan"), 2.0]), (7, [float("inf"), 1.0, 1.0]), (8, [1.0, 2.0]), (9, [0.0, 0.0, 0.0]),
        (10, [-1.0, 4.0, 0.25]), (11, [5.0, 4.0, 0.25]),
    ]
    frame = spark.createDataFrame(odd, "vec_id long, embedding array<double>")
    for name in ("id", "x", "v", "row", "task", "m", "ids", "component", "n", "values", "count"):
        frame = frame.withColumn(name, F.lit("clash"))
    kept = [r for r in odd if r[1] and len(r[1]) == 3 and all(c is not None and math.isfinite(c) for c in r[1])]
    got = agree(whitening_report(frame), kept)
    assert {i: len(c[1]) for i, c in got.items()} == {1: 2, None: 1, 9: 1, 10: 1, 11: 1}
    assert whitening_report(frame.where("false")).count() == 0
    assert whitening_report(frame.where("vec_id in (3, 4)")).columns == whitening_report(frame).columns


def test_directions_without_variance_keep_their_place(spark):
    rows = [(i, [float(i % 4), 2.0, float(-(i % 4))]) for i in range(20)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening_report(frame).collect()
    assert len(got) == 60 and all(r.n == 4 and r.identity_error < 1e-9 for r in got)
    assert {r.component for r in got if r.whitened is None} == {2, 3}
    single = whitening_report(frame.where("vec_id % 4 = 1")).collect()
    assert len(single) == 15 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in single)


def test_large_entries_and_long_vectors(spark):
    rng = np.random.default_rng(8)
    long = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 1500)))]
    frame = spark.createDataFrame(long, "vec_id long, embedding array<double>")
    rows = whitening_report(frame, components=4).collect()
    assert len(rows) == 160 and max(r.identity_error for r in rows) < 1e-6
    big = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])]
    rows = whitening_report(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()
    assert len(rows) == 6 and {r.deviation is None for r in rows if r.vec_id == 1} == {True}
