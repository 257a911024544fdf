"""Toxicity, language model, mixing and the pipeline."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from frames import frame, odd_rows  # noqa: F401

import __spark_entry__ as entry_point
from realmwatch.llm import pitman_yor
from realmwatch.llm.mixing import mix_documents, mix_report, period, phases
from realmwatch.llm.queries import MIX_OTHER, MIX_WEIGHTS, QUERIES
from realmwatch.llm.toxicity import fit_toxicity, score_texts, score_toxicity, train

SF_DIR = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


def held(i, folds=5, rest=0):
    return zlib.crc32(str("" if i is None else i).encode()) % folds == rest


def test_toxicity_of_held_out_rows(spark):
    rows = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, SF_DIR).collect()}
    assert all(r.held_out == held(i) and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    labels = [r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect() if held(r.doc_id)]
    right = [rows[r.doc_id].predicted == r.toxic for r in labels]
    caught = [rows[r.doc_id].predicted for r in labels if r.toxic]
    assert np.mean(right) > 0.97 and np.mean(caught) > 0.85


def test_toxicity_of_odd_rows(spark, frame, odd_rows):
    labels = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    assert fit_toxicity(frame(odd_rows), labels) is None
    assert {r.score for r in score_toxicity(frame(odd_rows), None, ["doc_id"]).collect()} == {0.0}
    bad = [f"the {w} idiot and moron here" for w in "abcdefghijklmnopqrstuvwxyz"]
    good = [f"the {w} lovely weather here" for w in "abcdefghijklmnopqrstuvwxyz"]
    model = train(bad, good)
    assert score_texts(["such an idiot or moron"], model)[0] > score_texts(["such weather"], model)[0]
    assert all(0 <= s <= 1 for s in score_texts([t for _, t, _ in odd_rows], model))
    assert train(bad, []) is None


def plain_base(rows):
    tokens = {i: brute.lower(t).encode().split() + [b""] for i, t in rows}
    counts = Counter(w for i, ws in tokens.items() if not held(i, 7, 2) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in tokens.items()
    }


def test_language_scores(spark):
    rows = QUERIES["op8_language_scores"](spark, SMALL).collect()
    want = plain_base([(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()])
    assert len(rows) == len(want)
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3] and r.held_out == held(r.doc_id, 7, 2)
        assert r.base_score == pytest.approx(want[r.doc_id][3]) and r.score < 0
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_language_chances_sum_to_one():
    """The predictive chances of all known tokens and the unknown one, in every context."""
    random.seed(3)
    texts = [" ".join(random.choice("abcdefgh") * random.randrange(1, 3) for _ in range(50)) for _ in range(20)]
    _, rows = pitman_yor._token_rows(texts, np.ones(20, bool), 1)
    bucket = pitman_yor._gather([pitman_yor._unpack(rows[0][1])])
    ones = np.ones(len(bucket.pairs))
    customers = np.bincount(bucket.context, bucket.customers, 256)
    draw = np.random.default_rng(0)
    corpus = pitman_yor.Corpus(
        int(customers.sum()), len(bucket.words), tuple(customers), tuple(np.bincount(bucket.context, ones, 256)),
        float(len(bucket.words)), 0.6, 0.6,
    )
    tables = ones
    for _ in range(3):
        tables, top, _ = pitman_yor._sweep(bucket, tables, corpus, draw)
        assert (tables >= 1).all() and (tables <= bucket.customers).all()
        corpus = pitman_yor.Corpus(
            corpus.tokens, corpus.vocabulary, corpus.customers, tuple(np.bincount(bucket.context, tables, 256)),
            float(top.sum()), 0.6, 0.6,
        )
        sent = np.bincount(bucket.word, tables, len(bucket.words))
        base = (pitman_yor._STRENGTH + 0.6 * top.sum()) / (corpus.vocabulary + 1)
        chance = (sent - 0.6 * top + base) / (pitman_yor._STRENGTH + sent.sum())
        assert chance.sum() + corpus.unknown == pytest.approx(1)
        strength = pitman_yor._STRENGTH + customers
        seats = np.bincount(bucket.context, (bucket.customers - 0.6 * tables) / strength[bucket.context], 256)
        share = (pitman_yor._STRENGTH + 0.6 * np.array(corpus.tables)) / strength
        assert seats + share == pytest.approx(np.ones(256))


def test_language_scores_of_odd_rows(frame, odd_rows):
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    rows = pitman_yor.score_language(frame(odd_rows), out).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(brute.lower(t).encode().split()) + 1 for _, t, _ in odd_rows)
    nothing = pitman_yor.score_language(frame(odd_rows), F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens) for r in nothing} == {(0, 0)} and all(r.score <= 0 for r in nothing)
    assert pitman_yor.score_language(frame([]), F.lit(False)).count() == 0


def test_batches_keep_their_names(frame):
    source = frame([(i, f"a{i} b", "s") for i in range(20)], False)
    source = source.select("doc_id", F.lit(False).alias("held_out"), F.col("text").alias("t"))
    made = pitman_yor._dealt(source, 8, 20)
    first, again = ({bytes(r.sub) for r in made.collect()} for _ in range(2))
    assert first == again and len(first) > 1


def test_hot_tokens_are_scored_in_several_groups(spark, frame):
    """A word that is half of all tokens, and scores that do not depend on how batches are cut."""
    rows = [(i, " ".join(random.Random(i).choice(["hot", f"w{j}"]) for j in range(200)), "s") for i in range(400)]
    source = frame(rows, False).select("doc_id", F.lit(False).alias("held_out"), F.col("text").alias("t"))
    made = pitman_yor._dealt(source, 32, 4000).where("bucket >= 0").collect()
    load = Counter()
    for r in made:
        load[r.bucket, r.salt] += len(pitman_yor._unpack(r.blob)[2])
    assert sum(load.values()) == 400 * 201 and max(load.values()) < 4 * 400 * 201 / 32
    out = F.col("doc_id") % 5 == 0
    fine = pitman_yor.score_language(frame(rows), out, batch_bytes=4000, bucket_bytes=20_000).collect()
    want = {i: (len(t.split()) + 1, t.count("hot")) for i, t, _ in rows}
    whole = {r.doc_id: r for r in pitman_yor.score_language(frame(rows), out, bucket_bytes=20_000).collect()}
    assert len(fine) == len(rows)
    for r in fine:
        assert r.n_tokens == want[r.doc_id][0] and r.n_known == whole[r.doc_id].n_known > want[r.doc_id][1]
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score)
        assert r.score == pytest.approx(whole[r.doc_id].score)


def test_tokens_with_equal_endings_have_restaurants_of_their_own(frame):
    rows = [(i, ["west red", "nest blue"][i % 2], "s") for i in range(80)]
    rows += [(100, "west red", "s"), (101, "west blue", "s"), (102, "nest red", "s"), (103, "nest blue", "s")]
    score = {r.doc_id: r.score for r in pitman_yor.score_language(frame(rows, False), F.col("doc_id") >= 100).collect()}
    assert score[100] > score[101] + 0.5 and score[103] > score[102] + 0.5


def test_averaged_chances_sum_to_one_in_every_context(spark):
    """Over buckets, with restaurants whose dishes lie in several of them."""
    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(60)) for _ in range(60)]
    _, rows = pitman_yor._token_rows(texts, np.ones(60, bool), 5)
    blobs = pa.RecordBatch.from_arrays([pa.array([b for _, b, _ in rows], pa.binary())], ["blob"])
    none = np.zeros(0, np.uint64)
    counts = spark.sparkContext.parallelize(list(pitman_yor._counted(iter([blobs]), 5, none))).partitionBy(5)
    corpus = pitman_yor._totals(counts, none)
    assert corpus.tokens == 60 * 61
    made = [b for _, b in pitman_yor._averaged(counts, corpus, 2, 1, 2, 7, 5, none).collect()]
    found = [pitman_yor._seats(b, corpus.discount, none) for b in made]
    share = {w: 10**x for f in found for w, x in zip(f[0], f[3], strict=True)}
    seats = Counter()
    for f in found:
        for pair, seat in zip(f[5], f[6], strict=True):
            seats[f[4][pair % len(f[4])]] += seat
    parent = sum(f[2].sum() for f in found)
    assert set(seats) == set(share) and len(share) == corpus.vocabulary > 100
    for word, part in share.items():
        assert part * (seats[word] + parent + found[0][7][0]) == pytest.approx(1)


def test_packing_and_counting_take_little_memory_a_token():
    """Executors hold several Python workers at once, so what each takes is bounded."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 1000) % 50_000) for _ in range(300)]
    tracemalloc.start()
    try:
        sizes, rows = pitman_yor._token_rows(texts, np.ones(300, bool), 8)
        packing = tracemalloc.get_traced_memory()[1]
        parts = [pitman_yor._unpack(blob) for _, blob, _ in rows]
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        bucket = pitman_yor._gather(parts)
        counting = tracemalloc.get_traced_memory()[1] - held
    finally:
        tracemalloc.stop()
    assert bucket.customers.sum() == sum(sizes) == 300 * 1001
    assert packing < 60 * sum(sizes) and counting < 30 * sum(sizes)


def test_stages_of_the_language_model_have_one_python_worker_a_task(spark, frame):
    counts = spark.sparkContext.parallelize([(0, b"")]).partitionBy(3)
    corpus = pitman_yor.Corpus(1, 1, (), (), 1.0, 0.5, 0.5)
    lines = pitman_yor._averaged(counts, corpus, 2, 1, 1, 7, 3, np.zeros(0, np.uint64)).toDebugString().decode()
    assert lines.count(" PythonRDD[") == lines.count(" PairwiseRDD[") + 1  # one before each shuffle, and the last
    made = pitman_yor.score_language(frame([(1, "a b", "s")], False), F.lit(False))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan  # workers of DataFrames are others than those of RDDs


@pytest.mark.parametrize("seed", range(40))
def test_periods_meet_every_window(seed):
    random.seed(seed)
    weights = {f"s{i}": random.randint(1, 30) for i in range(random.randint(1, 12))}
    total = sum(weights.values())
    for source, slots in period(weights).items():
        assert len(slots) == weights[source]
        for j, slot in enumerate(slots):
            assert j * total // weights[source] <= slot < -(-(j + 1) * total // weights[source])
    blocks = {s: random.randint(0, 50) for s in weights}
    used = []
    for p in phases(blocks, weights):
        used += [p.start + n // len(p.slots) * p.total + p.slots[n % len(p.slots)] for n in range(p.end - p.first)]
    assert sorted(used) == list(range(sum(blocks.values())))


def test_bad_weights():
    for weights in ({"a": 0}, {"a": 10**7}):
        with pytest.raises(ValueError):
            period(weights)


def test_mix_keeps_every_row_and_the_shares(spark):
    rows = QUERIES["op2_source_mixing"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    slots = {}
    for r in rows:
        assert slots.setdefault(r.slot, (r.source, r.block, r.phase)) == (r.source, r.block, r.phase)
    # a text of several blocks is named at its first; every block is served inside its window
    weights = {r.source: MIX_WEIGHTS.get(r.source, MIX_OTHER) for r in rows}
    total = sum(weights.values())
    begun = {(source, block): slot for slot, (source, block, phase) in slots.items() if phase == 0}
    assert len(begun) > 50
    for (source, block), slot in begun.items():
        w = weights[source]
        assert block * total // w <= slot < -(-(block + 1) * total // w)
    chars = Counter()
    for r in rows:
        chars[r.source] += r.chars
    assert max(slots) < sum(-(-n // 65_536) for n in chars.values())


def test_repeated_rows_have_places_of_their_own(frame):
    made = mix_documents(frame([(1, "x" * 100, "s")] * 50), block_chars=100).collect()
    assert [r.mix_slot for r in made] == list(range(50))


def test_long_texts_take_no_more_than_their_share(frame):
    """Up to every slot, a source has had its share of characters to less than a block, of its long texts too."""
    block = 100
    rows = [(i, "x" * 1037, "long") for i in range(40)] + [(1000 + i, "y" * 10, "short") for i in range(5000)]
    rows += [(9000, "z" * 4999, "both"), *[(9001 + i, "z" * 3, "both") for i in range(900)]]
    weights = {"long": 2, "short": 3, "both": 1}
    made = mix_report(frame(rows), weights=weights, block_chars=block).collect()
    assert len(made) == len(rows)
    began = {s: sorted((r.block, r.slot, r.chars) for r in made if r.source == s) for s in weights}
    for source, weight in weights.items():
        first_phase = [(b, s) for b, s, _ in began[source] if s < 300]
        # block j is served within its window, whether a text begins in it or not
        assert first_phase and all(b * 6 // weight <= s < -(-(b + 1) * 6 // weight) for b, s in first_phase)
    taken = {}
    for r in sorted((r for r in made if r.slot < 300), key=lambda r: r.slot):
        taken[r.source] = taken.get(r.source, 0) + r.chars
        # characters begun up to here stay within a block and the length of the text begun last
        assert taken[r.source] < (r.block + 1) * block + r.chars


def test_mix_of_odd_rows(frame, odd_rows):
    docs = frame(odd_rows)
    rows = mix_documents(docs, weights={"a": 3, None: 2}, block_chars=100).collect()
    assert len(rows) == len(odd_rows) and set(docs.columns) < rows[0].asDict().keys()
    assert [r.mix_slot for r in rows] == sorted(r.mix_slot for r in rows)
    assert len(mix_report(docs, block_chars=100).collect()) == len(odd_rows)
    assert mix_documents(frame([])).count() == 0 == mix_report(frame([])).count()


def test_pipeline_against_plain_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    model = fit_toxicity(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(i, t) for (i, t), s in zip(rows, score_texts([t for _, t in rows], model), strict=True) if s < 0.5]
    classes = brute.near_classes(rows)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    data, marks = brute.without_repeats([t for _, t in rows])
    kept = []
    for (i, _), d, m in zip(rows, data, marks, strict=True):
        at, text = 0, ""
        for part in bytes(m).split(b"\1"):  # runs that stay lie between removed bytes
            text += d[at : at + len(part)].decode("utf-8", "ignore")
            at += len(part) + 1
        kept.append((i, text))
    found = brute.contamination([t for _, t in kept], items)
    want = {i: t for (i, t), (n, hit, _) in zip(kept, found, strict=True) if not (hit and 20 * hit >= n)}
    result = corpus_pipeline.run(spark, SMALL)
    got = {r.doc_id: r.text for r in result.collect()}
    assert got == want and result.count() == len(want)
    assert set(docs.columns) < set(result.columns) and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("empty", [True, False])
def test_stages_take_odd_rows(spark, frame, odd_rows, empty):
    import corpus_pipeline

    docs = frame([] if empty else odd_rows)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SMALL)
        assert set(docs.columns) <= set(made.columns), name
        assert made.count() <= docs.count()


def test_registration():
    names = entry_point.queries()
    assert {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
