"""Near-duplicate documents by ProbMinHash, banding and verification.

A text is the set of its five-word shingles; fewer words form one shingle.  Every shingle is a
Poisson process: its arrivals come in order, each lands in a random register, and a register keeps
the shingle of its earliest arrival.  A shingle stops as soon as it arrives later than the latest
register, so a text takes about n + m log m steps for n shingles and m registers.  Registers of two
texts agree with the chance of the probability Jaccard similarity of their rates.  Bands of
registers name buckets.  Some bands weigh a shingle by 1 + ln(occurrences); the others give all rates
as 1, however often a shingle occurs, so that theirs is the similarity that decides the links.

In every bucket one text, drawn by a hash, is the hub, and every other text is compared with it.
Texts that differ from their hub are then compared with those of the bucket that are not yet in
their class, unless the two cannot be similar: shingles that no other candidate text has bound what
they can share.  So no link within a bucket is lost although its pairs are never listed.
A pair is linked when the Jaccard similarity of the shingle sets is at least `least`; classes are
the connected components of the links.

Equal texts are one text, and so in one class.  Null texts are empty.  Texts without words link
with nothing but their equals.  Rows without id are in the class of their text, which is named by
the smallest id there is, else null.  Repeated rows are in one class.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch.llm.components import connected_components
from realmwatch.llm.texts import map_texts, ship, stored, words

_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Hashes of the runs of `size` words, in order; one of all words if there are fewer, but some."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    if len(found) < size:
        hashes = np.concatenate([hashes, np.full(size - len(found), 1, np.uint64)])
    n = len(hashes) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = _mix(total + hashes[k : k + n] + _ODD[0])
    return total


def signatures(texts: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """ProbMinHash registers of weighted sets (hashes, weights); a row for each set, none empty."""
    owner = np.repeat(np.arange(len(texts)), [len(h) for h, _ in texts])
    element = np.concatenate([h for h, _ in texts])
    rate = np.concatenate([w for _, w in texts])
    time = np.zeros(len(element))
    first = np.full(len(texts) * registers, np.inf)
    holder = np.zeros(len(texts) * registers, np.uint64)
    turn = 0
    while len(element):
        turn += 1
        draw = _mix(element + np.uint64(int(_ODD[0]) * 2 * turn % 2**64))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        place = owner * registers + (_mix(draw + _ODD[0]) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = time == first[place]
        holder[place[won]] = element[won]
        latest = first.reshape(-1, registers).max(1)
        active = time < latest[owner]
        owner, element, rate, time = owner[active], element[active], rate[active], time[active]
    return holder.reshape(-1, registers)


def _names(sets: list[tuple[np.ndarray, np.ndarray]], bands: int, rows: int, first: int) -> np.ndarray:
    """Bucket names of the bands `first`, `first` + 1, ... of every set."""
    registers = signatures(sets, bands * rows).reshape(len(sets), bands, rows)
    keys = np.broadcast_to(_mix(np.arange(first, first + bands, dtype=np.uint64) * _ODD[0]), registers.shape[:2])
    for r in range(rows):
        keys = _mix(keys + registers[:, :, r] + _ODD[0])
    return keys


def _bands(texts: list[str | None], bands: int, rows: int, weighted: int = 0) -> list[list[int] | None]:
    """Names of the buckets of every text that has words: of `bands` plain and `weighted` weighted bands."""
    found: list[list[int] | None] = [None] * len(texts)
    for start in range(0, len(texts), 256):
        plain, rated, places = [], [], []
        for i, text in enumerate(texts[start : start + 256], start):
            made, often = np.unique(shingles(text), return_counts=True)
            if len(made):
                plain.append((made, np.ones(len(made))))
                rated.append((_mix(made ^ _ODD[2]), 1 + np.log(often)))  # draws of their own
                places.append(i)
        if not places:
            continue
        keys = _names(plain, bands, rows, 1)
        if weighted:
            keys = np.concatenate([keys, _names(rated, weighted, rows, bands + 1)], axis=1)
        for i, k in zip(places, keys.view(np.int64).tolist(), strict=True):
            found[i] = k
    return found


def text_key(text: str | Column) -> Column:
    """A name for a text: equal texts, and no others, have equal ones."""
    value = F.col(text) if isinstance(text, str) else text
    return F.substring(F.unhex(F.sha2(F.coalesce(value.cast("string"), F.lit("")), 256)), 1, 16)


def _jaccard(left: np.ndarray, right: np.ndarray) -> float:
    if not len(left) or not len(right):
        return 0.0
    both = len(np.intersect1d(left, right, assume_unique=True))
    return both / (len(left) + len(right) - both)


def _verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """`similar` for each pair (u, v) of text keys; only u's text travels, to where v's is."""
    schema = T.StructType([*pairs.select("u", "v").schema.fields, T.StructField("similar", T.BooleanType())])
    sides = pairs.select("u", "v").join(texts.select(F.col("k").alias("u"), F.col("t").alias("a")), "u")
    sides = sides.join(texts.select(F.col("k").alias("v"), F.col("t").alias("b")), "v").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            similar = []
            for name, a, b in zip(batch["v"].to_pylist(), batch["a"], batch["b"], strict=True):
                if name != last:
                    last, held = name, np.unique(shingles(b.as_py()))
                similar.append(_jaccard(np.unique(shingles(a.as_py())), held) >= least)
            yield pa.RecordBatch.from_arrays(
                [batch["u"], batch["v"], pa.array(similar, pa.bool_())], names=schema.names
            )

    return sides.mapInArrow(run, schema)


_GROUPS = 48


def _shared_shingles(texts: DataFrame) -> DataFrame:
    """For every text (k, t): n, its distinct shingles, and m0, m1, ...: those in each group of hashes that
    another text has as well.  Two texts share no more than the lesser of theirs in each group."""
    schema = T.StructType([T.StructField("s", T.LongType()), texts.schema["k"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, t in zip(batch["k"].to_pylist(), batch["t"], strict=True):
                made = np.unique(shingles(t.as_py())).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made), pa.array([k], pa.binary()).take(pa.array(np.zeros(len(made), np.int64)))],
                    names=schema.names,
                )

    def count(texts: list[str | None]) -> list[list]:
        made = [np.unique(shingles(t)).view(np.int64) % _GROUPS for t in texts]
        return [[len(m) for m in made], [np.bincount(m, minlength=_GROUPS).tolist() for m in made]]

    fields = [T.StructField("n", T.LongType()), T.StructField("all", T.ArrayType(T.LongType()))]
    size = map_texts(texts, "t", ["k"], count, fields)
    found = texts.select("k", "t").mapInArrow(run, schema)
    alone = found.groupBy("s").agg(F.count("*").alias("c"), F.min("k").alias("k")).where("c = 1")
    group = F.pmod("s", F.lit(_GROUPS))
    alone = alone.groupBy("k").agg(*[F.count(F.when(group == g, 1)).alias(f"a{g}") for g in range(_GROUPS)])
    return size.join(alone, "k", "left").select(
        "k", "n", *[(F.col("all")[g] - F.coalesce(f"a{g}", F.lit(0))).alias(f"m{g}") for g in range(_GROUPS)]
    )


def text_classes(
    docs: DataFrame, text_col: str = "text", least: float = 0.8, bands: int = 24, rows: int = 5, weighted: int = 6
) -> DataFrame:
    """`node` and `component`, keys of texts, for every text that is linked with another one."""
    ship(docs.sparkSession)
    source = docs.select(F.col(text_col).cast("string").alias("t")).withColumn("k", text_key("t"))
    field = T.StructField("bands", T.ArrayType(T.LongType()))
    signed = map_texts(source, "t", ["k"], lambda texts: [_bands(texts, bands, rows, weighted)], [field])
    keys = signed.where("bands IS NOT NULL").groupBy("k").agg(F.first("bands").alias("bands"))
    buckets = keys.select("k", F.explode("bands").alias("bucket"))
    drawn = F.struct(F.xxhash64("k", "bucket"), F.col("k").alias("k"))
    hubs = buckets.groupBy("bucket").agg(F.min(drawn)["k"].alias("hub"), F.count("*").alias("size"))
    members = stored(buckets.join(hubs.where("size > 1"), "bucket").select("bucket", "k", "hub"), "buckets")

    stars = members.where("k <> hub").select(F.col("k").alias("u"), F.col("hub").alias("v")).distinct()
    used = members.select("k").distinct()
    texts = stored(source.join(used, "k").groupBy("k").agg(F.first("t").alias("t")), "texts")
    checked = stored(_verify(stars, texts, least), "links")
    links = checked.where("similar").select("u", "v")
    classes = connected_components(links)

    failed = checked.where(~F.col("similar")).select(F.col("u").alias("k"), F.col("v").alias("hub"))
    named = members.join(classes.withColumnRenamed("node", "k"), "k", "left")
    named = stored(named.select("bucket", "k", "hub", F.coalesce("component", "k").alias("c")), "named")
    apart = stored(named.join(failed, ["k", "hub"]).select("bucket", "k", "c"), "apart")
    mixed = named.join(apart.select("bucket").distinct(), "bucket")
    shared = stored(_shared_shingles(texts.join(mixed.select("k").distinct(), "k")), "shared")
    groups = [f"m{g}" for g in range(_GROUPS)]
    left = apart.join(shared, "k").select(
        "bucket", F.col("k").alias("f"), F.col("c").alias("fc"), F.col("n").alias("fn"),
        *[F.col(g).alias(f"f{g}") for g in groups],
    )
    right = mixed.where("k <> hub").join(shared, "k").select("bucket", "k", "c", "n", *groups)
    most = reduce(Column.__add__, [F.least(g, f"f{g}") for g in groups])
    able = most >= least * (F.col("n") + F.col("fn") - most)
    more = right.join(left, (right.bucket == left.bucket) & (F.col("c") != F.col("fc")) & able)
    more = more.select(F.least("k", "f").alias("u"), F.greatest("k", "f").alias("v")).distinct()
    more = stored(more, "pairs")
    if more.isEmpty():
        return classes
    found = stored(_verify(more, texts, least).where("similar").select("u", "v"), "links")
    return connected_components(found.unionAll(classes.select(F.col("node").alias("u"), F.col("component").alias("v"))))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8
) -> DataFrame:
    """doc_id, class_id (the smallest id of its class) and kept, whether it is that one, per row."""
    classes = text_classes(docs, text_col, least)
    named = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("node"))
    named = named.join(classes, "node", "left").select("doc_id", F.coalesce("component", "node").alias("c"))
    named = stored(named, "classes")
    least_id = named.groupBy("c").agg(F.min("doc_id").alias("class_id"))
    return named.join(least_id, "c").select(
        "doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)).alias("kept")
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8
) -> DataFrame:
    """One row of each class, with all its columns: that of the smallest id (rows without id last)."""
    classes = text_classes(docs, text_col, least)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(text_key(text_col).alias("__key"), row.alias("__row"))
    light = docs.select(F.col(id_col).alias("__id"), text_key(text_col).alias("node"))
    best = light.groupBy("node").agg(F.min(F.struct(F.col("__id").isNull().alias("n"), "__id")).alias("o"))
    best = best.join(classes, "node", "left").select("node", "o", F.coalesce("component", "node").alias("c"))
    chosen = best.groupBy("c").agg(F.min_by("node", F.struct("o", "node")).alias("__key")).select("__key")
    id_of = F.col("__row")[id_col]
    rows = keyed.join(chosen, "__key").groupBy("__key").agg(
        F.min_by("__row", F.struct(id_of.isNull(), id_of)).alias("__row")
    )
    return rows.select("__row.*")
