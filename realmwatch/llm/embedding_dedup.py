"""Embedding near-duplicates by p-stable hashing with exact cosine checks.

Vectors are normalised, so a cosine bound is a bound on the Euclidean distance.  Each of several
tables projects a vector on random Gaussian directions, shifts and divides by a width, and rounds
down; the numbers of a table together name its bucket.  The number of directions grows with the
logarithm of the rows, and the number of tables follows from the chance, `miss`, that a pair just
at the bound shares no bucket.  Inside a bucket all pairs get an exact cosine in double precision.
A pair that shares several buckets counts in the first table only, so no list of pairs is made:
a bucket yields link counts and, for every linked vector, one vector of its component there.

Equal vectors are one vector with a weight.  Buckets of more than `block` vectors are cut into
blocks, and every pair of blocks is a task's group of its own.

Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing, nor do
rows without id; vectors of different lengths never link.  Repeated rows are vectors of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch.llm.components import connected_components
from realmwatch.llm.texts import ship, stored

_WIDTH = 2.0


def collision(distance: float, width: float = _WIDTH) -> float:
    """Chance that one quantised projection of two points at this distance is the same."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, least: float, miss: float) -> tuple[int, int]:
    """Directions of a table, and tables."""
    directions = max(5, round(math.log2(max(rows, 2))) - 10)
    found = collision(math.sqrt(max(2 - 2 * least, 1e-9))) ** directions
    return directions, max(1, math.ceil(math.log(miss) / math.log1p(-found)))


def _unit(vectors: list | np.ndarray) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # squares of very large or small numbers stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pack(vector: np.ndarray) -> bytes:
    """The numbers as they are: in four bytes each if that loses nothing, else in eight."""
    with np.errstate(over="ignore"):
        short = vector.astype(np.float32)
    return b"\4" + short.tobytes() if (short == vector).all() else b"\10" + vector.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.float32 if packed[0] == 4 else np.float64, offset=1).astype(np.float64)


def _hashed(distinct: DataFrame, directions: int, tables: int) -> DataFrame:
    """The bucket of every table, and the vector packed."""
    schema = T.StructType([
        T.StructField("rep", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("codes", T.BinaryType()),
        T.StructField("packed", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch["vector"].to_pylist()
            keys: list = [None] * len(vectors)
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes).tolist():
                random = np.random.default_rng([size, directions, tables])
                lines = random.standard_normal((size, tables * directions))
                shifts = random.uniform(0, _WIDTH, tables * directions)
                mix = random.integers(1, 2**62, directions) * 2 + 1
                offset = random.integers(1, 2**62, tables)
                chosen = np.flatnonzero(sizes == size)
                for at in range(0, len(chosen), 1024):
                    rows = chosen[at : at + 1024]
                    cells = np.floor((_unit([vectors[i] for i in rows]) @ lines + shifts) / _WIDTH).astype(np.int64)
                    made = (cells.reshape(len(rows), tables, directions) * mix).sum(2) + offset
                    for i, k in zip(rows.tolist(), made, strict=True):
                        keys[i] = k
            yield pa.RecordBatch.from_arrays(
                [
                    batch["rep"], batch["n"], pa.array([k.tolist() for k in keys], pa.list_(pa.int64())),
                    pa.array([(k >> 20).astype(np.int32).tobytes() for k in keys], pa.binary()),
                    pa.array([_pack(np.array(v, np.float64)) for v in vectors], pa.binary()),
                ],
                names=schema.names,
            )

    return distinct.mapInArrow(run, schema)


def _unite(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Join the components of all p and q; `root[x]` is the smallest place of x's component."""
    while True:
        a, b = root[p], root[q]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root != (jumped := root[root])).any():
            root[:] = jumped


def _links_in(group: list[tuple], least: float, t: int, crossed: bool) -> Iterator[tuple[int, int, int]]:
    """(vector, links, a vector of its component here) of a bucket, or of two of its blocks."""
    side = np.array([g[0] for g in group])
    rep, n = np.array([g[1] for g in group]), np.array([g[2] for g in group])
    vectors = [_unpack(g[4]) for g in group]
    lengths = {len(v) for v in vectors}
    for length in lengths:  # buckets of different lengths share a key by chance only
        here = np.array([i for i, v in enumerate(vectors) if len(v) == length])
        codes = np.frombuffer(b"".join(group[i][3] for i in here), np.int32).reshape(len(here), -1)
        unit = _unit([vectors[i] for i in here])
        links, root = np.zeros(len(here), np.int64), np.arange(len(here))
        for start in range(0, len(here), 256):
            near = unit[start : start + 256] @ unit.T >= least
            i, j = np.nonzero(near)
            i += start
            keep = i < j
            if crossed:
                keep &= side[here[i]] != side[here[j]]
            i, j = i[keep], j[keep]
            for a in range(0, len(i), 100_000):
                p, q = i[a : a + 100_000], j[a : a + 100_000]
                first = ~(codes[p, :t] == codes[q, :t]).any(1)
                p, q = p[first], q[first]
                np.add.at(links, p, n[here[q]])
                np.add.at(links, q, n[here[p]])
                _unite(root, p, q)
        for x in np.flatnonzero(links).tolist():
            yield int(rep[here[x]]), int(links[x]), int(rep[here[root[x]]])


def _links(rows: DataFrame, least: float) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("rep", "links", "low")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []
        made: list[tuple] = []

        def close() -> None:
            if len(group) > 1:
                made.extend(_links_in(group, least, at[0], at[2] != at[3]))

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("t", "key", "b1", "b2", "block", "rep", "n", "codes", "packed")]
            for t, key, b1, b2, *row in zip(*columns, strict=True):
                if at != (t, key, b1, b2):
                    if group:
                        close()
                    at, group = (t, key, b1, b2), []
                group.append(row)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], names=schema.names)
                made.clear()
        if group:
            close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], names=schema.names)

    return rows.mapInArrow(run, schema)


def link_embeddings(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.9,
    miss: float = 0.001,
    block: int = 4096,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of `vectors`."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & nonzero, F.lit(False))
    # A zero has no sign here, so that equal vectors have equal hashes.
    rows = rows.select(
        "vec_id", F.when(usable, F.transform("vector", lambda x: x + F.lit(0.0))).alias("vector")
    )
    good = rows.where("vector IS NOT NULL")
    distinct = stored(
        good.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vectors"
    )
    directions, tables = plan(distinct.count(), least, miss)
    hashed = stored(_hashed(distinct, directions, tables), "hashed")
    keys = hashed.select("rep", F.posexplode("keys").alias("t", "key"))
    sizes = keys.groupBy("t", "key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    dealt = keys.join(sizes, ["t", "key"]).withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("t", "key", "rep", "block", other).select(
        "t", "key", "rep", "block", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2")
    )
    dealt = dealt.join(hashed.select("rep", "n", "codes", "packed"), "rep")
    ordered = dealt.repartition("t", "key", "b1", "b2").sortWithinPartitions("t", "key", "b1", "b2")
    found = stored(_links(ordered, least), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("rep").alias("u"), F.col("low").alias("v")))
    result = (
        distinct.join(links, "rep", "left")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "vector",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    joined = rows.join(result, "vector", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
