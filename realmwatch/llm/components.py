"""Connected components of a graph that no single task can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from realmwatch.llm.texts import stored


def _least_neighbour(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node it can reach, for every node of `edges` (u, v).

    Alternating star operations: every node points its larger, then its smaller neighbours at its
    smallest one, until all edges point at the smallest node of their component.  Minima are
    taken on the map side, the joins may be split by adaptive execution, so a hub may be as large
    as the graph.  Each round is written to the shared folder; rounds grow with the logarithm of
    the longest path.
    """
    rows = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    state = None
    while True:
        both = rows.unionAll(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both)
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        )
        least = _least_neighbour(large)
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .unionAll(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        rows = stored(small, "edges")
        total = rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if total == state:
            break
        state = total
    roots = rows.select(F.col("v").alias("node")).distinct()
    return rows.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )
