"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in an order drawn by a hash, are cut into blocks of `block_chars` characters.
With integer weights, w of a sum W for a source, its block j may not be served before slot
floor(j * W / w) and must be before slot ceil((j + 1) * W / w).  The earliest deadline first,
one block a slot, meets all of these windows, so at every slot a source has had less than one block
more or less than its share.  A document begins in the block where its first character falls and takes the
slots of all blocks that its characters span, so shares hold in characters, however long texts are; of
a text that spans several blocks only the first of their slots is named.  The schedule repeats after W slots; one period is planned
on the driver, its length being the sum of the given weights, and blocks find their slots from it by
arithmetic.  When a source has no block left, the others go on by their own weights in a new phase,
so every document is placed exactly once and none is repeated.

Weights not given are `other`; null is a source of its own.  Null and empty texts have no characters
and stand in the block in which they fall.  Ties of the hash are ordered by id and text; equal
rows get places of their own.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from realmwatch.llm.texts import stored

# At most so many slots in a period; it bounds what the driver plans.
MOST_WEIGHT = 1_000_000


def period(weights: Mapping[str, int]) -> dict[str, list[int]]:
    """The slots of every source in one period, by earliest deadline first among released blocks."""
    total = sum(weights.values())
    if not 0 < total <= MOST_WEIGHT or min(weights.values()) < 1:
        raise ValueError(f"weights must be positive integers with a sum of at most {MOST_WEIGHT}")
    slots: dict[str, list[int]] = {s: [] for s in weights}
    waiting = [(0, s) for s in sorted(weights)]  # release slot and source
    heapq.heapify(waiting)
    ready: list[tuple[int, str]] = []  # deadline and source
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, source = heapq.heappop(waiting)
            served = len(slots[source])
            heapq.heappush(ready, (-(-(served + 1) * total // weights[source]), source))
        deadline, source = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a deadline is missed")
        slots[source].append(slot)
        served = len(slots[source])
        if served < weights[source]:
            heapq.heappush(waiting, (served * total // weights[source], source))
    return slots


@dataclass(frozen=True)
class Phase:
    """Blocks `first` up to `end` of a source, at the slots from `start` on."""

    source: str
    number: int
    first: int
    end: int
    start: int
    total: int
    slots: tuple[int, ...]


def phases(blocks: Mapping[str, int], weights: Mapping[str, int]) -> list[Phase]:
    """A phase ends with the last block of the first source that runs out."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    start, number, made = 0, 0, []
    while left:
        slots = period({s: weights[s] for s in left})
        total = sum(map(len, slots.values()))

        def last(source: str, n: int, slots: dict = slots, total: int = total) -> int:
            """The slot of the source's n-th block of this phase, from 1."""
            rounds, at = divmod(n - 1, len(slots[source]))
            return rounds * total + slots[source][at]

        length = min(last(s, n) for s, n in left.items()) + 1
        rounds, rest = divmod(length, total)
        for source in sorted(left):
            served = rounds * len(slots[source]) + sum(x < rest for x in slots[source])
            made.append(
                Phase(source, number, done[source], done[source] + served, start, total, tuple(slots[source]))
            )
            done[source] += served
            left[source] -= served
        left = {s: n for s, n in left.items() if n}
        start += length
        number += 1
    return made


def place_blocks(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: Mapping[str | None, int] | None = None,
    other: int = 1,
    block_chars: int = 65_536,
    seed: int = 11,
) -> DataFrame:
    """`__source`, `__id`, `__key` (a hash of the text), `__n`, block, phase and slot for every document.

    Rows that are equal in id, source and text are told apart by `__n`.
    """
    given = {("s" + k if k is not None else "n"): w for k, w in (weights or {}).items()}
    name = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    light = docs.select(
        name.alias("__source"),
        F.col(id_col).alias("__id"),
        F.xxhash64(text).alias("__key"),
        F.length(text).cast("long").alias("chars"),
    )
    # Equal rows count together until the end, however many there are.
    light = light.groupBy("__source", "__id", "__key").agg(F.count("*").alias("copies"), F.first("chars").alias("chars"))
    light = light.withColumn("order", F.xxhash64("__id", "__key", F.lit(seed)))
    # Characters before a document: those of earlier slices of its source, and of its own slice.
    # Slices hold about a thousand documents whatever the size of their source.
    size = light.groupBy("__source").agg(F.sum("copies").alias("rows"))
    width = F.greatest(F.lit(1), F.ceil(F.col("rows") / 1000)).cast("long")
    unsigned = F.shiftrightunsigned("order", 1)
    light = stored(
        light.join(size, "__source").withColumn("slice", unsigned % width).drop("rows"), "mixing"
    )
    slices = light.groupBy("__source", "slice").agg(F.sum(F.col("chars") * F.col("copies")).alias("sum"))
    # One row for a thousand documents; summed in groups of slices first, so no window grows with the source.
    groups = slices.groupBy("__source", (F.col("slice") / 1000).cast("long").alias("part")).agg(F.sum("sum").alias("psum"))
    before = Window.partitionBy("__source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("pbefore", F.coalesce(F.sum("psum").over(before), F.lit(0)))
    inside = Window.partitionBy("__source", "part").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("part", (F.col("slice") / 1000).cast("long"))
    slices = slices.withColumn("sbefore", F.coalesce(F.sum("sum").over(inside), F.lit(0)))
    offsets = slices.join(groups, ["__source", "part"]).select(
        "__source", "slice", (F.col("pbefore") + F.col("sbefore")).alias("offset")
    )
    own = Window.partitionBy("__source", "slice").orderBy("order", "__id", "__key")
    total = F.sum(F.col("chars") * F.col("copies")).over(own.rowsBetween(Window.unboundedPreceding, -1))
    placed = light.withColumn("within", F.coalesce(total, F.lit(0))).join(offsets, ["__source", "slice"])
    placed = placed.withColumn("__n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    position = F.col("offset") + F.col("within") + (F.col("__n") - 1) * F.col("chars")
    placed = placed.withColumn("cut", (position / block_chars).cast("long"))
    placed = stored(placed.select("__source", "__id", "__key", "__n", "cut", "chars"), "placed")
    # A document stands in the block where it begins, and takes the slots of all blocks that its characters
    # span: those in between hold no document of their own.
    cuts = stored(placed.select("__source", F.col("cut").alias("block")).distinct(), "cuts")
    # The driver sees one number for each source; a period has at least as many slots, which bounds them.
    ends = slices.groupBy("__source").agg(F.sum("sum").alias("chars"))
    spans = F.greatest(F.ceil(F.col("chars") / block_chars), F.col("begun") + 1).alias("n")
    begun = cuts.groupBy("__source").agg(F.max("block").alias("begun"))
    totals = ends.join(begun, "__source").select("__source", spans).limit(MOST_WEIGHT + 1).collect()
    counts = {r["__source"]: r["n"] for r in totals}
    plan = phases(counts, {s: given.get(s, other) for s in counts})
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(p.source, p.number, p.first, p.end, p.start, p.total, list(p.slots)) for p in plan],
        "__source string, phase int, first long, end long, start long, total long, slots array<long>",
    )
    nth = F.col("block") - F.col("first")
    width = F.size("slots")
    slot = F.col("start") + F.floor(nth / width) * F.col("total") + F.element_at("slots", (nth % width + 1).cast("int"))
    slotted = cuts.join(table, "__source").where("block >= first AND block < end")
    slotted = slotted.select("__source", "block", "phase", slot.alias("slot"))
    return placed.withColumnRenamed("cut", "block").join(slotted, ["__source", "block"]).select(
        "__source", "__id", "__key", "__n", "chars", "block", "phase", "slot"
    )


def mix_report(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """doc_id, source, block, phase and slot of every document."""
    placed = place_blocks(docs, source_col, id_col, **options)
    name = F.when(F.col("__source") != "n", F.substring("__source", 2, 2_000_000_000))
    return placed.select(F.col("__id").alias("doc_id"), name.alias("source"), "chars", "block", "phase", "slot")


def mix_documents(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options
) -> DataFrame:
    """All rows and columns, sorted by their slot, with mix_block, mix_phase and mix_slot added."""
    names = docs.columns
    placed = place_blocks(docs, source_col, id_col, text_col, **options)
    place = placed.select("__source", "__id", "__key", "__n", F.struct("slot", "block", "phase").alias("__p"))
    name = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n"))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in names],
        name.alias("__s"),
        F.col(id_col).alias("__i"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("__k"),
    )
    # Rows equal in source, id and text take the places of their kind in the order of their other columns.
    others = F.to_json(F.struct(F.lit(0).alias("__0"), *[F.col(f"`{c}`") for c in names if c != text_col]))
    rows = rows.withColumn("__r", F.row_number().over(Window.partitionBy("__s", "__i", "__k").orderBy(others)))
    same = (F.col("__s") == F.col("__source")) & F.col("__i").eqNullSafe(F.col("__id")) & (F.col("__k") == F.col("__key"))
    same = same & (F.col("__r") == F.col("__n"))
    joined = rows.join(place, same).select(
        *[F.col(f"`{c}`") for c in names],
        F.col("__p.block").alias("mix_block"),
        F.col("__p.phase").alias("mix_phase"),
        F.col("__p.slot").alias("mix_slot"),
    )
    return joined.orderBy("mix_slot")
