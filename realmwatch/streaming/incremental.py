"""Fold a stream of log lines into the summary store, batch by batch."""

from __future__ import annotations

import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from realmwatch.functions.enctypes import enctype_rows
from realmwatch.functions.times import day_start
from realmwatch.operators import conditions as c
from realmwatch.operators.audit import routed
from realmwatch.operators.cube import KEYS, event_cube
from realmwatch.operators.joins import with_list_flags
from realmwatch.operators.last_seen import princ_changes
from realmwatch.plans.batch import cube_deltas, fold_into
from realmwatch.plans.store import PART, SummaryStore
from realmwatch.schemas import CLIENT_SLICES, DAY_SECONDS, SUCCESS
from realmwatch.sources import logs, parser, tables

# Folds of staged batches that run at a time: one alone leaves cores idle while its jobs are planned.
FOLDS_AT_ONCE = 4

_STATE = "org.apache.spark.sql.execution.streaming.state"

# What the cube reads of an event.
_STAGED = ["outcome", "problem", *KEYS, "log_time", "authtime"]
_STAGED_SCHEMA = T.StructType([f for f in SUCCESS.fields if f.name in _STAGED]).add("outcome", "string").add("problem", "string")


def _batch_id(batch: DataFrame, name: str | None, number: int) -> str:
    source = name or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not source:
        raise RuntimeError("the stream has no query id; give it a name")
    return f"{source}-{number:010d}"


def run_incremental(
    lines: DataFrame,
    store: SummaryStore,
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
    compact_every: int | None = None,
    days: int | None = None,
    as_of: int | None = None,
    rejects_path: str | None = None,
    kdc_only: bool = False,
    fold_every: int | None = None,
    **extras,
) -> StreamingQuery:
    """Parse, fold and discard each micro-batch; data of any age joins its own day.

    A batch is named in the store by its number and the id that its query keeps in the
    checkpoint, so a batch that is replayed after a failure is written once, and streams with
    checkpoints of their own never meet.  A `name` takes the id's place: then a new
    checkpoint under the same name must read the same data in the same batches.  `every` is a
    processing-time interval; without it the stream ends when the input present at the start
    is used up.  Every `compact_every` batches the store is compacted; with `days` that drops
    the slices that began more than so many days before `as_of`, by default the clock, and
    never before what a log line claims.  Lines with something to report are counted by
    problem in the store's `report_counts`, and written under `rejects_path`, if given, by
    batch.  `kdc_only` drops the lines of other daemons.

    A fold costs seconds however few lines it has.  With `fold_every` a batch only parses its lines and stages
    their events in the store; once so many batches wait they are folded as one, and readers see them from then on;
    if a micro-batch brings several times as many, several such folds run side by side.
    What is staged when the stream ends is folded by `catch_up` or `fold_staged`, or by the next run.  Lines with a
    column `batch`, as `scan_growing` gives with `batches_per_trigger`, are staged as the batches it tells apart,
    which a micro-batch then holds several of; `compact_every` counts micro-batches.
    """
    if fold_every:
        return _run_staged(
            lines, store, checkpoint, name, every, compact_every, days, as_of, rejects_path, kdc_only, fold_every, extras
        )

    def fold(batch: DataFrame, number: int) -> None:
        batch_id = _batch_id(batch, name, number)
        if store.is_committed(batch_id):
            return
        raw = logs.drop_local_tgt(batch)
        parsed = parser.parse_events(logs.kdc_lines(raw) if kdc_only else raw)
        events = routed(parsed)
        if rejects_path:  # the only other reader of the lines
            events = events.persist(StorageLevel.MEMORY_AND_DISK)
        cube = event_cube(events).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if rejects_path:
                reports = parser.rejects(events).write.mode("overwrite")
                reports.parquet(f"{rejects_path}/batch_id={batch_id}")
            fold_into(store, batch_id, cube_deltas(cube, **extras))
        finally:
            cube.unpersist()
            if rejects_path:
                events.unpersist()
        if compact_every and (number + 1) % compact_every == 0:
            _compact(store, days, as_of)

    writer = lines.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return (writer.queryName(name) if name else writer).trigger(**_trigger(every)).start()


def _compact(store: SummaryStore, days: int | None, as_of: int | None) -> None:
    now = int(time.time()) if as_of is None else as_of
    store.compact(days, now if days is not None else None)


def _run_staged(
    lines: DataFrame, store: SummaryStore, checkpoint: str, name: str | None, every: str | None,
    compact_every: int | None, days: int | None, as_of: int | None, rejects_path: str | None, kdc_only: bool,
    fold_every: int, extras: dict,
) -> StreamingQuery:
    raw = logs.drop_local_tgt(lines)
    events = routed(parser.parse_events(logs.kdc_lines(raw) if kdc_only else raw))
    reported = ["value"] if rejects_path else []
    kept = [*_STAGED, *([PART] if PART in lines.columns else [])]
    events = events.select(*kept, *reported)  # parsed by the stream's own plan, which is made once
    waiting: dict[str, int] = {}  # batches by source, counted in the store when the first one comes

    def stage(batch: DataFrame, number: int) -> None:
        batch_id = _batch_id(batch, name, number)
        source = batch_id.rpartition("-")[0]
        if source not in waiting:
            waiting[source] = len(store.staged(source))
        if store.is_taken(batch_id):
            return
        if rejects_path:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if rejects_path:
                reports = parser.rejects(batch).write.mode("overwrite")
                reports.parquet(f"{rejects_path}/batch_id={batch_id}")
            waiting[source] += store.stage(batch.select(*kept), batch_id)
        finally:
            if rejects_path:
                batch.unpersist()
        if waiting[source] >= fold_every:
            waiting[source] = _fold_full(store, source, fold_every, extras)
        if compact_every and (number + 1) % compact_every == 0:
            _compact(store, days, as_of)

    writer = events.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)
    return (writer.queryName(name) if name else writer).trigger(**_trigger(every)).start()


def fold_staged(store: SummaryStore, source: str, **extras) -> None:
    """Fold what the stream of this name or id has staged, as one batch that counts whole or not at all."""
    if batches := store.staged(source):
        _fold(store, batches, extras)


def _fold_full(store: SummaryStore, source: str, fold_every: int, extras: dict) -> int:
    """Fold what is staged by so many batches each, several folds side by side; gives how many are left for later."""
    batches = store.staged(source)
    left = len(batches) % fold_every
    full = [batches[i : i + fold_every] for i in range(0, len(batches) - left, fold_every)]

    @inheritable_thread_target(store.spark)
    def fold(group: list[str]) -> None:
        _fold(store, group, extras)

    with ThreadPoolExecutor(min(len(full), FOLDS_AT_ONCE)) as pool:
        for done in [pool.submit(fold, group) for group in full]:
            done.result()
    return left


def _fold(store: SummaryStore, batches: list[str], extras: dict) -> None:
    fold = store.group(batches)
    cube = event_cube(store.read_staged(batches, _STAGED_SCHEMA)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fold_into(store, fold, cube_deltas(cube, **extras))
    finally:
        cube.unpersist()
    store.settle(fold)


def catch_up(query: StreamingQuery, store: SummaryStore | None = None, **extras) -> None:
    """Let a stream with an interval read all that its sources hold now, then end it, and fold what it has staged.

    A source that cuts its batches itself, as `scan_growing` does with `lines_per_batch`, would read only one of
    them without an interval.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if store is not None:
        fold_staged(store, query.name or str(query.id), **extras)


def parse_stream(lines: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append parsed lines to an event table, with no state; sources.tables reads it."""
    parsed = parser.parse_events(logs.drop_local_tgt(lines))
    writer = tables.stored_form(parsed).writeStream.format("parquet").option("path", path)
    return (
        writer.option("checkpointLocation", checkpoint)
        .partitionBy(*tables.PARTITIONS)
        .trigger(**_trigger(every))
        .start()
    )


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on the executors' disks and not on their heaps."""
    with _set(spark, "spark.sql.streaming.stateStore.providerClass", f"{_STATE}.RocksDBStateStoreProvider"):
        yield


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Streams started inside have a setting of their own."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def run_native_slices(
    lines: DataFrame, path: str, checkpoint: str, days: int, every: str | None = None, kdc_only: bool = False
) -> StreamingQuery:
    """Client slices of a stream of lines as Spark's own windowed state, written below `path` once a day is closed.

    No store and no merge: a day is written once, `days` days after its end, and kept in the state store until
    then.  Later lines of a closed day are dropped; `dropped_rows` counts them.
    """
    raw = logs.drop_local_tgt(lines)
    success = parser.successes(routed(parser.parse_events(logs.kdc_lines(raw) if kdc_only else raw)))
    writer = native_client_slices(success, days).writeStream.format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    with _state_on_disk(lines.sparkSession):
        return writer.trigger(**_trigger(every)).start()


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came after their window was closed, as the query's recent progress reports them: each is one
    key and day of one task, since events are combined before the state store sees them."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def run_native_princ(
    lines: DataFrame,
    store: SummaryStore,
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
    kdc_only: bool = False,
    enctypes: DataFrame | None = None,
) -> StreamingQuery:
    """Principals kept as state of the stream; a batch hands the store those it changed, and no others.

    The state is one row for each principal, as in the store.  Batches are named as by `run_incremental`.
    """
    known = None if enctypes is None else enctype_rows(enctypes)
    raw = logs.drop_local_tgt(lines)
    events = routed(parser.parse_events(logs.kdc_lines(raw) if kdc_only else raw))

    def hand_over(batch: DataFrame, number: int) -> None:
        fold_into(store, _batch_id(batch, name, number), {"princ": batch})

    writer = princ_changes(events, known).writeStream.foreachBatch(hand_over).outputMode("update")
    writer = writer.option("checkpointLocation", checkpoint)
    with _state_on_disk(lines.sparkSession):
        return (writer.queryName(name) if name else writer).trigger(**_trigger(every)).start()


def native_client_slices(success: DataFrame, days: int) -> DataFrame:
    """Client slices as a stateful streaming aggregation.

    A day is emitted once, when the newest event is more than `days` days past its end;
    until then late events still join it, after that they are dropped.
    """
    day = F.window("ts", f"{DAY_SECONDS} seconds").alias("day")
    named = {f"n{k}": c.tally(when) for k, when in c.CLIENT_ADDRESS.items()}
    sliced = (
        with_list_flags(c.counted(success).withColumn("ts", F.timestamp_seconds("log_time")))
        .withWatermark("ts", f"{days} days")
        .groupBy("ip", day)
        .agg(*c.measures({"nentries": f"sum({c.COUNT})", **named}))
    )
    start = day_start(F.unix_seconds("day.start"))
    return (
        sliced.withColumns(
            {"starttime": start, "endtime": start + (DAY_SECONDS - 1), "is_success": F.lit(1)}
        ).select(*CLIENT_SLICES.names)
    )
