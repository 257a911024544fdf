"""Batch workflow: load raw logs, fold them into the summary store, prune."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from realmwatch.functions.enctypes import enctype_rows
from realmwatch.operators import last_seen, slices, trends
from realmwatch.operators.audit import routed
from realmwatch.operators.cube import cube_failures, cube_reports, cube_successes, event_cube
from realmwatch.operators.lists import discover_lists, list_flags
from realmwatch.operators.merge import upsert
from realmwatch.plans.folders import Folder
from realmwatch.plans.store import SummaryStore
from realmwatch.sources import logs, parser, tables


def summary_deltas(
    success: DataFrame,
    failure: DataFrame,
    failures_too: bool = False,
    triples: bool = False,
    tickets: bool = False,
    averages: bool = False,
    enctypes: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The deltas of one set of events, by store table.

    `failures_too` also folds failures into client.last_fail and into slices of their own;
    `triples` also slices address/client/server triples by day; `tickets` counts tickets into
    the principal slices of their servers; `averages` keeps decayed averages of client slices.  `enctypes` is a site's own enctype table, which
    then decides every flag, of lists and of keys.
    """
    known = None if enctypes is None else enctype_rows(enctypes)
    deltas = {
        "req_enctypes_lists": list_flags(discover_lists(success, failure), enctypes),
        "client": last_seen.client_last_seen(success, enctypes=known),
        "princ": last_seen.princ_last_seen(success, failure, enctypes=known),
        "client_cname_sname": last_seen.ccs_last_seen(success, known),
        "client_slice_data": slices.client_slices(success, enctypes=known),
        "princ_slice_data": slices.princ_slices(success, enctypes=known),
    }
    if failures_too:
        deltas["client"] = upsert(
            deltas["client"], last_seen.client_last_fail(failure), ["ip"], "max"
        )
        deltas["client_slice_data"] = deltas["client_slice_data"].unionByName(
            slices.client_slices(failure, is_success=0, enctypes=known)
        )
        deltas["princ_slice_data"] = deltas["princ_slice_data"].unionByName(
            slices.princ_fail_slices(failure)
        )
    if tickets:
        deltas["princ_slice_data"] = deltas["princ_slice_data"].unionByName(
            slices.ticket_counts(success, failure, known)
        )
    if averages:
        deltas["client_average_data"] = trends.decayed_counts(deltas["client_slice_data"], ["ip", "is_success"])
    if triples:
        deltas["ccs_slice_data"] = slices.ccs_slices(success, known)
    return deltas


def cube_deltas(cube: DataFrame, **extras) -> dict[str, DataFrame]:
    """All deltas of an event cube, the counts of reported lines among them."""
    deltas = summary_deltas(cube_successes(cube), cube_failures(cube), **extras)
    return deltas | {"report_counts": cube_reports(cube)}


def fold_into(store: SummaryStore, batch_id: str, deltas: dict[str, DataFrame]) -> bool:
    """Write and commit a batch; False when it had been committed before.

    The tables do not depend on each other, so their jobs are submitted together and share
    the cluster; the commit waits for all of them.
    """
    if store.is_committed(batch_id):
        return False

    @inheritable_thread_target(store.spark)
    def write(name: str) -> None:
        store.write_delta(name, deltas[name], batch_id)

    with ThreadPoolExecutor(len(deltas)) as pool:
        for done in [pool.submit(write, name) for name in deltas]:
            done.result()
    store.commit(batch_id)
    return True


def run_batch(
    spark: SparkSession,
    paths: str | Sequence[str],
    events_path: str,
    store: SummaryStore,
    batch_id: str,
    discard: bool = False,
    kdc_only: bool = False,
    **extras,
) -> bool:
    """Load log files, then fold their events into the store under a batch id.

    Lines are parsed once, on the way to the batch's own folder below `events_path`, beside
    those of other batches; the folds read it with only the columns they need.  Loading the
    same batch id again changes nothing, and a failed attempt is written anew.  With
    `discard` the batch's events are removed once its folds are committed.  `kdc_only` drops
    the lines of other daemons before they are parsed.
    """
    if store.is_committed(batch_id):
        return False
    raw = logs.drop_local_tgt(logs.scan_logs(spark, paths))
    parsed = parser.parse_events(logs.kdc_lines(raw) if kdc_only else raw)
    return load_events(parsed, events_path, store, batch_id, discard, **extras)


def load_events(
    events: DataFrame,
    events_path: str,
    store: SummaryStore,
    batch_id: str,
    discard: bool = False,
    **extras,
) -> bool:
    """The same from a parsed event table, which may come from elsewhere.

    Rows that break a constraint of their table are stored as rejected, reported by the rule and not folded.
    The stored events are read once, for the cube that all folds and the report counts are read off; the cube
    lies in the store until the batch is committed, and a retry writes it anew.
    """
    if store.is_committed(batch_id):
        return False
    spark = store.spark
    path = tables.batch_folder(events_path, batch_id)
    tables.write_events(routed(events), path, mode="overwrite")
    cube_path = store.folder.at("cubes", batch_id)
    event_cube(tables.read_events(spark, path)).write.mode("overwrite").parquet(cube_path)
    fold_into(store, batch_id, cube_deltas(spark.read.parquet(cube_path), **extras))
    store.folder.remove("cubes", batch_id)
    if discard:
        Folder(spark, path).remove()
    return True
