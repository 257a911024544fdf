"""State that Spark keeps itself: closed windows, and principals that changed."""

import pytest
from conftest import rows

from realmwatch.operators import last_seen, slices
from realmwatch.plans.store import SummaryStore
from realmwatch.schemas import CLIENT_SLICES
from realmwatch.sources import bridge, logs
from realmwatch.streaming.incremental import dropped_rows, run_native_princ, run_native_slices


@pytest.fixture
def feed(spark, tmp_path):
    """Add a file of lines, and give the stream of all of them."""

    def add(number, log):
        bridge.raw_lines(log).select("value").write.text(str(tmp_path / "lines" / f"part={number}"))
        return logs.scan_stream(spark, str(tmp_path / "lines")).select("value")

    return add


def test_days_are_written_once_closed_and_late_rows_counted(spark, log, success, feed, tmp_path):
    def run(lines):
        query = run_native_slices(lines, str(tmp_path / "out"), str(tmp_path / "checkpoint"), days=3)
        query.awaitTermination()
        return dropped_rows(query)

    want = slices.client_slices(success)
    older, newer = bridge.older(log), bridge.newer(log)
    early = success.where("ts < TIMESTAMP_NTZ'2024-01-16 00:00:00'").agg({"log_time": "max"}).first()[0]
    assert run(feed(0, older)) == 0
    written = spark.read.schema(CLIENT_SLICES).parquet(str(tmp_path / "out"))
    assert rows(written) == rows(want.where(f"endtime + 1 <= {early} - 3 * 86400"))
    assert run(feed(1, newer)) == 0
    latest = success.agg({"log_time": "max"}).first()[0]
    closed = rows(want.where(f"endtime + 1 <= {latest} - 3 * 86400"))
    spark.catalog.refreshByPath(str(tmp_path / "out"))
    assert rows(spark.read.schema(CLIENT_SLICES).parquet(str(tmp_path / "out"))) == closed
    # the same lines again: their days are closed, so they are counted and change nothing
    late = run(feed(2, older))
    assert 0 < late <= older.count()
    assert rows(spark.read.schema(CLIENT_SLICES).parquet(str(tmp_path / "out"))) == closed
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_only_principals_that_changed_reach_the_store(spark, log, success, failure, feed, tmp_path):
    store = SummaryStore(spark, str(tmp_path / "store"))

    def run(lines):
        known = set(store.snapshot().batches)
        run_native_princ(lines, store, str(tmp_path / "checkpoint"), name="princ").awaitTermination()
        fresh = sorted(set(store.snapshot().batches) - known)
        return [spark.read.parquet(store.folder.at("deltas", "princ", f"batch_id={b}")) for b in fresh]

    (first,) = run(feed(0, bridge.newer(log)))
    older = bridge.older(log)
    second = [r.name for d in run(feed(1, older)) for r in d.select("name").collect()]
    assert rows(store.read("princ")) == rows(last_seen.princ_last_seen(success, failure))
    # older lines can only bring what was never seen before
    newer = {r.name: r for r in first.collect()}
    whole = {r.name: r for r in store.read("princ").collect()}
    assert sorted(second) == sorted(n for n in whole if newer.get(n) != whole[n])
    assert len(second) < len(whole)
    # lines that say nothing new hand over nothing
    assert [d.count() for d in run(feed(2, older))] == [0]


def test_the_changes_of_a_batch_take_one_scan(spark, log):
    from realmwatch.operators.last_seen import party_rows
    from realmwatch.sources.parser import parse_events

    text = party_rows(parse_events(bridge.raw_lines(log)))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text
