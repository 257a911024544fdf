"""Streams end with the rows of the batch folds, whatever the order and the failures."""

import pytest
from conftest import SF_DIR, rows

from realmwatch.operators import slices
from realmwatch.plans import catalog
from realmwatch.plans.batch import summary_deltas
from realmwatch.plans.store import SummaryStore
from realmwatch.sources import bridge, logs, tables
from realmwatch.sources.growing import scan_growing
from realmwatch.sources.parser import parse_events, rejects
from realmwatch.streaming import incremental


@pytest.fixture(scope="module")
def folder(log, tmp_path_factory):
    """Rendered lines in six files, the newest events first."""
    path = str(tmp_path_factory.mktemp("lines"))
    lines = log.orderBy("ts", ascending=False).selectExpr(f"{bridge.line_text()} AS value").collect()
    size = len(lines) // 6 + 1
    for i in range(6):
        with open(f"{path}/{i}.log", "w") as out:
            out.write("\n".join(r.value for r in lines[i * size : (i + 1) * size]) + "\n")
    return path


@pytest.fixture(scope="module")
def want(success, failure):
    return {n: rows(d) for n, d in summary_deltas(success, failure).items()}


def run(spark, folder, store, tmp_path, **options):
    lines = logs.scan_stream(spark, folder, max_files=2)
    query = incremental.run_incremental(lines, store, str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    assert query.exception() is None


def contents(store, names):
    return {n: rows(store.read(n)) for n in names}


def test_stream_equals_batch_and_resumes(spark, folder, want, tmp_path):
    store = SummaryStore(spark, str(tmp_path / "store"))
    run(spark, folder, store, tmp_path)
    assert len(store.snapshot().batches) == 3
    assert contents(store, want) == want
    run(spark, folder, store, tmp_path)
    assert contents(store, want) == want


def test_replayed_batches_count_once(spark, folder, want, tmp_path):
    """A lost checkpoint replays everything; under its name the store knows the batches already."""
    store = SummaryStore(spark, str(tmp_path / "store"))
    run(spark, folder, store, tmp_path, name="live")
    run(spark, folder, store, tmp_path / "again", name="live")
    assert contents(store, want) == want


def test_failure_between_writes_is_repaired(spark, folder, want, tmp_path, monkeypatch):
    store = SummaryStore(spark, str(tmp_path / "store"))
    commit, failed = SummaryStore.commit, []

    def flaky(self, batch_id):
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("lost before the commit")
        commit(self, batch_id)

    monkeypatch.setattr(SummaryStore, "commit", flaky)
    with pytest.raises(Exception, match="lost before the commit"):
        run(spark, folder, store, tmp_path)
    assert all(not found for found in contents(store, want).values())
    run(spark, folder, store, tmp_path)
    assert contents(store, want) == want


def test_compaction_and_retention_on_the_way(spark, folder, want, success, tmp_path):
    store = SummaryStore(spark, str(tmp_path / "store"))
    newest = success.agg({"log_time": "max"}).first()[0] // 86400 * 86400 + 86399
    run(spark, folder, store, tmp_path, compact_every=2, days=10, as_of=newest)
    assert store.snapshot().version is not None
    assert rows(store.read("princ")) == want["princ"]
    pruned = slices.prune(slices.client_slices(success), 10, newest)
    assert rows(store.read("client_slice_data", days=10, as_of=newest)) == rows(pruned)


def test_stream_parse(spark, folder, success, tmp_path):
    path = str(tmp_path / "events")
    incremental.parse_stream(logs.scan_stream(spark, folder), path, str(tmp_path / "cp")).awaitTermination()
    assert rows(tables.read_logs(spark, path).success) == rows(success.drop("event_id", "ts"))


def test_native_slices_emit_closed_days(spark, success, tmp_path):
    """Watermarked slices: every day that closed is emitted once, with its full counts."""
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    success.drop("event_id", "ts").repartitionByRange(4, "log_time").sortWithinPartitions("log_time").write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    sliced = incremental.native_client_slices(stream, days=2)
    query = (
        sliced.writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    newest = success.agg({"log_time": "max"}).first()[0]
    whole = slices.client_slices(success).where(f"endtime + 1 <= {newest} - 2 * 86400")
    assert rows(spark.read.parquet(out)) == rows(whole) != []


def test_reports_are_written_by_batch(spark, log, tmp_path):
    bridge.broken_lines(log).select("value").write.text(str(tmp_path / "lines"))
    store, reports = SummaryStore(spark, str(tmp_path / "store")), str(tmp_path / "reports")
    run(spark, str(tmp_path / "lines"), store, tmp_path, rejects_path=reports)
    got = spark.read.parquet(reports).select("line", "reason", "kept")
    assert rows(got) == rows(rejects(parse_events(bridge.broken_lines(log)))) != []


def test_retention_follows_the_clock_by_default(spark, folder, tmp_path):
    """All test events are years old."""
    store = SummaryStore(spark, str(tmp_path / "store"))
    run(spark, folder, store, tmp_path, compact_every=3, days=10)
    assert store.read("client_slice_data").count() == 0 < store.read("client").count()


def test_staged_batches_are_folded_together(spark, folder, want, tmp_path, monkeypatch):
    """Three batches, two folds; a crash before, in or after a fold loses nothing and counts nothing twice."""
    store, folds, settle = SummaryStore(spark, str(tmp_path / "store")), [], SummaryStore.settle
    fold_into = incremental.fold_into

    def fold(store, fold, deltas):
        folds.append(fold)
        if len(folds) == 1:
            store.write_delta("client", deltas["client"], fold)
            raise RuntimeError("crash in the fold")
        return fold_into(store, fold, deltas)

    monkeypatch.setattr(incremental, "fold_into", fold)
    monkeypatch.setattr(SummaryStore, "settle", lambda *_: (_ for _ in ()).throw(RuntimeError("crash before it is settled")))
    for _ in range(2):
        with pytest.raises(Exception, match="crash"):
            run(spark, folder, store, tmp_path, name="staged", fold_every=2)
            incremental.fold_staged(store, "staged")
    monkeypatch.setattr(SummaryStore, "settle", settle)
    run(spark, folder, store, tmp_path, name="staged", fold_every=2)
    incremental.fold_staged(store, "staged")
    assert contents(store, want) == want
    run(spark, folder, store, tmp_path / "again", name="staged", fold_every=2)  # a lost checkpoint
    incremental.fold_staged(store, "staged")
    assert contents(store, want) == want and not store.folder.names("staged") and not store.folder.names("groups")
    store.compact()
    store.vacuum()
    assert contents(store, want) == want and store.is_taken("staged-0000000000")
    assert len(folds) <= 4


def test_growing_query_folds_its_batches_together(spark, monkeypatch):
    """Eleven batches of lines, one fold for each run of the stream."""
    folds, fold_into = [], incremental.fold_into
    monkeypatch.setattr(incremental, "fold_into", lambda *a: folds.append(a[1]) or fold_into(*a))
    monkeypatch.setattr(catalog, "LINES_PER_BATCH", 100)
    got = rows(catalog.stream_growing_file(spark, SF_DIR))
    assert got == rows(catalog.stream_client_slices(spark, SF_DIR)) and len([f for f in folds if "-of-" in f]) == 3


def test_growing_query_reads_waiting_batches_side_by_side(spark, monkeypatch):
    """The batches of a run lie in folders of their own, of at most a hundred lines, and take one micro-batch."""
    staged, read_staged = [], SummaryStore.read_staged

    def read(self, batches, schema):
        staged.append([read_staged(self, [b], schema).count() for b in batches])
        return read_staged(self, batches, schema)

    monkeypatch.setattr(SummaryStore, "read_staged", read)
    monkeypatch.setattr(catalog, "LINES_PER_BATCH", 100)
    stages, stage = [], SummaryStore.stage
    monkeypatch.setattr(SummaryStore, "stage", lambda self, events, b: stages.append(b) or stage(self, events, b))
    lines = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    assert rows(catalog.stream_growing_file(spark, SF_DIR)) == rows(catalog.stream_client_slices(spark, SF_DIR))
    assert len(stages) == len(staged) == 3
    assert max(map(max, staged)) == 100 and sum(map(sum, staged)) == lines
    assert sum(map(len, staged)) == sum(-(-sum(run) // 100) for run in staged) > 3


def test_batches_staged_together_survive_crashes(spark, folder, want, tmp_path, monkeypatch):
    """Folds of two batches, which come three and three; a crash in the marking, a fold or the settling costs nothing."""
    store, lines = SummaryStore(spark, str(tmp_path / "store")), 1 + len(open(f"{folder}/0.log").readlines()) * 6 // 7
    crashes = []

    def crash_once(owner, name):
        inner = getattr(owner, name)

        def flaky(*args):
            if name not in crashes:
                crashes.append(name)
                raise RuntimeError(f"crash at {name}")
            return inner(*args)

        monkeypatch.setattr(owner, name, flaky)

    def start(checkpoint="checkpoint"):
        query = incremental.run_incremental(
            scan_growing(spark, folder, lines_per_batch=lines, batches_per_trigger=3), store,
            str(tmp_path / checkpoint), name="growing", every="0 seconds", fold_every=2,
        )
        incremental.catch_up(query, store)

    crash_once(incremental, "fold_into")
    crash_once(SummaryStore, "settle")
    crash_once(store.folder, "mark")
    for _ in range(3):
        with pytest.raises(Exception, match="crash"):
            start()
    start()
    assert sorted(crashes) == ["fold_into", "mark", "settle"]
    assert contents(store, want) == want
    assert sorted(n.rpartition("-of-")[2] for n in store.folder.names("deltas", "client")) == ["1", "2", "2", "2"]
    assert not store.folder.names("staged") and not store.folder.names("staged_rows") and not store.folder.names("groups")
    start("again")  # a lost checkpoint
    store.compact()
    store.vacuum()
    start("once more")
    assert contents(store, want) == want
