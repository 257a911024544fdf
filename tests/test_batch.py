"""The whole batch workflow: log files to event tables, summaries and SQL views."""

import pytest
from conftest import rows

from realmwatch import enctype_dim, extend_enctypes, list_flags
from realmwatch import attach, client_slices, run_batch, scan_logs
from realmwatch.operators.joins import with_list_flags
from realmwatch.plans.batch import summary_deltas
from realmwatch.plans.store import SummaryStore
from realmwatch.sources import bridge, parser, tables


def test_load_fold_and_query(spark, log, success, failure, tmp_path):
    files = []
    for name, part in (("a", bridge.older(log)), ("b", bridge.newer(log))):
        files.append(str(tmp_path / f"{name}.log"))
        noisy = bridge.noisy_lines(part).where("value NOT LIKE '%AS_REQ (1 etypes {18})%'")
        noisy.write.text(files[-1])
    store = SummaryStore(spark, str(tmp_path / "store"))
    events = str(tmp_path / "events")
    assert run_batch(spark, files, events, store, "load-1")
    assert not run_batch(spark, files, events, store, "load-1")

    loaded = tables.read_logs(spark, events)
    assert rows(loaded.success) == rows(success.drop("event_id", "ts"))
    assert rows(loaded.failure) == rows(failure.drop("event_id", "ts"))
    assert loaded.rejects.where("line LIKE '%sshd%'").count() == log.count()

    attach(spark, store, loaded)
    deltas = summary_deltas(success, failure)
    assert rows(spark.table("client")) == rows(deltas["client"])
    got = spark.sql(
        """SELECT count(*) AS n FROM log_entry_success s JOIN client c ON s.ip = c.ip
           JOIN enctypes e ON s.session_enctype = e.enctype
           JOIN req_enctypes_lists l ON s.req_enctypes = l.enctype_list
            AND s.req_enctypes_orig = l.enctype_list_orig"""
    )
    assert got.first().n == success.count()


def test_events_can_be_discarded_once_folded(spark, log, success, tmp_path):
    bridge.raw_lines(log).select("value").write.text(str(tmp_path / "lines"))
    store, events = SummaryStore(spark, str(tmp_path / "store")), tmp_path / "events"
    run_batch(spark, str(tmp_path / "lines"), str(events), store, "load-1", discard=True)
    assert not (events / "batch_id=load-1").exists()
    assert rows(store.read("client_slice_data")) == rows(client_slices(success))


def test_day_filter_prunes_event_partitions(spark, log, tmp_path):
    path = str(tmp_path / "events")
    tables.write_events(parser.parse_events(bridge.raw_lines(log)), path)
    wanted = parser.successes(tables.read_events(spark, path).where("day = '2024-01-05'"))
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "day#" in scan.split("PartitionFilters")[1] and "outcome#" in scan.split("PartitionFilters")[1]
    assert wanted.count() == log.where("event_type <> 'error' AND CAST(ts AS date) = '2024-01-05'").count()


def test_provenance(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / f"{name}.log").write_text("line\n")
    paths = [str(tmp_path / f"{n}.log") for n in ("x", "y")]
    got = scan_logs(spark, paths, provenance=True)
    assert {r.log_file.rsplit("/", 1)[1] for r in got.collect()} == {"x.log", "y.log"}
    assert {r.log_file for r in parser.parse_events(got).select("log_file").collect()} == {
        r.log_file for r in got.collect()
    }


def test_loads_stand_side_by_side_and_can_be_retried(spark, log, success, tmp_path, monkeypatch):
    store, events = SummaryStore(spark, str(tmp_path / "store")), str(tmp_path / "events")
    for name, half in (("a", bridge.older), ("b", bridge.newer)):
        bridge.raw_lines(half(log)).select("value").write.text(str(tmp_path / name))
    assert run_batch(spark, str(tmp_path / "a"), events, store, "a")
    commit = store.commit

    def fail(batch_id):
        raise OSError("lost")

    monkeypatch.setattr(store, "commit", fail)
    with pytest.raises(OSError):
        run_batch(spark, str(tmp_path / "b"), events, store, "b")
    monkeypatch.setattr(store, "commit", commit)
    assert run_batch(spark, str(tmp_path / "b"), events, store, "b")
    assert rows(tables.read_logs(spark, events).success) == rows(success.drop("event_id", "ts"))
    assert rows(store.read("client_slice_data")) == rows(client_slices(success))
    assert store.read("report_counts").count() == 0


def test_other_daemons_can_be_left_out(spark, log, tmp_path):
    bridge.noisy_lines(log).write.text(str(tmp_path / "lines"))
    store, events = SummaryStore(spark, str(tmp_path / "store")), str(tmp_path / "events")
    run_batch(spark, str(tmp_path / "lines"), events, store, "a", kdc_only=True)
    assert tables.read_logs(spark, events).rejects.count() == 0


def test_own_enctypes_reach_every_table(spark, log, tmp_path):
    log = bridge.unknown_session_keys(log)
    success, failure = bridge.success_events(log), bridge.failure_events(log)
    own = spark.sql("SELECT 99 AS enctype, 'site' AS name, 0 AS is_modern, 1 AS is_weak")
    known = extend_enctypes(enctype_dim(spark), own)
    plain, site = summary_deltas(success, failure), summary_deltas(success, failure, enctypes=known)
    total = success.count()
    for deltas, want in ((plain, total - success.where("session_enctype = 99").count()), (site, total)):
        assert deltas["princ_slice_data"].agg({"nentries": "sum"}).first()[0] == want
    weak = spark.createDataFrame([("77",)], "req_enctypes string")
    site77 = extend_enctypes(known, spark.sql("SELECT 77 AS enctype, 'w' AS name, 0 AS is_modern, 1 AS is_weak"))
    assert with_list_flags(weak, enctypes=site77).first().list_weak == 1
    by_join = list_flags(weak.selectExpr("req_enctypes AS enctype_list", "req_enctypes AS enctype_list_orig"), site77)
    assert by_join.first().is_weak == 1
