"""The event cube: every fold reads it instead of the events, with the same rows."""

import pytest
from conftest import rows

from realmwatch.operators import cube as cubes
from realmwatch.plans import batch
from realmwatch.plans.store import SummaryStore
from realmwatch.sources import bridge, parser, tables

EXTRAS = dict(failures_too=True, triples=True, tickets=True, averages=True)


@pytest.fixture(scope="module")
def events(spark, log):
    # every event three times, so that the cube has something to count
    lines = bridge.broken_lines(log).select("value")
    return parser.parse_events(lines.unionAll(lines).unionAll(lines)).persist()


def test_folds_of_the_cube_equal_those_of_the_events(events):
    cube = cubes.event_cube(events)
    assert cube.count() <= events.count() / 3 and cube.agg({"n": "sum"}).first()[0] == events.count()
    plain = batch.summary_deltas(parser.successes(events), parser.failures(events), **EXTRAS)
    counted = batch.cube_deltas(cube, **EXTRAS)
    assert set(counted) == {*plain, "report_counts"}
    for name, delta in plain.items():
        if name == "client_average_data":  # sums of doubles, in another order
            near = [[round(v, 6) if isinstance(v, float) else v for v in r] for r in rows(delta)]
            assert [[round(v, 6) if isinstance(v, float) else v for v in r] for r in rows(counted[name])] == near
        else:
            assert rows(counted[name].select(*delta.columns)) == rows(delta), name
    reports = parser.rejects(events).groupBy("reason", "kept").count().collect()
    assert {tuple(r) for r in counted["report_counts"].collect()} == {tuple(r) for r in reports}


def test_a_load_reads_its_events_once(spark, events, tmp_path, monkeypatch):
    """The stored events are opened once, and what the folds read is the cube."""
    store, read, seen = SummaryStore(spark, str(tmp_path / "store")), [], {}
    plain_read, plain_fold = tables.read_events, batch.fold_into
    monkeypatch.setattr(tables, "read_events", lambda *a: read.append(a) or plain_read(*a))

    def fold(store, batch_id, deltas):
        for name, delta in deltas.items():
            seen[name] = {f.split("/store/")[-1].split("/")[0] for f in delta.inputFiles()}
        return plain_fold(store, batch_id, deltas)

    monkeypatch.setattr(batch, "fold_into", fold)
    assert batch.load_events(events, str(tmp_path / "events"), store, "load", **EXTRAS)
    assert len(read) == 1
    assert set(map(tuple, seen.values())) == {("cubes",)} and len(seen) == 9
    text = cubes.event_cube(events)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "partial_" in text
    assert not (tmp_path / "store" / "cubes" / "load").exists()


def test_rows_that_break_a_rule_are_stored_and_reported_but_not_folded(spark, log, tmp_path):
    parsed = parser.parse_events(bridge.raw_lines(log)).drop("event_id")
    broken = parsed.selectExpr(
        *[c for c in parsed.columns if c != "kdc"], "CASE WHEN ip LIKE '10.0.1.%' THEN NULL ELSE kdc END AS kdc"
    )
    store = SummaryStore(spark, str(tmp_path / "store"))
    assert batch.load_events(broken, str(tmp_path / "events"), store, "load")
    lost = parsed.where("ip LIKE '10.0.1.%'").count()
    assert lost > 0 and [tuple(r) for r in store.read("report_counts").collect()] == [("kdc is missing", 0, lost)]
    assert store.read("client").where("ip LIKE '10.0.1.%'").count() == 0
    loaded = tables.read_logs(spark, str(tmp_path / "events"))
    assert loaded.rejects.count() == lost
    assert loaded.rejects.where("line LIKE '% 10.0.1.%' AND reason = 'kdc is missing' AND kept = 0").count() == lost


def test_a_load_that_failed_writes_its_cube_anew(spark, events, tmp_path, monkeypatch):
    store = SummaryStore(spark, str(tmp_path / "store"))
    plain = SummaryStore.write_delta

    def fails(self, table, delta, batch_id):
        if table == "princ":
            raise OSError("disk")
        plain(self, table, delta, batch_id)

    monkeypatch.setattr(SummaryStore, "write_delta", fails)
    with pytest.raises(OSError):
        batch.load_events(events, str(tmp_path / "events"), store, "load")
    monkeypatch.setattr(SummaryStore, "write_delta", plain)
    assert store.read("client").count() == 0
    assert batch.load_events(events, str(tmp_path / "events"), store, "load")
    want = batch.summary_deltas(parser.successes(events), parser.failures(events))
    assert rows(store.read("princ")) == rows(want["princ"])
