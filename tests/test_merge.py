"""Merge laws, and the summary store's batches, compaction and retention."""

import pytest
from conftest import rows

from realmwatch.operators import last_seen, slices
from realmwatch.operators.merge import upsert
from realmwatch.plans.batch import fold_into, summary_deltas
from realmwatch.plans.store import TABLES, SummaryStore
from realmwatch.sources import bridge

AS_OF = 1706659200


# reports are counted from lines, averages are sums of doubles (test_findings)
FOLDS = [n for n in TABLES if n not in ("report_counts", "client_average_data")]


def halves(table):
    return bridge.older(table), bridge.newer(table)


@pytest.fixture(scope="module")
def batches(success, failure):
    (wa, wb), (la, lb) = halves(success), halves(failure)
    return {"a": summary_deltas(wa, la, True, True), "b": summary_deltas(wb, lb, True, True)}


@pytest.fixture(scope="module")
def whole(success, failure):
    deltas = summary_deltas(success, failure, True, True)
    return {n: rows(merged(n, deltas[n])) for n in FOLDS}


def merged(name, delta):
    """A delta may hold a key twice (success and failure slices); reading merges it."""
    table = TABLES[name]
    return upsert(delta, delta.limit(0), table.keys, table.how)


@pytest.mark.parametrize("name", FOLDS)
def test_fold_of_all_is_the_merge_of_folds_in_any_order(batches, whole, name):
    table, a, b = TABLES[name], batches["a"][name], batches["b"][name]
    assert rows(upsert(a, b, table.keys, table.how)) == whole[name]
    assert rows(upsert(b, a, table.keys, table.how)) == whole[name]


def test_maxima_do_not_mind_repeats(batches):
    a = batches["a"]["client"]
    assert rows(upsert(a, a, ["ip"], "max")) == rows(a)


def test_untouched_keys_stay_and_nulls_become_zero(spark):
    state = spark.createDataFrame([("x", 5, None), ("y", 1, 2)], "k string, n bigint, m bigint")
    delta = spark.createDataFrame([("x", 3, None), ("z", None, 7)], "k string, n bigint, m bigint")
    assert rows(upsert(state, delta, ["k"], {"n": "sum", "m": "max"})) == [("x", 0, 8), ("y", 2, 1), ("z", 7, 0)]


@pytest.fixture()
def store(spark, tmp_path):
    return SummaryStore(spark, str(tmp_path / "store"))


def contents(store):
    return {n: rows(store.read(n)) for n in FOLDS}


def test_empty_store(store):
    assert all(not found for found in contents(store).values())


def test_store_life_cycle(store, batches, whole):
    assert fold_into(store, "b", batches["b"])
    assert fold_into(store, "a", batches["a"])
    assert contents(store) == whole
    # a batch loaded again changes nothing
    assert not fold_into(store, "a", batches["a"])
    assert contents(store) == whole
    store.compact()
    assert store.snapshot().batches == [] and contents(store) == whole
    assert not fold_into(store, "b", batches["b"])
    store.vacuum()
    assert contents(store) == whole
    # a covered batch stays known after its files are gone
    assert not fold_into(store, "a", batches["a"])
    store.compact()
    store.vacuum()
    assert contents(store) == whole and store.is_committed("a")


def test_uncommitted_batch_is_invisible_and_rewritten(store, batches, whole):
    fold_into(store, "a", batches["a"])
    before = contents(store)
    store.write_delta("client", batches["a"]["client"], "b")
    store.write_delta("client_slice_data", batches["a"]["client_slice_data"], "b")
    assert contents(store) == before
    fold_into(store, "b", batches["b"])
    assert contents(store) == whole


def test_snapshot_outlives_compaction(store, batches):
    fold_into(store, "a", batches["a"])
    seen = store.snapshot()
    held = store.read("client", at=seen)
    before = rows(held)
    fold_into(store, "b", batches["b"])
    store.compact()
    assert rows(held) == before


def test_retention(store, batches, whole):
    for name in ("a", "b"):
        fold_into(store, name, batches[name])
    names = sorted(store.read("client_slice_data").columns)
    start = names.index("starttime")
    kept = [r for r in whole["client_slice_data"] if r[start] >= AS_OF - 10 * 86400]
    pruned = store.read("client_slice_data", days=10, as_of=AS_OF)
    assert rows(pruned) == kept and 0 < len(kept) < len(whole["client_slice_data"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    store.compact(days=10, as_of=AS_OF)
    assert rows(store.read("client_slice_data")) == kept
    assert rows(store.read("client")) == whole["client"]
    with pytest.raises(ValueError):
        store.read("client_slice_data", days=10)


def test_prune_bounds(spark):
    day = 86400
    df = spark.createDataFrame([(AS_OF - 2 * day,), (AS_OF - 2 * day - 1,), (AS_OF,)], "starttime bigint")
    assert slices.prune(df, 2, AS_OF).count() == 2
    assert slices.prune(df, None, AS_OF).count() == 3


def test_rates(spark, success):
    rated = slices.slice_rates(slices.client_slices(success)).collect()
    for r in rated:
        assert r.weak_as_rate == r.nweak_as / r.nentries
        assert r.modern_tgs_rate == r.nmodern_tgs / r.nentries
    princ = slices.princ_request_rates(slices.princ_slices(success))
    assert princ.where("ticket_strong_rate IS NOT NULL").count() == 0
    assert princ.where("req_got_strong_rate <> nreq_got_strong / nentries").count() == 0


def test_last_fail_delta_leaves_the_rest_alone(success, failure):
    seen = last_seen.client_last_seen(success)
    both = upsert(seen, last_seen.client_last_fail(failure), ["ip"], "max")
    assert rows(both.drop("last_fail")) == rows(seen.drop("last_fail"))
    assert both.where("last_fail > 0").count() > 0


def test_only_one_of_two_compactions_counts(spark, store, batches, whole):
    """The slower one starts first, from an older snapshot; its build is discarded."""
    fold_into(store, "a", batches["a"])
    store.compact()
    slow = SummaryStore(spark, store.folder.root)
    read = slow.read

    def read_late(name, *args, **kwargs):
        if name == "client":  # meanwhile the other one folds, compacts and vacuums
            fold_into(store, "b", batches["b"])
            assert store.compact() is not None
            store.vacuum()
        return read(name, *args, **kwargs)

    held = store.snapshot()
    slow.read = read_late
    try:
        late = slow.compact()
    except Exception:  # its inputs were vacuumed under it, as the rule for vacuum() allows
        late = None
    assert late is None
    assert contents(store) == whole and store.snapshot().version != held.version


def test_claims_are_exclusive(store):
    assert store.folder.claim("first", "versions", "1")
    assert not store.folder.claim("second", "versions", "1")
    assert store.folder.text("versions", "1") == "first"


def test_failures_and_tickets_change_no_other_rate(success, failure):
    plain = slices.slice_rates(summary_deltas(success, failure)["princ_slice_data"])
    table = TABLES["princ_slice_data"]
    full = summary_deltas(success, failure, failures_too=True, tickets=True)["princ_slice_data"]
    full = slices.slice_rates(upsert(full, full.limit(0), table.keys, table.how))
    names = ["name", "starttime", *[c for c in plain.columns if c.startswith("req_")]]
    both = full.select(names).join(plain.select("name", "starttime"), ["name", "starttime"])
    assert rows(both) == rows(plain.select(names))
    assert full.where("nticket_issue > 0 AND ticket_issue_rate IS NULL").count() == 0


def test_a_claim_that_was_never_filled_hides_nothing(spark, store, batches, whole):
    """A writer that dies between creating a marker and naming its build there."""
    for name in "ab":
        fold_into(store, name, batches[name])
    store.compact()
    store.folder.mark("versions", "0000000002")
    assert contents(store) == whole
    store.vacuum()
    assert contents(store) == whole
    assert store.compact() is not None
    store.vacuum()
    assert contents(store) == whole
    assert store.folder.names("versions") == ["0000000003"]


def test_views_are_of_one_snapshot(spark, store, batches, monkeypatch):
    """A batch committed while views are made is in none of them."""
    from realmwatch import attach

    fold_into(store, "a", batches["a"])
    before = contents(store)
    read = SummaryStore.read

    def read_late(self, name, *args, **options):
        fold_into(store, "b", batches["b"])
        return read(self, name, *args, **options)

    monkeypatch.setattr(SummaryStore, "read", read_late)
    attach(spark, store)
    monkeypatch.setattr(SummaryStore, "read", read)
    assert {n: rows(spark.table(n)) for n in FOLDS} == before
