"""References, decayed averages, slopes, failure templates and SQL functions on small fixtures."""

import pytest
from conftest import SF_DIR, rows

from realmwatch import attach, enctype_dim, extend_enctypes
from realmwatch.operators import audit, trends
from realmwatch.operators.failures import failure_templates
from realmwatch.operators.merge import upsert
from realmwatch.operators.slices import client_slices
from realmwatch.plans.catalog import QUERIES
from realmwatch.plans.store import TABLES, SummaryStore
from realmwatch.schemas import CLIENT_COUNTS, CLIENT_SLICES, DAY_SECONDS
from realmwatch.sources import bridge

KEYS = ["ip", "is_success"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_reference_is_broken_and_all_take_one_shuffle(spark):
    found = QUERIES["audit_references"](spark, SF_DIR)
    assert plan(found).count("Exchange hashpartitioning(parent") == 1
    told = {(r.child, r["columns"], r.parent) for r in found.collect()}
    assert told == {(r.child, ",".join(r.columns), r.parent) for r in audit.REFERENCES}


def test_references_with_nulls_and_whole_parents(spark):
    child = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "x")], "u string, v string")
    parent = spark.createDataFrame([("a", "x"), ("c", "y")], "p string, q string")
    both = audit.Reference("child", ("u", "v"), "parent", ("p", "q"))
    one = audit.Reference("child", ("v",), "parent", ("q",))
    got = audit.broken_references({"child": child, "parent": parent}, [both, one])
    assert [tuple(r) for r in got.collect()] == [("child", "u,v", "parent", "b|y", 1)]


def test_decayed_averages_do_not_depend_on_the_order_of_batches(spark, success):
    table = TABLES["client_average_data"]
    a, b = (trends.decayed_counts(client_slices(h), KEYS) for h in (bridge.older(success), bridge.newer(success)))
    whole = trends.decayed_averages(trends.decayed_counts(client_slices(success), KEYS), KEYS)

    def told(df):
        return [[round(v, 9) if isinstance(v, float) else v for v in r] for r in rows(df)]

    for first, second in ((a, b), (b, a)):
        kept = upsert(first, second, table.keys, table.how)
        assert told(trends.decayed_averages(kept, KEYS)) == told(whole)


def test_decay_by_half_lives_over_many_years(spark):
    week = trends.HALF_LIFE
    slices = [(0, 4, 4), (week, 4, 0), (week * 1040, 2, 1)]
    table = spark.createDataFrame(
        [("a", start, start + DAY_SECONDS - 1, n, 1, *[weak] * len(CLIENT_COUNTS)) for start, n, weak in slices], CLIENT_SLICES
    )
    early = trends.decayed_averages(trends.decayed_counts(table.where(f"starttime <= {week}"), KEYS), KEYS).first()
    assert early.weight == 6 and early.weak_as_decayed_avg == pytest.approx(1 / 3)
    late = trends.decayed_averages(trends.decayed_counts(table, KEYS), KEYS).first()
    assert late.weight == pytest.approx(2) and late.weak_as_decayed_avg == pytest.approx(0.5)


def test_slopes(spark):
    rated = spark.createDataFrame(
        [("up", d * DAY_SECONDS, 0.1 * d) for d in (1, 2, 5)] + [("one", 0, 0.5)] + [("gap", 0, None), ("gap", DAY_SECONDS, 0.2)],
        "ip string, starttime long, weak_rate double",
    )
    got = {r.ip: (r.nslices, r.weak_slope) for r in trends.trend_slopes(rated, ["ip"]).collect()}
    assert got["one"] == (1, None) and got["gap"] == (2, None)
    assert got["up"] == (3, pytest.approx(0.1))


def test_templates(spark):
    reasons = (
        [f"cannot reach kdc{k}.example.com in time" for k in range(9)]
        + [f"cannot open /etc/file{k} (error {k})" for k in range(9)]
        + ["cannot reach anyone at all today", "", "   ", None, "no such user 'joe@EXAMPLE.COM'", "peer [fe80::1], port 88 refused"]
        + [f"the fifth word here is{k} free" for k in range(9)]
    )
    rows_in = [(DAY_SECONDS * (1 + k % 2) + k, f"C{k % 2}", r) for k, r in enumerate(reasons)] * 2
    failure = spark.createDataFrame(rows_in, "log_time long, code string, reason string")
    got = failure_templates(failure, most=3)
    told = {}
    for r in got.collect():
        told[r.template] = told.get(r.template, 0) + r.nfail
    assert told == {
        "cannot reach <*> in time": 18, "cannot open <path> (error <number>)": 18, "cannot reach anyone at all today": 2,
        "": 6, "no such user '<principal>'": 2, "peer <address>, port <number> refused": 2, "the fifth word here <*> free": 18,
    }
    assert sum(told.values()) == len(rows_in)
    assert {r.starttime % DAY_SECONDS for r in got.collect()} == {0}
    every = failure_templates(failure, depth=0, most=1)
    assert every.agg({"nfail": "sum"}).first()[0] == len(rows_in)
    assert failure_templates(failure.where("false")).count() == 0
    with pytest.raises(ValueError):
        failure_templates(failure, most=0)


def test_sql_functions_follow_the_site(spark, tmp_path):
    store = SummaryStore(spark, str(tmp_path / "store"))
    own = spark.sql("SELECT 99 AS enctype, 'site-99' AS name, 1 AS is_modern, 1 AS is_weak")
    try:
        attach(spark, store, enctypes=extend_enctypes(enctype_dim(spark), own))
        text = "SELECT list_is_weak('18 99'), list_is_modern('99'), enctype_is_weak(99), canonical_list('18 18 17'), list_is_too_weak('1 18')"
        assert tuple(spark.sql(text).first()) == (1, 1, 1, "18 17", 1)
    finally:
        attach(spark, store)
    assert tuple(spark.sql(text).first()) == (0, 0, None, "18 17", 1)
    assert spark.sql("SELECT day_start(86401L), principal_host('host/a.b@R'), principal_host('u@R')").first() == (86400, "a.b", None)


def test_forwarding_takes_one_scan_and_two_exchanges(spark):
    text = plan(QUERIES["forwarded_tgt"](spark, SF_DIR))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2 and "Join" not in text
