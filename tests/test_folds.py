"""Folds against a plain-Python fold of a small fixture with every awkward kind of row."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_lists import expected

from realmwatch import schemas as s
from realmwatch.functions import enctypes as en
from realmwatch.operators import audit, joins, last_seen, slices
from realmwatch.operators import lists as ls

WEAK = {e.enctype: e.is_weak for e in en.SEED}
LISTS = ["18 17", "1 3 18", "3 1", "18 25 1", "25 18", "0", "99", "1 18 1", "23"]
START = 1704067200


def make(n=400, seed=3):
    rng = random.Random(seed)
    won, lost = [], []
    for _ in range(n):
        t = START + rng.randrange(3 * 86400)
        listing = rng.choice(LISTS)
        ip = "10.0.0.1" if rng.random() < 0.4 else f"10.0.0.{rng.randrange(2, 6)}"
        client, server = f"u{rng.randrange(4)}", rng.choice(["krbtgt/A", "host/a", "u1"])
        if rng.random() < 0.7:
            keys = [rng.choice([18, 17, 1, 3, 23, 99, 77]) for _ in range(3)]
            won.append((t, "kdc", ip, rng.randrange(2), listing, listing, t - 5, client, server, *keys))
        else:
            names = (rng.choice([client, None]), rng.choice([server, None]))
            lost.append((t, "kdc", ip, rng.randrange(2), "X", listing, listing, *names, "why"))
    return won, lost


@pytest.fixture(scope="module")
def made():
    won, lost = make()
    return [dict(zip(s.SUCCESS.names, r)) for r in won], [dict(zip(s.FAILURE.names, r)) for r in lost]


@pytest.fixture(scope="module")
def tables(spark):
    won, lost = make()
    return spark.createDataFrame(won, s.SUCCESS), spark.createDataFrame(lost, s.FAILURE)


@pytest.fixture(scope="module")
def dims(spark, tables):
    return ls.list_flags(ls.discover_lists(*tables)), en.enctype_dim(spark)


def offers(r):
    f = expected(r["req_enctypes"])
    return {"had_weak": f["weak"], "had_weakfirst": f["too_weak"], "had_strong": f["modern"], "had_strongonly": 1 - f["weak"]}


def weak(r, role):
    return WEAK.get(r[f"{role}_enctype"])


def gets(r):
    se, re = weak(r, "session"), weak(r, "reply")
    return {
        "got_weaksesskey": se, "got_weakreply": re, "got_strongsesskey": 1 - se,
        "got_strongreply": 1 - re, "got_strong": (1 - se) * (1 - re),
    }


def tickets(r):
    se, te = weak(r, "session"), weak(r, "ticket")
    return {
        "weaksesskey": se, "weakticketkey": te, "strongsesskey": 1 - se, "strongticketkey": 1 - te,
        "strong": (1 - se) * (1 - te),
    }


def raise_to(row, name, time, when=True):
    if when:
        row[name] = max(row[name], time)


def as_dict(df, keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def check(df, keys, want):
    got = as_dict(df, keys)
    assert set(got) == set(want)
    for key, row in want.items():
        for name, value in row.items():
            assert got[key][name] == value, (key, name)


def test_client_last_seen(made, tables):
    want = defaultdict(lambda: dict.fromkeys(s.CLIENT_MEASURES, 0))
    for r in made[0]:
        row, kind = want[(r["ip"],)], ("tgs" if r["req_type"] else "as")
        raise_to(row, "last_success", r["log_time"])
        strength = "weak" if offers(r)["had_weak"] else "strong"
        raise_to(row, f"last_{strength}_{kind}", r["log_time"])
    check(last_seen.client_last_seen(tables[0]), ["ip"], want)


def princ_want(made):
    want = defaultdict(lambda: {"host": None, **dict.fromkeys(s.PRINC_MEASURES, 0)})
    for r in made[0]:
        t = r["log_time"]
        if None not in (weak(r, "reply"), weak(r, "session")):
            row = want[(r["client_name"],)]
            raise_to(row, "last_used", t)
            raise_to(row, "lc_auth", r["authtime"])
            for k, hit in {**offers(r), **gets(r)}.items():
                raise_to(row, f"lc_req_{k}", t, hit)
        if None not in (weak(r, "session"), weak(r, "ticket")):
            row = want[(r["server_name"],)]
            raise_to(row, "last_used", t)
            raise_to(row, "ls_ticket_issue", t)
            for k, hit in tickets(r).items():
                raise_to(row, f"ls_ticket_{k}", t, hit)
    for r in made[1]:
        t = r["log_time"]
        if r["client_name"]:
            row = want[(r["client_name"],)]
            raise_to(row, "lc_fail", t)
            for k, hit in offers(r).items():
                raise_to(row, f"lc_req_{k}", t, hit)
        if r["server_name"]:
            raise_to(want[(r["server_name"],)], "ls_ticket_fail", t)
    return want


def test_princ_last_seen(made, tables):
    check(last_seen.princ_last_seen(*tables), ["name"], princ_want(made))


def test_princ_folds_merge_to_the_combined_one(tables, same):
    from realmwatch.operators.merge import combine

    won, lost = tables
    folds = [
        last_seen.princ_client_success(won), last_seen.princ_server_success(won),
        last_seen.princ_client_fail(lost), last_seen.princ_server_fail(lost),
    ]
    deltas = [last_seen.princ_delta(f) for f in folds]
    union = deltas[0].unionByName(deltas[1]).unionByName(deltas[2]).unionByName(deltas[3])
    same(combine(union, ["name"], "max"), last_seen.princ_last_seen(won, lost))


def test_ccs(made, tables):
    seen = defaultdict(lambda: dict.fromkeys(s.CCS_MEASURES, 0))
    daily = defaultdict(lambda: {"nentries": 0, **dict.fromkeys(s.CCS_COUNTS, 0)})
    for r in made[0]:
        if weak(r, "session") is not None:
            key = (r["ip"], r["client_name"], r["server_name"])
            stem = "weak_sess_key" if weak(r, "session") else "strong_sess_key"
            raise_to(seen[key], f"last_{stem}", r["log_time"])
            row = daily[(*key, r["log_time"] // 86400 * 86400)]
            row["nentries"] += 1
            row[f"nlast_{stem}"] += 1
    check(last_seen.ccs_last_seen(tables[0]), ["ip", "cname", "sname"], seen)
    check(slices.ccs_slices(tables[0]), ["ip", "cname", "sname", "starttime"], daily)


def test_client_slices(made, tables):
    for side, flag in ((0, 1), (1, 0)):
        want = defaultdict(lambda: {"nentries": 0, "is_success": flag, **dict.fromkeys(s.CLIENT_COUNTS, 0)})
        for r in made[side]:
            day = r["log_time"] // 86400 * 86400
            row, kind = want[(r["ip"], day)], ("tgs" if r["req_type"] else "as")
            row["endtime"] = day + 86399
            row["nentries"] += 1
            row[f"nweak_{kind}"] += offers(r)["had_weak"]
            row[f"nstrong_{kind}"] += offers(r)["had_strongonly"]
            row[f"nmodern_{kind}"] += offers(r)["had_strong"]
        check(slices.client_slices(tables[side], is_success=flag), ["ip", "starttime"], want)


def test_princ_and_ticket_slices(made, tables):
    zero = lambda: {"nentries": 0, "nauth": 0, "nfail": 0, **dict.fromkeys(s.PRINC_REQ_COUNTS + s.PRINC_TICKET_COUNTS, 0)}
    clients, servers, fails = defaultdict(zero), defaultdict(zero), defaultdict(zero)
    for r in made[0]:
        day = r["log_time"] // 86400 * 86400
        if None not in (weak(r, "reply"), weak(r, "session")):
            row = clients[(r["client_name"], day)]
            row["nentries"] += 1
            row["nauth"] += 1 - r["req_type"]
            for k, hit in {**offers(r), **gets(r)}.items():
                row[f"nreq_{k}"] += hit
        if None not in (weak(r, "session"), weak(r, "ticket")):
            row = servers[(r["server_name"], day)]
            row["nentries"] += 1
            row["nticket_issue"] += 1
            for k, hit in tickets(r).items():
                row[f"nticket_{k}"] += hit
    for r in made[1]:
        day = r["log_time"] // 86400 * 86400
        if r["server_name"]:
            row = servers[(r["server_name"], day)]
            row["nentries"] += 1
            row["nticket_fail"] += 1
        if r["client_name"]:
            row = fails[(r["client_name"], day)]
            row["nentries"] += 1
            row["nfail"] += 1
    check(slices.princ_slices(tables[0]), ["name", "starttime"], clients)
    check(slices.ticket_slices(*tables), ["name", "starttime"], servers)
    check(slices.princ_fail_slices(tables[1]), ["name", "starttime"], fails)


def test_flags_by_join_give_the_same_folds(tables, dims, same):
    (won, lost), (lists, enctypes) = tables, dims
    same(last_seen.client_last_seen(won, lists), last_seen.client_last_seen(won))
    same(last_seen.princ_last_seen(won, lost, lists, enctypes), last_seen.princ_last_seen(won, lost))
    same(last_seen.ccs_last_seen(won, enctypes), last_seen.ccs_last_seen(won))
    same(slices.client_slices(won, lists), slices.client_slices(won))
    same(slices.princ_slices(won, lists, enctypes), slices.princ_slices(won))
    same(slices.ticket_slices(won, lost, enctypes), slices.ticket_slices(won, lost))


def test_role_join_drops_what_the_audit_reports(made, tables, spark):
    kept = joins.join_roles(tables[0], en.enctype_dim(spark)).count()
    known = [r for r in made[0] if None not in (weak(r, "reply"), weak(r, "session"), weak(r, "ticket"))]
    assert kept == len(known)
    want = defaultdict(int)
    for r in made[0]:
        for role in ("reply", "session", "ticket"):
            if weak(r, role) is None:
                want[(role, r[f"{role}_enctype"])] += 1
    got = {(r.role, r.enctype): r.nrows for r in audit.unknown_enctypes(tables[0]).collect()}
    assert got == dict(want)


def test_list_join_drops_unknown_lists(tables, dims):
    some = dims[0].where("enctype_list <> '18 17'")
    left = joins.join_lists(tables[0], some).count()
    assert left == tables[0].where("req_enctypes <> '18 17'").count()


def test_broadcast_only_when_small(dims):
    small = joins.broadcast_if_small(dims[0])
    assert small is not dims[0]
    assert joins.broadcast_if_small(dims[0], limit=10) is dims[0]


def test_orphans_and_duplicates(spark):
    child = spark.createDataFrame([("a", "x"), ("b", "y")], "ip string, cname string")
    parent = spark.createDataFrame([("x",)], "name string")
    assert [tuple(r) for r in audit.orphans(child, parent, {"cname": "name"}).select("ip", "cname").collect()] == [("b", "y")]
    twice = child.unionByName(child.limit(1))
    assert [r.copies for r in audit.duplicate_keys(twice, ["ip", "cname"]).collect()] == [2]


def test_row_constraints(spark, tables):
    won, lost = tables
    assert audit.invalid_rows(won).count() == 0 and audit.valid_rows(won).count() == won.count()
    # a failure may lack its names, and does in the fixture
    assert audit.valid_rows(lost, failed=True).count() == lost.count()
    bad = won.limit(3).selectExpr(
        *[c if c not in ("ip", "req_type") else f"CAST(NULL AS {t}) AS {c}" for c, t in won.dtypes]
    ).unionByName(won.limit(2).withColumn("req_type", F.lit(2)))
    problems = [r.problem for r in audit.invalid_rows(bad.unionByName(won)).collect()]
    assert sorted(problems) == ["ip is missing"] * 3 + ["req_type is unknown"] * 2
    assert audit.valid_rows(bad).count() == 0
    assert audit.invalid_rows(lost.withColumn("req_type", F.lit(None).cast("int")), failed=True).count() == 0
