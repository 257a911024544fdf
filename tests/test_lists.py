"""List derivation against its definition, on worked and on random lists."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from realmwatch.functions import enctypes as en
from realmwatch.operators import lists

BY_TEXT = {str(e.enctype): e for e in en.SEED}


def expected(listing):
    """Members, prefix and flags of a list, straight from their definitions."""
    offered = listing.split(" ") if listing else []
    prefix = []
    for token in offered:
        if token not in BY_TEXT or token in prefix:
            break
        prefix.append(token)
    members = {t for t in offered if t in BY_TEXT}
    weak = [i for i, t in enumerate(prefix) if BY_TEXT[t].is_weak]
    strong = [i for i, t in enumerate(prefix) if not BY_TEXT[t].is_weak]
    return {
        "members": {
            (BY_TEXT[t].enctype, prefix.index(t) if t in prefix else None) for t in members
        },
        "names": ",".join(BY_TEXT[t].name for t in prefix) if prefix else None,
        "modern": int(any(BY_TEXT[t].is_modern for t in members)),
        "weak": int(any(BY_TEXT[t].is_weak for t in members)),
        "too_weak": int((weak or [0])[0] < (strong or [0])[0]),
    }


AES256, AES128 = "aes256-cts-hmac-sha1-96", "aes128-cts-hmac-sha1-96"
WORKED = {
    "18 17 16 23": ([(18, 0), (17, 1), (16, 2), (23, 3)], f"{AES256},{AES128},des3-cbc-sha1,arcfour-hmac", 1, 0, 0),
    "1 3 18": ([(1, 0), (3, 1), (18, 2)], f"des-cbc-crc,des-cbc-md5,{AES256}", 1, 1, 1),
    "3 1": ([(3, 0), (1, 1)], "des-cbc-md5,des-cbc-crc", 0, 1, 0),
    "18 1": ([(18, 0), (1, 1)], f"{AES256},des-cbc-crc", 1, 1, 0),
    "18 25 1": ([(18, 0), (1, None)], AES256, 1, 1, 0),
    "25 18": ([(18, None)], None, 1, 0, 0),
    "18 17 18 1": ([(18, 0), (17, 1), (1, None)], f"{AES256},{AES128}", 1, 1, 0),
    "-133 18": ([(-133, 0), (18, 1)], f"arcfour-hmac-old-exp,{AES256}", 1, 0, 0),
    "18 17 17 23": ([(18, 0), (17, 1), (23, None)], f"{AES256},{AES128}", 1, 0, 0),
    "99": ([], None, 0, 0, 0),
    "0": ([(0, 0)], "null", 0, 1, 0),
    "": ([], None, 0, 0, 0),
}


def random_lists(count, seed=7):
    rng = random.Random(seed)
    known = list(BY_TEXT)
    weak = [t for t, e in BY_TEXT.items() if e.is_weak]
    out = set()
    while len(out) < count:
        pool = rng.choice([known, weak, ["1", "3", "18", "25"], known + ["25", "99", "018", "-1"]])
        head = [rng.choice(weak) for _ in range(rng.randrange(4))]
        out.add(" ".join(head + [rng.choice(pool) for _ in range(rng.randrange(18))]))
    out |= {" ".join(weak + ["18"]), " ".join(weak + ["1", "18"]), " ".join(["1"] * 3000 + ["18"])}
    return sorted(out | set(WORKED))


@pytest.fixture(scope="module")
def sample(spark):
    listings = random_lists(2000)
    return spark.createDataFrame([(x, x) for x in listings], "enctype_list string, enctype_list_orig string")


def test_worked_examples_follow_the_definition():
    for listing, (members, names, modern, weak, too_weak) in WORKED.items():
        want = expected(listing)
        assert want["members"] == set(members), listing
        assert (want["names"], want["modern"], want["weak"], want["too_weak"]) == (names, modern, weak, too_weak)


def test_flags(sample):
    got = lists.list_flags(sample).collect()
    assert len(got) == sample.count()
    for r in got:
        want = expected(r.enctype_list)
        assert (r.enctype_name_list, r.modern_client, r.is_weak, r.is_too_weak) == (
            want["names"], want["modern"], want["weak"], want["too_weak"]
        ), r.enctype_list


def test_flags_computed_in_place(sample):
    text = F.col("enctype_list")
    got = sample.select(
        text, en.list_is_modern(text), en.list_is_weak(text), en.list_is_too_weak(text)
    ).collect()
    for listing, *flags in got:
        want = expected(listing)
        assert flags == [want["modern"], want["weak"], want["too_weak"]], listing


def test_sequence(sample):
    got = {}
    for r in lists.list_sequence(sample).collect():
        got.setdefault(r.enctype_list, set()).add((r.enctype_num, r.seq_num))
        tokens = r.enctype_list.split(" ")
        if r.seq_num is None:
            assert (r.partial_enctype_list, r.partial_enctype_name_list) == (None, None)
        else:
            prefix = tokens[: r.seq_num + 1]
            assert r.partial_enctype_list == " ".join(prefix)
            assert r.partial_enctype_name_list == ",".join(BY_TEXT[t].name for t in prefix)
    for (listing, _) in sample.collect():
        assert got.get(listing, set()) == expected(listing)["members"], listing


def test_members_are_the_sequence_without_order(sample, same):
    same(
        lists.list_members(sample),
        lists.list_sequence(sample).select("enctype_list", "enctype_list_orig", "enctype_num"),
    )


@pytest.mark.parametrize(
    "original, canonical",
    [("18 18 17", "18 17"), ("1 1 1", "1"), ("1 18 18", "1 18 18"), ("1 11", "1 11"), ("", ""), ("-5 -5 5", "-5 5")],
)
def test_canonical(spark, original, canonical):
    df = spark.createDataFrame([(original,)], "x string")
    assert df.select(en.canonical_list(F.col("x"))).first()[0] == canonical


def test_discovery_compares_both_texts(spark):
    columns = "req_enctypes string, req_enctypes_orig string"
    won = spark.createDataFrame([("18 17", "18 18 17"), ("18 17", "18 17"), ("3", "3")], columns)
    lost = spark.createDataFrame([("3", "3"), ("1", "1")], columns)
    known = spark.createDataFrame([("18 17", "18 17"), ("1", "1")], "enctype_list string, enctype_list_orig string")
    assert rows(lists.discover_lists(won, lost, known)) == [("18 17", "18 18 17"), ("3", "3")]
    assert lists.discover_lists(won, lost).count() == 4


def test_reference_data(spark):
    dim = en.enctype_dim(spark)
    assert dim.count() == 30 and dim.select("name").distinct().count() == 30
    assert dim.where("is_weak = 1").count() == 14
    assert {r.enctype for r in dim.where("is_modern = 1").collect()} == {17, 18}
    extra = spark.createDataFrame([(18, "other", 0, 1), (25, "camellia", 1, 0)], dim.schema)
    extended = en.extend_enctypes(dim, extra)
    assert extended.count() == 31
    assert extended.where("enctype = 18").first().name == AES256


def test_extended_reference_data_changes_the_derivation(spark):
    dim = en.enctype_dim(spark)
    extended = en.extend_enctypes(dim, spark.createDataFrame([(25, "camellia", 1, 0)], dim.schema))
    sample = spark.createDataFrame([("18 25 1", "18 25 1")], "enctype_list string, enctype_list_orig string")
    row = lists.list_flags(sample, extended).first()
    assert row.enctype_name_list == f"{AES256},camellia,des-cbc-crc"
