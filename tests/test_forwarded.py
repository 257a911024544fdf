"""The forwarded-credential join against all pairs of a small, skewed fixture."""

import random
from collections import Counter

import pytest

from realmwatch.operators.joins import forwarded_tgt
from realmwatch.schemas import SUCCESS


def events(seed, n=300):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        hot = rng.random() < 0.4
        ip, client = ("nat", "robot") if hot else (f"ip{rng.randrange(3)}", f"u{rng.randrange(3)}")
        t = 1_000_000 + rng.choice([0, 1, 899, 900, 901, 1800, 2700]) + rng.randrange(3)
        server = rng.choice(["host/a", "host/b", "krbtgt/A", "KRBTGT/B", "xkrbtgt/C"])
        out.append((t, "k", ip, rng.randrange(2), rng.choice(["18", "17"]), "o", 900_000, client, server, 18, 18, 18))
    return out


def brute(rows, max_lag):
    pairs = Counter()
    for a in rows:
        for b in rows:
            lag = b[0] - a[0]
            if (
                (a[2], a[6], a[7]) == (b[2], b[6], b[7]) and a[3] == b[3] == 1 and 0 <= lag <= max_lag
                and b[8].lower().startswith("krbtgt") and a[4] != b[4] and a[8] != b[8]
            ):
                pairs[(a[2], a[6], a[7], a[8], b[8], lag)] += 1
    return pairs


@pytest.mark.parametrize("max_lag", [0, 1, 900])
def test_all_pairs(spark, max_lag):
    data = events(max_lag)
    got = forwarded_tgt(spark.createDataFrame(data, SUCCESS), max_lag).collect()
    assert {tuple(r)[:6]: r.npairs for r in got} == dict(brute(data, max_lag))
    assert len(got) == len({tuple(r)[:6] for r in got})


def test_one_hot_key_costs_its_seconds_not_its_rows(spark):
    """Half a million requests of one client in three seconds are a dozen rows to join."""
    n = 500_000
    hot = spark.range(n).selectExpr(
        "1000000L + id % 3 AS log_time", "'k' AS kdc", "'nat' AS ip", "1 AS req_type",
        "CAST(17 + id % 2 AS string) AS req_enctypes", "'o' AS req_enctypes_orig", "900000L AS authtime",
        "'robot' AS client_name", "IF(id % 5 = 0, 'krbtgt/A', 'host/a') AS server_name",
        "18 AS reply_enctype", "18 AS ticket_enctype", "18 AS session_enctype",
    )
    got = forwarded_tgt(hot).collect()
    counts = Counter((i % 3, 17 + i % 2, i % 5 == 0) for i in range(n))
    want = Counter()
    for (ta, la, ka), na in counts.items():
        for (tb, lb, kb), nb in counts.items():
            if kb and not ka and la != lb and tb >= ta:
                want[tb - ta] += na * nb
    assert {r.lag: r.npairs for r in got} == dict(want)
