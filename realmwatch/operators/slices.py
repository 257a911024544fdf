"""Daily slices: counts per key and UTC day, and the rates read off them.

Counts are sums, so slices of separate batches add up.  Rates are never stored: they are
divided out when a slice table is read, from the counts summed so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from realmwatch.functions.times import day_start
from realmwatch.operators import conditions as c
from realmwatch.operators.joins import Known, with_list_flags, with_role_flags
from realmwatch.schemas import (
    CCS_SLICES,
    CLIENT_SLICES,
    DAY_SECONDS,
    PRINC_REQ_COUNTS,
    PRINC_SLICES,
    PRINC_TICKET_COUNTS,
)

KEYS = {
    "client": ["ip", "starttime", "is_success"],
    "princ": ["name", "starttime"],
    "ccs": ["ip", "cname", "sname", "starttime"],
}


def _by_day(rows: DataFrame, keys: list[str], counts: dict[str, str]) -> DataFrame:
    """One row per key and day, bounded by the first and last second of the day."""
    named = {"nentries": f"sum({c.COUNT})", **counts}
    start = day_start(F.col("log_time")).alias("starttime")
    sliced = c.counted(rows).groupBy(*[F.expr(k) for k in keys], start).agg(*c.measures(named))
    return sliced.withColumn("endtime", F.col("starttime") + (DAY_SECONDS - 1))


def client_slices(
    events: DataFrame,
    lists: DataFrame | None = None,
    is_success: int = 1,
    enctypes: Known = None,
) -> DataFrame:
    """Per address and day: requests by type and by strength of the offered list.

    Takes success events, or failure events with is_success=0.
    """
    counts = {f"n{k}": c.tally(when) for k, when in c.CLIENT_ADDRESS.items()}
    fold = _by_day(with_list_flags(events, lists, enctypes), ["ip"], counts)
    return fold.withColumn("is_success", F.lit(is_success)).select(*CLIENT_SLICES.names)


def _princ_counts(fold: DataFrame) -> DataFrame:
    have = set(fold.columns)
    return fold.selectExpr(*[n if n in have else f"0L AS {n}" for n in PRINC_SLICES.names])


def princ_slices(
    success: DataFrame, lists: DataFrame | None = None, enctypes: Known = None
) -> DataFrame:
    """Per client principal and day: what its requests offered and got."""
    flagged = with_role_flags(with_list_flags(success, lists, enctypes), enctypes)
    met = {**c.OFFERED, **c.RECEIVED}
    counts = {"nauth": c.tally(c.IS_AS), **{f"nreq_{k}": c.tally(w) for k, w in met.items()}}
    rows = flagged.where(c.known("reply", "session"))
    return _princ_counts(_by_day(rows, ["client_name AS name"], counts))


def princ_fail_slices(failure: DataFrame) -> DataFrame:
    """Per client principal and day: failed requests."""
    rows = failure.where("client_name IS NOT NULL")
    return _princ_counts(_by_day(rows, ["client_name AS name"], {"nfail": f"sum({c.COUNT})"}))


def ticket_slices(
    success: DataFrame, failure: DataFrame, enctypes: Known = None
) -> DataFrame:
    """Per server principal and day: tickets issued and refused, and their keys."""
    issued = with_role_flags(c.counted(success), enctypes).where(c.known("session", "ticket"))
    rows = issued.selectExpr(
        "server_name", "log_time", c.COUNT, "session_weak", "ticket_weak", "false AS failed"
    ).unionByName(
        c.counted(failure).where("server_name IS NOT NULL").selectExpr(
            "server_name", "log_time", c.COUNT, "CAST(NULL AS int) AS session_weak",
            "CAST(NULL AS int) AS ticket_weak", "true AS failed",
        )
    )
    counts = {
        "nticket_issue": c.tally("NOT failed"),
        "nticket_fail": c.tally("failed"),
        **{f"nticket_{k}": c.tally(when) for k, when in c.TICKETED.items()},
    }
    return _princ_counts(_by_day(rows, ["server_name AS name"], counts))


def ticket_counts(
    success: DataFrame, failure: DataFrame, enctypes: Known = None
) -> DataFrame:
    """Ticket slices to be merged with those of clients: their entries are no requests."""
    return ticket_slices(success, failure, enctypes).withColumn("nentries", F.lit(0).cast("long"))


def ccs_slices(success: DataFrame, enctypes: Known = None) -> DataFrame:
    """Per address, client, server and day: weak and strong session keys."""
    rows = with_role_flags(success, enctypes).where(c.known("session"))
    keys = ["ip", "client_name AS cname", "server_name AS sname"]
    counts = {f"nlast_{k}": c.tally(when) for k, when in c.SESSION_KEY.items()}
    return _by_day(rows, keys, counts).select(*CCS_SLICES.names)


def rate_name(count: str) -> str:
    return f"{count.removeprefix('n')}_rate"


def slice_rates(slices: DataFrame, unfilled: list[str] = ()) -> DataFrame:
    """Slices with one rate per count, its share of what it is counted over.

    Ticket counts are shares of the tickets issued and refused, all others of the entries
    that are not failures, so merging failures or tickets in changes no other rate.  A share
    of nothing is NULL.  Counts named in `unfilled` have no source in these slices; their
    rates are NULL.
    """
    entries = "nentries - nfail" if "nfail" in slices.columns else "nentries"
    rated = [
        n for n in slices.columns if n.startswith("n") and n not in ("name", "nentries", "nauth", "nfail")
    ]

    def over(count: str) -> str:
        return "nticket_issue + nticket_fail" if count in PRINC_TICKET_COUNTS else entries

    share = {
        n: "CAST(NULL AS double)" if n in unfilled else f"try_divide(double({n}), double({over(n)}))"
        for n in rated
    }
    return slices.selectExpr("*", *[f"{text} AS {rate_name(n)}" for n, text in share.items()])


def princ_request_rates(slices: DataFrame) -> DataFrame:
    """Rates of client-side principal slices; ticket counts are not theirs."""
    return slice_rates(slices, PRINC_TICKET_COUNTS)


def ticket_rates(slices: DataFrame) -> DataFrame:
    """Rates of server-side principal slices; request counts are not theirs."""
    return slice_rates(slices, PRINC_REQ_COUNTS)


def prune(slices: DataFrame, days: int | None, as_of: int) -> DataFrame:
    """Slices that began at most `days` days before `as_of`; None keeps everything."""
    if days is None:
        return slices
    return slices.where(F.col("starttime") >= F.lit(as_of - days * DAY_SECONDS))
