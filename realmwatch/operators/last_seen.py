"""Last-seen folds: latest time per address, principal and address/client/server triple.

Every measure is a maximum, so each fold is one aggregation that combines before its only
shuffle: a key that holds a third of all rows reaches the reducers as one row per task.
Without a list or enctype table the flags are computed in place and nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from realmwatch.functions.text import principal_host
from realmwatch.operators import conditions as c
from realmwatch.operators.joins import LIST_FLAGS, ROLES, Known, with_list_flags, with_role_flags
from realmwatch.schemas import CCS, CLIENT, PRINC, PRINC_MEASURES
from realmwatch.sources.parser import FAILED, REJECTED, SUCCEEDED

_ZERO = "0L"
_PARTIES = (
    "inline(array(struct(false AS as_server, client_name AS name), "
    "struct(true AS as_server, server_name AS name)))"
)


def _fill(fold: DataFrame, names: list[str]) -> DataFrame:
    """The fold with every column of its table, 0 in those it does not own."""
    have = set(fold.columns)
    return fold.selectExpr(*[n if n in have else f"{_ZERO} AS {n}" for n in names])


def client_last_seen(
    success: DataFrame, lists: DataFrame | None = None, enctypes: Known = None
) -> DataFrame:
    """Per address: last success and last weak or strong offer by request type."""
    named = {"last_success": "max(log_time)"}
    for stem, when in c.CLIENT_ADDRESS.items():
        if f"last_{stem}" in CLIENT.names:
            named[f"last_{stem}"] = c.latest(when)
    fold = with_list_flags(success, lists, enctypes).groupBy("ip").agg(*c.measures(named))
    return _fill(fold, CLIENT.names)


def client_last_fail(failure: DataFrame) -> DataFrame:
    """Per address: last failure, as a delta of the client table."""
    return _fill(failure.groupBy("ip").agg(F.max("log_time").alias("last_fail")), CLIENT.names)


def _offer_measures(of: str) -> dict[str, str]:
    return {f"lc_req_{k}": c.latest(c.both(of, when)) for k, when in c.OFFERED.items()}


def _client_success_measures(of: str) -> dict[str, str]:
    return {
        "lc_auth": c.latest(of, "authtime"),
        **_offer_measures(of),
        **{f"lc_req_{k}": c.latest(c.both(of, when)) for k, when in c.RECEIVED.items()},
    }


def _server_success_measures(of: str) -> dict[str, str]:
    return {
        "ls_ticket_issue": c.latest(of),
        **{f"ls_ticket_{k}": c.latest(c.both(of, when)) for k, when in c.TICKETED.items()},
    }


def _princ_measures() -> dict[str, tuple[str, str]]:
    """Condition and time of every principal measure, over rows of `party_rows`."""
    won_client, won_server = "NOT failed AND NOT as_server", "NOT failed AND as_server"
    at = {"last_used": ("NOT failed", "log_time"), "lc_auth": (won_client, "authtime")}
    at |= {"lc_fail": ("failed AND NOT as_server", "log_time")}
    # offers count for failed requests too
    at |= {f"lc_req_{k}": (c.both("NOT as_server", when), "log_time") for k, when in c.OFFERED.items()}
    at |= {f"lc_req_{k}": (c.both(won_client, when), "log_time") for k, when in c.RECEIVED.items()}
    at |= {"ls_ticket_issue": (won_server, "log_time"), "ls_ticket_fail": ("failed AND as_server", "log_time")}
    return at | {f"ls_ticket_{k}": (c.both(won_server, when), "log_time") for k, when in c.TICKETED.items()}


def party_rows(events: DataFrame, enctypes: Known = None) -> DataFrame:
    """A row for the client and one for the server of every event of a parsed table, in one scan.

    Enctypes of failed requests are none; a row whose own enctypes are unknown is left out.
    """
    flagged = with_role_flags(with_list_flags(events, enctypes=enctypes), enctypes)
    roles = [f"CASE WHEN outcome = '{SUCCEEDED}' THEN {role}_weak END AS {role}_weak" for role in ROLES]
    rows = flagged.where(F.col("outcome") != REJECTED).selectExpr(
        f"outcome = '{FAILED}' AS failed", "log_time", "authtime", *LIST_FLAGS.values(), *roles, _PARTIES
    )
    return rows.where("name IS NOT NULL").where(
        f"failed OR (NOT as_server AND {c.known('reply', 'session')}) OR (as_server AND {c.known('session', 'ticket')})"
    )


def princ_changes(events: DataFrame, enctypes: Known = None) -> DataFrame:
    """Principals of a stream of parsed events, as they are after each micro-batch that changed them.

    Every measure is kept with the time of the batch that first reached it, so a principal whose events
    bring nothing later than what is known is not among the rows of a batch.
    """
    measures = _princ_measures()
    stamped = party_rows(events, enctypes).withColumn("batch", F.unix_micros(F.current_timestamp()))
    # of equal times the earliest batch wins
    kept = [
        F.expr(f"max(struct(CASE WHEN {when} THEN {time} ELSE 0L END AS at, -batch AS since)) AS {name}")
        for name, (when, time) in measures.items()
    ]
    changed = F.least(*[F.col(f"{name}.since") for name in measures]) == -F.unix_micros(F.current_timestamp())
    state = stamped.groupBy("name").agg(*kept).where(changed)
    return princ_delta(state.select("name", *[F.col(f"{name}.at").alias(name) for name in measures]))


def princ_client_success(
    success: DataFrame, lists: DataFrame | None = None, enctypes: Known = None
) -> DataFrame:
    """Principals as clients of successful requests."""
    named = {"last_used": "max(log_time)", **_client_success_measures("true")}
    return (
        with_role_flags(with_list_flags(success, lists, enctypes), enctypes)
        .where(c.known("reply", "session"))
        .groupBy(F.col("client_name").alias("name"))
        .agg(*c.measures(named))
    )


def princ_server_success(success: DataFrame, enctypes: Known = None) -> DataFrame:
    """Principals as servers of successful requests."""
    named = {"last_used": "max(log_time)", **_server_success_measures("true")}
    return (
        with_role_flags(success, enctypes)
        .where(c.known("session", "ticket"))
        .groupBy(F.col("server_name").alias("name"))
        .agg(*c.measures(named))
    )


def princ_client_fail(
    failure: DataFrame, lists: DataFrame | None = None, enctypes: Known = None
) -> DataFrame:
    """Principals as clients of failed requests."""
    return (
        with_list_flags(failure, lists, enctypes)
        .where("client_name IS NOT NULL")
        .groupBy(F.col("client_name").alias("name"))
        .agg(*c.measures({"lc_fail": "max(log_time)", **_offer_measures("true")}))
    )


def princ_server_fail(failure: DataFrame) -> DataFrame:
    """Principals as servers of failed requests."""
    return (
        failure.where("server_name IS NOT NULL")
        .groupBy(F.col("server_name").alias("name"))
        .agg(F.max("log_time").alias("ls_ticket_fail"))
    )


def princ_last_seen(
    success: DataFrame,
    failure: DataFrame,
    lists: DataFrame | None = None,
    enctypes: Known = None,
) -> DataFrame:
    """All four principal folds in one: one scan of each event table and one shuffle.

    Each event yields a row for its client and a row for its server; the conditions pick
    the measures that row may advance.
    """
    list_flags, role_flags = list(LIST_FLAGS.values()), [f"{role}_weak" for role in ROLES]
    won = (
        with_role_flags(with_list_flags(success, lists, enctypes), enctypes)
        .selectExpr("false AS failed", "log_time", "authtime", *list_flags, *role_flags, _PARTIES)
        .where(
            f"(NOT as_server AND {c.known('reply', 'session')}) "
            f"OR (as_server AND {c.known('session', 'ticket')})"
        )
    )
    lost = with_list_flags(failure, lists, enctypes).selectExpr(
        "true AS failed", "log_time", f"{_ZERO} AS authtime", *list_flags,
        *[f"CAST(NULL AS int) AS {n}" for n in role_flags], _PARTIES,
    )
    named = {name: c.latest(*at) for name, at in _princ_measures().items()}
    rows = won.unionByName(lost).where("name IS NOT NULL")
    return princ_delta(rows.groupBy("name").agg(*c.measures(named)))


def princ_delta(fold: DataFrame) -> DataFrame:
    """A principal fold widened to the full principal table."""
    filled = _fill(fold, ["name", *PRINC_MEASURES])
    return filled.withColumn("host", principal_host(F.col("name"))).select(*PRINC.names)


def ccs_last_seen(success: DataFrame, enctypes: Known = None) -> DataFrame:
    """Per address, client and server: last weak and last strong session key."""
    named = {f"last_{k}": c.latest(when) for k, when in c.SESSION_KEY.items()}
    return (
        with_role_flags(success, enctypes)
        .where(c.known("session"))
        .groupBy("ip", F.col("client_name").alias("cname"), F.col("server_name").alias("sname"))
        .agg(*c.measures(named))
        .select(*CCS.names)
    )
