"""Conditions shared by the last-seen folds (latest time) and the slices (counts).

Each is SQL text over events that carry list and role flags, so a measure is one parsed
expression.  The dictionary keys are the stems the measures are named after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from realmwatch.schemas import REQ_AS, REQ_TGS

# Column with the number of events behind a row.
COUNT = "n"

IS_AS = f"req_type = {REQ_AS}"
IS_TGS = f"req_type = {REQ_TGS}"

# What an address asked for, by request type and strength of the offered list.
CLIENT_ADDRESS = {
    "weak_as": f"{IS_AS} AND list_weak = 1",
    "weak_tgs": f"{IS_TGS} AND list_weak = 1",
    "strong_as": f"{IS_AS} AND list_weak = 0",
    "strong_tgs": f"{IS_TGS} AND list_weak = 0",
    "modern_as": f"{IS_AS} AND list_modern = 1",
    "modern_tgs": f"{IS_TGS} AND list_modern = 1",
}
# What a client's request offered.
OFFERED = {
    "had_weak": "list_weak = 1",
    "had_weakfirst": "list_too_weak = 1",
    "had_strong": "list_modern = 1",
    "had_strongonly": "list_weak = 0",
}
# What a client's request got.
RECEIVED = {
    "got_weaksesskey": "session_weak = 1",
    "got_weakreply": "reply_weak = 1",
    "got_strongsesskey": "session_weak = 0",
    "got_strongreply": "reply_weak = 0",
    "got_strong": "session_weak = 0 AND reply_weak = 0",
}
# Keys of a ticket issued for a server.
TICKETED = {
    "weaksesskey": "session_weak = 1",
    "weakticketkey": "ticket_weak = 1",
    "strongsesskey": "session_weak = 0",
    "strongticketkey": "ticket_weak = 0",
    "strong": "session_weak = 0 AND ticket_weak = 0",
}
SESSION_KEY = {"weak_sess_key": "session_weak = 1", "strong_sess_key": "session_weak = 0"}


def known(*roles: str) -> str:
    """Rows whose enctypes in these roles are all in the reference data."""
    return " AND ".join(f"{role}_weak IS NOT NULL" for role in roles)


def both(*conditions: str) -> str:
    return " AND ".join(f"({c})" for c in conditions)


def latest(when: str, time: str = "log_time") -> str:
    """Latest time among rows meeting the condition, 0 when there is none."""
    return f"coalesce(max(CASE WHEN {when} THEN {time} ELSE 0L END), 0L)"


def tally(when: str) -> str:
    """Number of events meeting the condition."""
    return f"coalesce(sum(CASE WHEN {when} THEN {COUNT} ELSE 0L END), 0L)"


def counted(events: DataFrame) -> DataFrame:
    """Events with how many a row stands for: one each, unless the table says so itself."""
    return events if COUNT in events.columns else events.withColumn(COUNT, F.lit(1).cast("long"))


def measures(named: dict[str, str]) -> list[Column]:
    """Aggregate columns from their SQL text by name."""
    return [F.expr(f"{text} AS {name}") for name, text in named.items()]
