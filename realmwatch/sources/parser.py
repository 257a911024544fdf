"""Raw log lines to typed success and failure events.

Each line meets one regular expression once.  Its groups are spliced into a single
delimited string and split again, so no group costs another match, and a one-element
explode keeps the optimizer from copying that expression into every later filter.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from realmwatch.functions.enctypes import canonical_list
from realmwatch.functions.text import clean, number_or_zero
from realmwatch.functions.times import iso_epoch
from realmwatch.schemas import FAILURE, REQ_AS, REQ_TGS, SUCCESS

MARK = "\x01"

# Named parts of a line.  A numeric part has an empty group when its text is no number.
_TIME = r"(?<stamp>\d{4}-\d\d-\d\dT[\d:.]+)(?<offset>Z|[-+]\d\d:?\d\d)?"
# Atomic: only the first daemon tag counts, so a line full of tags is read once.
_HEADER = _TIME + r"(?> (?:.*? )??(?<kdc>\S+) (?:krb|old|dmz|afsdmz)5kdc[^ ]*: )"
_REQUEST = (
    r"(?<type>\S+) \(\S+ etypes \{(?<orig>(?<numbers>[-0-9 ]*)|[^}]*)\}\) (?<ip>\S+): "
)
_ISSUED = (
    r"ISSUE: authtime (?:(?<authtime>\d+)|[^,]*), etypes "
    r"\{rep=(?:(?<rep>-?\d+)|\S*) tkt=(?:(?<tkt>-?\d+)|\S*) ses=(?:(?<ses>-?\d+)|[^}]*)\}, "
    r"(?<issued>.*)"
)
_REFUSED = (
    r"(?!ISSUE:)(?<code>[^:]+): (?:authtime [^,]*,\s*)?(?:etypes \{[^}]*\},\s*)?\s*"
    r"(?:(?<refused>.*), ?(?<reason>[^,]*)|(?<whole>[^,]*))"
)
LINE = f"(?s)^{_HEADER}{_REQUEST}(?:{_ISSUED}|{_REFUSED})$"

# What survives the splice, as the groups it is made of; client and server sit in one part
# for both outcomes.
_PARTS = {
    "stamp": ["stamp"],
    "offset": ["offset"],
    "kdc": ["kdc"],
    "type": ["type"],
    "orig": ["orig"],
    "numbers": ["numbers"],
    "ip": ["ip"],
    "authtime": ["authtime"],
    "rep": ["rep"],
    "tkt": ["tkt"],
    "ses": ["ses"],
    "parties": ["issued", "refused", "whole"],
    "code": ["code"],
    "reason": ["reason", "whole"],
}
# Groups are referred to by number, which the regex engine resolves faster than a name.
_NUMBER = {name: i for i, name in enumerate(re.findall(r"\(\?<(\w+)>", LINE), 1)}
SPLICE = MARK.join("".join(f"${_NUMBER[g]}" for g in groups) for groups in _PARTS.values())
_BETWEEN = " for "

# Outcomes and report texts.
SUCCEEDED, FAILED, REJECTED = "success", "failure", "rejected"
MALFORMED = "malformed entry"
NO_TIME = "no usable time"
EMPTY_LIST = "empty enctype list"
NO_PARTIES = "no client and server"


class ParsedLogs(NamedTuple):
    success: DataFrame
    failure: DataFrame
    rejects: DataFrame


def _single_spaced(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed.contains("  "), F.regexp_replace(trimmed, " +", " ")).otherwise(trimmed)


def parse_events(raw: DataFrame) -> DataFrame:
    """All lines in one wide table: event columns, `outcome` and `problem`.

    Columns of the input other than `value` are carried along.  A rejected line keeps its
    text in `value`; so does an accepted line that has something to report.
    """
    value = F.col("value")
    line = F.when(value.contains(MARK), F.translate(value, MARK, "")).otherwise(value)
    spliced = F.split(F.regexp_replace(line, LINE, SPLICE), MARK)
    kept = [c for c in raw.columns if c != "value"]
    split_once = raw.select(*kept, "value", F.explode(F.array(spliced)).alias("part"))

    part = {name: F.get("part", F.lit(i)) for i, name in enumerate(_PARTS)}
    issued = part["code"] == ""  # the branch that matched; a code is text and decides nothing
    named = part["parties"].contains(_BETWEEN)
    # a refusal counts as one even where it names nobody
    matched = (F.size("part") == len(_PARTS)) & (named | ~issued)
    listing = _single_spaced(part["numbers"])
    columns = {
        "matched": matched,
        "log_time": F.when(matched, iso_epoch(part["stamp"], part["offset"])),
        "kdc": clean(part["kdc"]),
        "ip": part["ip"],
        "req_type": F.when(clean(part["type"]) == "AS_REQ", REQ_AS).otherwise(REQ_TGS),
        "issued": issued,
        "named": named,
        "code": F.when(issued, "ISSUE").otherwise(clean(part["code"])),
        "req_enctypes": F.when(listing == "", "0").otherwise(canonical_list(listing)),
        "req_enctypes_orig": _single_spaced(part["orig"]),
        "authtime": number_or_zero(part["authtime"], "bigint"),
        "client_name": F.when(named, clean(F.substring_index(part["parties"], _BETWEEN, 1))),
        "server_name": F.when(named, clean(F.substring_index(part["parties"], _BETWEEN, -1))),
        "reply_enctype": number_or_zero(part["rep"], "int"),
        "ticket_enctype": number_or_zero(part["tkt"], "int"),
        "session_enctype": number_or_zero(part["ses"], "int"),
        "reason": clean(part["reason"]),
    }
    fields = split_once.select(*kept, "value", *[c.alias(n) for n, c in columns.items()])
    return fields.withColumns({"problem": _problem(), "outcome": _outcome()}).drop("matched", "issued", "named")


def _problem() -> Column:
    """A line of a KDC whose first word is no ISO time is told apart from other text."""
    tagged = F.col("value").rlike(r"^\S+ .*(?:krb|old|dmz|afsdmz)5kdc[^ ]*: ")
    iso = F.col("value").rlike(r"^\d{4}-\d\d-\d\dT")
    return (
        F.when(~F.col("matched"), F.when(tagged & ~iso, NO_TIME).otherwise(MALFORMED))
        .when(F.col("log_time").isNull(), NO_TIME)
        .when(~F.col("named"), NO_PARTIES)
        .when(F.col("req_enctypes_orig") == "", EMPTY_LIST)
    )


def _outcome() -> Column:
    return (
        F.when(F.col("log_time").isNull(), REJECTED)
        .when(F.col("issued"), SUCCEEDED)
        .otherwise(FAILED)
    )


def successes(events: DataFrame) -> DataFrame:
    return _typed(events, SUCCEEDED, SUCCESS.names)


def failures(events: DataFrame) -> DataFrame:
    return _typed(events, FAILED, FAILURE.names)


def _typed(events: DataFrame, outcome: str, names: list[str]) -> DataFrame:
    wide = {*SUCCESS.names, *FAILURE.names, "value", "problem", "outcome"}
    carried = [c for c in events.columns if c not in wide]
    return events.where(F.col("outcome") == outcome).select(*carried, *names)


def rejects(events: DataFrame) -> DataFrame:
    """Lines with something to report; `kept` is 1 when the line became an event anyway."""
    return events.where("problem IS NOT NULL").select(
        F.col("value").alias("line"),
        F.col("problem").alias("reason"),
        (F.col("outcome") != REJECTED).cast("int").alias("kept"),
    )


def parse_logs(raw: DataFrame) -> ParsedLogs:
    """Success events, failure events and reports of a set of raw lines.

    Writing all three reads the lines three times; sources.tables.write_events does it in
    one pass.
    """
    events = parse_events(raw)
    return ParsedLogs(successes(events), failures(events), rejects(events))
