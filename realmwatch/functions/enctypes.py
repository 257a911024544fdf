"""Encryption-type reference data and the strength flags of an offered list.

A list is text: enctype numbers separated by single spaces, in the order offered.  Its
flags depend on the text alone, so they are offered in two forms: as columns computed in
place (below, no join and no shuffle) and as a dimension (operators.lists).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Enctype(NamedTuple):
    enctype: int
    name: str
    is_modern: int
    is_weak: int


# Number, name, modern, weak.
SEED: tuple[Enctype, ...] = tuple(
    Enctype(*row)
    for row in (
        (0, "null", 0, 1),
        (1, "des-cbc-crc", 0, 1),
        (2, "des-cbc-md4", 0, 1),
        (3, "des-cbc-md5", 0, 1),
        (4, "des-cbc-raw", 0, 1),
        (5, "des3-cbc-md5", 0, 1),
        (6, "des3-cbc-raw", 0, 1),
        (7, "old-des3-cbc-sha1", 0, 1),
        (8, "des-hmac-sha1", 0, 1),
        (9, "id-dsa-with-sha1", 0, 0),
        (10, "md5WithRSAEncryption", 0, 0),
        (11, "sha-1WithRSAEncryption", 0, 0),
        (12, "rc2-cbc", 0, 0),
        (13, "rsaEncryption", 0, 0),
        (14, "id-RSAES-OAEP", 0, 0),
        (15, "des-ede3-cbc", 0, 0),
        (16, "des3-cbc-sha1", 0, 0),
        (17, "aes128-cts-hmac-sha1-96", 1, 0),
        (18, "aes256-cts-hmac-sha1-96", 1, 0),
        (23, "arcfour-hmac", 0, 0),
        (24, "arcfour-hmac-exp", 0, 1),
        (48, "pkcross", 0, 0),
        (-128, "arcfour-hmac-old", 0, 0),
        (-133, "arcfour-hmac-old-exp", 0, 0),
        (-4096, "des-cbc-none", 0, 1),
        (-4097, "des3-cbc-none", 0, 1),
        (-4098, "des-cfb64-none", 0, 1),
        (-4099, "des-pcbc-none", 0, 1),
        (-4100, "digest-md5-none", 0, 0),
        (-4101, "cram-md5-none", 0, 0),
    )
)


def enctype_dim(spark: SparkSession) -> DataFrame:
    """The reference dimension, an inline table whose exact size the planner knows."""
    rows = ", ".join(f"({e.enctype}, '{e.name}', {e.is_modern}, {e.is_weak})" for e in SEED)
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS seed(enctype, name, is_modern, is_weak)"
    )


def enctype_rows(enctypes: DataFrame | Sequence[Enctype] | None, most: int = 10_000) -> Sequence[Enctype]:
    """A site's enctype table as plain rows; None is the reference data.

    The table describes numbers of a protocol, so it is short; a longer one is refused.
    """
    if enctypes is None:
        return SEED
    if not isinstance(enctypes, DataFrame):
        return tuple(enctypes)
    rows = enctypes.select("enctype", "name", "is_modern", "is_weak").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} enctypes")
    return tuple(Enctype(*r) for r in rows)


def extend_enctypes(known: DataFrame, additions: DataFrame) -> DataFrame:
    """Insert if absent: an addition whose number is known already is ignored."""
    fresh = (
        additions.join(known, "enctype", "left_anti")
        .groupBy("enctype")
        .agg(F.min(F.struct("name", "is_modern", "is_weak")).alias("row"))
        .select("enctype", "row.*")
    )
    return known.unionByName(fresh)


def tokens(listing: Column) -> Column:
    return F.filter(F.split(listing, " "), lambda t: t != "")


REPEATED_HEAD = r"^(\S+)(?: \1)+(?= |$)"


def canonical_list(listing: Column) -> Column:
    """Collapse a repeated leading enctype: '18 18 17' becomes '18 17'."""
    return F.regexp_replace(listing, REPEATED_HEAD, "$1")


def _any_of(members: Iterable[Enctype]) -> str:
    return "(?:" + "|".join(str(m.enctype) for m in members) + ")"


def _offers(members: Iterable[Enctype]) -> str:
    return f"(?:^| ){_any_of(members)}(?= |$)"


def weak_pattern(enctypes: Sequence[Enctype] = SEED) -> str:
    return _offers(e for e in enctypes if e.is_weak)


def modern_pattern(enctypes: Sequence[Enctype] = SEED) -> str:
    return _offers(e for e in enctypes if e.is_modern)


def too_weak_pattern(enctypes: Sequence[Enctype] = SEED) -> str:
    """A list that opens with weak enctypes and has a strong one follow in sequence.

    Only the longest prefix of known, distinct enctypes counts.  So the opening run must
    be weak and free of repeats, which also bounds its length by the number of weak
    enctypes, and the next enctype must be known and not weak.
    """
    weak = [e for e in enctypes if e.is_weak]
    one, strong = _any_of(weak), _any_of([e for e in enctypes if not e.is_weak])
    run = f"(?:{one} )"
    repeat = f"{run}{{0,{len(weak)}}}({one}) {run}{{0,{len(weak)}}}\\1 "
    return f"^(?!{repeat}){run}{{1,{len(weak)}}}{strong}(?= |$)"


def list_is_weak(listing: Column, enctypes: Sequence[Enctype] = SEED) -> Column:
    """1 when any offered enctype is weak."""
    return listing.rlike(weak_pattern(enctypes)).cast("int")


def list_is_modern(listing: Column, enctypes: Sequence[Enctype] = SEED) -> Column:
    """1 when any offered enctype is modern."""
    return listing.rlike(modern_pattern(enctypes)).cast("int")


def list_is_too_weak(listing: Column, enctypes: Sequence[Enctype] = SEED) -> Column:
    """1 when the list opens with weak enctypes and a strong one follows in sequence."""
    return listing.rlike(too_weak_pattern(enctypes)).cast("int")


def weakness_case(column: str, enctypes: Sequence[Enctype] = SEED) -> str:
    """SQL text: 1 weak, 0 not weak, NULL for a number outside the reference data."""
    whens = [(weak, [str(e.enctype) for e in enctypes if e.is_weak == weak]) for weak in (1, 0)]
    return "CASE " + " ".join(f"WHEN {column} IN ({', '.join(n)}) THEN {weak}" for weak, n in whens if n) + " END"


def enctype_is_weak(column: str, enctypes: Sequence[Enctype] = SEED) -> Column:
    """1 weak, 0 not weak, NULL for a number outside the reference data."""
    return F.expr(weakness_case(column, enctypes))
