"""The model's functions as SQL text, from the same patterns as the column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from realmwatch.functions import enctypes as en
from realmwatch.functions.text import HOST
from realmwatch.schemas import DAY_SECONDS


def _raw(pattern: str) -> str:
    """A raw SQL string of a pattern, which holds no quote."""
    return f"r'{pattern}'"


def sql_functions(enctypes: Sequence[en.Enctype] = en.SEED) -> dict[str, str]:
    """Body of each function by its signature."""

    def matches(pattern: str) -> str:
        return f"CAST(listing RLIKE {_raw(pattern)} AS INT)"

    return {
        "canonical_list(listing STRING) RETURNS STRING": f"regexp_replace(listing, {_raw(en.REPEATED_HEAD)}, '$1')",
        "list_is_weak(listing STRING) RETURNS INT": matches(en.weak_pattern(enctypes)),
        "list_is_modern(listing STRING) RETURNS INT": matches(en.modern_pattern(enctypes)),
        "list_is_too_weak(listing STRING) RETURNS INT": matches(en.too_weak_pattern(enctypes)),
        "enctype_is_weak(number INT) RETURNS INT": en.weakness_case("number", enctypes),
        "day_start(epoch BIGINT) RETURNS BIGINT": f"epoch - pmod(epoch, {DAY_SECONDS}L)",
        "principal_host(name STRING) RETURNS STRING": f"nullif(regexp_extract(name, {_raw(HOST)}, 1), '')",
    }
