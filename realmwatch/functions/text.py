"""Text cleaning and principal-name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed from names, codes and reasons.
STRIPPED = "%'"


def clean(text: Column) -> Column:
    """Text without those characters.

    One short call: a test for them first makes the parser's generated method too long for the JVM to compile.
    """
    return F.translate(text, STRIPPED, "")


def number_or_zero(text: Column, dtype: str) -> Column:
    """Integer value of a run of digits with an optional sign, 0 for an empty text.

    A number the type cannot hold counts as none.  Empty texts never reach the cast, which
    would raise and catch an error for each.
    """
    return F.coalesce(F.when(text != "", text.try_cast(dtype)), F.lit(0).cast(dtype))


HOST = r"^[^/@]+/([^@]+)@"


def principal_host(name: Column) -> Column:
    """Host part of a service/host@REALM principal, NULL for other names."""
    return F.nullif(F.regexp_extract(name, HOST, 1), F.lit(""))
