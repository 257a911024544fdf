"""Merges of summary tables: every measure is a maximum, a minimum or a sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def upsert(
    state: DataFrame, delta: DataFrame, keys: list[str], how: dict[str, str] | str
) -> DataFrame:
    """State with a delta merged in: keys of either side, measures combined per key.

    `how` names max, min or sum for all measures or per measure.  A side that does not own
    a measure carries 0 (or NULL for text), which no merge lets win.
    """
    return combine(state.unionByName(delta), keys, how)


def combine(rows: DataFrame, keys: list[str], how: dict[str, str] | str) -> DataFrame:
    """Rows of any number of deltas folded to one per key."""
    types = dict(rows.dtypes)
    measures = [c for c in rows.columns if c not in keys]
    rules = dict.fromkeys(measures, how) if isinstance(how, str) else how

    def merged(name: str) -> str:
        text = f"{rules[name]}({name})"
        if types[name] != "string":
            text = f"CAST(coalesce({text}, 0) AS {types[name]})"
        return f"{text} AS {name}"

    aggregates = [F.expr(merged(m)) for m in measures]
    return rows.groupBy(*keys).agg(*aggregates).select(*rows.columns)


def slice_rules(columns: list[str], keys: list[str]) -> dict[str, str]:
    """Counts add up; the end of a slice is the latest seen."""
    return {c: "max" if c == "endtime" else "sum" for c in columns if c not in keys}
