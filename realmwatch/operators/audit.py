"""Reports of rows that break the model's constraints."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from realmwatch.functions.enctypes import enctype_dim
from realmwatch.operators.joins import ROLES
from realmwatch.schemas import FAILURE, REQ_AS, REQ_TGS, SUCCESS
from realmwatch.sources.parser import FAILED, REJECTED, SUCCEEDED

# Columns a failure event may lack; a success event may lack none.
OPTIONAL_ON_FAILURE = ["req_type", "client_name", "server_name"]


def _broken_rule(failed: bool) -> str:
    """SQL text naming the first row constraint an event breaks, NULL when it keeps all."""
    schema, optional = (FAILURE, OPTIONAL_ON_FAILURE) if failed else (SUCCESS, [])
    rules = {f"{n} is missing": f"{n} IS NULL" for n in schema.names if n not in optional}
    rules["req_type is unknown"] = f"req_type NOT IN ({REQ_AS}, {REQ_TGS})"
    return "CASE " + " ".join(f"WHEN {r} THEN '{text}'" for text, r in rules.items()) + " END"


def valid_rows(events: DataFrame, failed: bool = False) -> DataFrame:
    """Events that keep the row constraints of their table."""
    return events.where(f"({_broken_rule(failed)}) IS NULL")


def invalid_rows(events: DataFrame, failed: bool = False) -> DataFrame:
    """The other events, with the first constraint each breaks as `problem`."""
    marked = events.withColumn("problem", F.expr(_broken_rule(failed)))
    return marked.where("problem IS NOT NULL")


def routed(events: DataFrame) -> DataFrame:
    """A parsed event table in which a row that breaks a constraint of its table is rejected, its problem the rule.

    An expression per row: it rides on the pass that stores the events or counts them.
    """
    broken = F.when(F.col("outcome") == SUCCEEDED, F.expr(_broken_rule(False))).when(
        F.col("outcome") == FAILED, F.expr(_broken_rule(True))
    )
    marked = events.withColumn("broken", broken)
    return marked.withColumns(
        {
            "problem": F.coalesce("broken", "problem"),
            "outcome": F.when(F.col("broken").isNotNull(), REJECTED).otherwise(F.col("outcome")),
        }
    ).drop("broken")


def duplicate_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return table.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Child rows whose reference (child column -> parent column) has no parent row."""
    keys = parent.select(*[F.col(p).alias(c) for c, p in on.items()])
    return child.join(keys, list(on), "left_anti")


class Reference(NamedTuple):
    """Columns of a child table that name a row of a parent table."""

    child: str
    columns: tuple[str, ...]
    parent: str
    keys: tuple[str, ...]


# The references of the data model.
REFERENCES = (
    Reference("client_slice_data", ("ip",), "client", ("ip",)),
    Reference("princ_slice_data", ("name",), "princ", ("name",)),
    Reference("client_cname_sname", ("ip",), "client", ("ip",)),
    Reference("client_cname_sname", ("cname",), "princ", ("name",)),
    Reference("client_cname_sname", ("sname",), "princ", ("name",)),
    Reference("ccs_slice_data", ("ip",), "client", ("ip",)),
    Reference("ccs_slice_data", ("cname",), "princ", ("name",)),
    Reference("ccs_slice_data", ("sname",), "princ", ("name",)),
    Reference(
        "req_enctypes_normal", ("enctype_list", "enctype_list_orig"),
        "req_enctypes_lists", ("enctype_list", "enctype_list_orig"),
    ),
)


def broken_references(tables: dict[str, DataFrame], references: Sequence[Reference] = REFERENCES) -> DataFrame:
    """Keys that child rows name and no parent row has: child, its columns, parent, key, number of rows.

    All references are checked in one pass: every table's keys are tagged and meet in one shuffle, combined
    before it, so a key of many rows is one row of a task.  A key with a null names nothing.
    """
    used = [r for r in references if r.child in tables and r.parent in tables]
    tagged = []
    for parent, keys in sorted({(r.parent, r.keys) for r in used}):
        tagged.append(_keyed(tables[parent], parent, keys, -1))
    for number, r in enumerate(used):
        tagged.append(_keyed(tables[r.child], r.parent, r.columns, number))
    rows = reduce(DataFrame.unionAll, tagged).where("NOT exists(key, k -> k IS NULL)")
    counts = [F.count_if(F.col("reference") == i).alias(f"n{i}") for i in range(len(used))]
    met = rows.groupBy("parent", "key").agg(F.count_if(F.col("reference") == -1).alias("held"), *counts)
    found = F.array(
        *[
            F.struct(
                F.lit(r.child).alias("child"), F.lit(",".join(r.columns)).alias("columns"), F.col(f"n{i}").alias("nrows")
            )
            for i, r in enumerate(used)
        ]
    )
    missing = met.where("held = 0").select("parent", F.array_join("key", "|").alias("key"), F.inline(found))
    return missing.where("nrows > 0").select("child", "columns", "parent", "key", "nrows")


def _keyed(table: DataFrame, parent: str, columns: Sequence[str], reference: int) -> DataFrame:
    return table.select(
        F.lit(parent).alias("parent"),
        F.array(*[F.col(c).cast("string") for c in columns]).alias("key"),
        F.lit(reference).alias("reference"),
    )


def unknown_enctypes(success: DataFrame, enctypes: DataFrame | None = None) -> DataFrame:
    """Rows per role and enctype that the role joins lose because it is unknown.

    Counted before the anti-join, so that join sees distinct enctypes and not events.
    """
    dim = enctype_dim(success.sparkSession) if enctypes is None else enctypes
    used = F.explode(
        F.array(
            *[F.struct(F.lit(r).alias("role"), F.col(c).alias("enctype")) for r, c in ROLES.items()]
        )
    )
    counted = (
        success.select(used.alias("used")).select("used.*")
        .groupBy("role", "enctype")
        .agg(F.count("*").alias("nrows"))
    )
    return counted.join(dim.select("enctype"), "enctype", "left_anti").select("role", "enctype", "nrows")
