"""Temp views for ad-hoc SQL over events and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from realmwatch.functions.enctypes import SEED, Enctype, enctype_dim, enctype_rows
from realmwatch.functions.sql import sql_functions
from realmwatch.plans.store import TABLES, SummaryStore
from realmwatch.sources.parser import ParsedLogs
from realmwatch.sources.tables import union_logs


def register_views(spark: SparkSession, **tables: DataFrame) -> None:
    """Name each DataFrame for spark.sql()."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def register_functions(spark: SparkSession, enctypes: Sequence[Enctype] | None = None) -> None:
    """The model's functions for spark.sql(), as temporary SQL functions: their bodies are inlined into the plan.

    canonical_list, list_is_weak, list_is_modern, list_is_too_weak (of an offered list), enctype_is_weak (of a
    number), day_start (of epoch seconds) and principal_host (of a name).
    """
    for signature, body in sql_functions(SEED if enctypes is None else enctypes).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def attach(
    spark: SparkSession, store: SummaryStore, *loaded: ParsedLogs, enctypes: DataFrame | None = None
) -> None:
    """Views of any number of logs and of the store's tables, under their table names.

    `enctypes` is a site's own enctype table, in place of the reference data; the SQL functions of
    `register_functions` go by it as well.
    """
    known = enctype_dim(spark) if enctypes is None else enctypes
    events = {}
    if loaded:
        events["log_entry_success"] = union_logs(*[log.success for log in loaded])
        events["log_entry_fail"] = union_logs(*[log.failure for log in loaded])
    register_functions(spark, enctype_rows(enctypes))
    # one snapshot: a batch committed meanwhile is in all views or in none
    seen = store.snapshot()
    register_views(
        spark, **events, enctypes=known, **{name: store.read(name, at=seen) for name in TABLES}
    )
