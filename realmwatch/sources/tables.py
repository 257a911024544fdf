"""Typed event tables on storage, partitioned by outcome and day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch.functions.times import day_label
from realmwatch.schemas import FAILURE, SUCCESS
from realmwatch.sources import parser

_STORED = T.StructType(
    [*SUCCESS.fields]
    + [f for f in FAILURE.fields if f.name not in SUCCESS.names]
    + [T.StructField(n, T.StringType()) for n in ("value", "problem", "outcome", "day")]
)


PARTITIONS = ["outcome", "day"]


def stored_form(events: DataFrame) -> DataFrame:
    """A parsed table as it is stored: with its day, and text only where it is reported.

    Lines without a time go to the day 'none'.
    """
    carried = [c for c in events.columns if c not in _STORED.names]
    return events.select(
        *carried,
        *[c for c in _STORED.names if c not in ("value", "day")],
        F.when(F.col("problem").isNotNull(), F.col("value")).alias("value"),
        F.coalesce(day_label(F.col("log_time")), F.lit("none")).alias("day"),
    )


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """Write a parsed table in one pass over its lines, without a shuffle.

    Log files are close to time order, so a task meets few days.
    """
    stored_form(events).write.mode(mode).partitionBy(*PARTITIONS).parquet(path)


def batch_folder(path: str, batch_id: str) -> str:
    """Where one load's events stand below the events of all loads."""
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The events of one load, or of all loads below a path."""
    return spark.read.schema(_STORED).parquet(path).select(*_STORED.names)


def read_logs(spark: SparkSession, path: str) -> parser.ParsedLogs:
    """The three tables of a written log; outcome and day filters prune partitions."""
    events = read_events(spark, path)
    return parser.ParsedLogs(
        parser.successes(events).drop("day"),
        parser.failures(events).drop("day"),
        parser.rejects(events),
    )


def union_logs(*events: DataFrame) -> DataFrame:
    """One table over any number of logs."""
    return reduce(lambda left, right: left.unionByName(right), events)
