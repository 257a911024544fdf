"""The event cube: events that no fold can tell apart, counted once.

Every fold takes the latest time or the number of events by some of these columns, so events that agree
in all of them and fall on one day are one row: how many there are (`n`), the latest time and the latest
authtime.  The cube is one pass over the events with one shuffle, combined before it; all folds, and the
counts of reported lines, are read off it.  Its rows have the columns of events, so the folds take either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from realmwatch.functions.times import day_start
from realmwatch.schemas import REPORT_COUNTS
from realmwatch.sources.parser import FAILED, REJECTED, SUCCEEDED

KEYS = (
    "ip req_type req_enctypes req_enctypes_orig client_name server_name reply_enctype session_enctype "
    "ticket_enctype"
).split()


def event_cube(events: DataFrame) -> DataFrame:
    """The cube of a parsed or stored event table, rejected lines included."""
    told = F.col("outcome") != REJECTED
    keys = [F.when(told, F.col(k)).alias(k) for k in KEYS]
    day = F.when(told, day_start(F.col("log_time"))).alias("day_start")
    cube = events.groupBy("outcome", "problem", *keys, day).agg(
        F.count("*").alias("n"), F.max("log_time").alias("log_time"), F.max("authtime").alias("authtime")
    )
    return cube.drop("day_start")


def cube_successes(cube: DataFrame) -> DataFrame:
    return cube.where(F.col("outcome") == SUCCEEDED).drop("outcome", "problem")


def cube_failures(cube: DataFrame) -> DataFrame:
    return cube.where(F.col("outcome") == FAILED).drop(
        "outcome", "problem", "authtime", "reply_enctype", "session_enctype", "ticket_enctype"
    )


def cube_reports(cube: DataFrame) -> DataFrame:
    """Lines with something to report, counted by problem."""
    kept = (F.col("outcome") != REJECTED).cast("int").alias("kept")
    reported = cube.where("problem IS NOT NULL").groupBy(F.col("problem").alias("reason"), kept)
    return reported.agg(F.sum("n").alias("nlines")).select(*REPORT_COUNTS.names)
