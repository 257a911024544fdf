"""Joins of events to the enctype dimensions, and the forwarded-credential heuristic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from realmwatch.functions import enctypes as en
from realmwatch.operators.conditions import COUNT, counted
from realmwatch.schemas import REQ_TGS

# Columns the folds read: three flags of the offered list, one per key role.
LIST_FLAGS = {"modern_client": "list_modern", "is_weak": "list_weak", "is_too_weak": "list_too_weak"}
ROLES = {"reply": "reply_enctype", "session": "session_enctype", "ticket": "ticket_enctype"}


BROADCAST_BYTES = 10 * 1024 * 1024


def broadcast_if_small(side: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a join side for broadcast when its measured size is within the limit.

    The measure is one aggregate over the side, so this is for sides far cheaper to compute
    than the join they enter.  Past the limit the side is returned as it is and the join
    shuffles, where adaptive execution splits hot keys.
    """
    width = F.lit(16 * len(side.columns)).cast("bigint")
    for column, dtype in side.dtypes:
        if dtype == "string":
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
    (size,) = side.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(side) if size <= limit else side


def join_lists(events: DataFrame, lists: DataFrame) -> DataFrame:
    """Events with the flags of their list; events of unknown lists drop out."""
    dim = lists.select(
        F.col("enctype_list").alias("req_enctypes"),
        F.col("enctype_list_orig").alias("req_enctypes_orig"),
        *[F.col(c).alias(a) for c, a in LIST_FLAGS.items()],
    )
    return events.join(dim, ["req_enctypes", "req_enctypes_orig"])


def join_roles(events: DataFrame, enctypes: DataFrame, roles=tuple(ROLES)) -> DataFrame:
    """Events with `<role>_weak` per key role; rows with an unknown enctype drop out."""
    for role in roles:
        dim = enctypes.select(
            F.col("enctype").alias(ROLES[role]), F.col("is_weak").alias(f"{role}_weak")
        )
        events = events.join(dim, ROLES[role])
    return events


Known = DataFrame | Sequence[en.Enctype] | None


def with_list_flags(
    events: DataFrame, lists: DataFrame | None = None, enctypes: Known = None
) -> DataFrame:
    """List flags by a join when a list dimension is given, else computed from the list text,
    by the given enctypes or the reference data."""
    if lists is not None:
        return join_lists(events, lists)
    text, known = F.col("req_enctypes"), en.enctype_rows(enctypes)
    return events.withColumns(
        {
            "list_modern": en.list_is_modern(text, known),
            "list_weak": en.list_is_weak(text, known),
            "list_too_weak": en.list_is_too_weak(text, known),
        }
    )


def with_role_flags(events: DataFrame, enctypes: Known = None) -> DataFrame:
    """`<role>_weak` for every role, NULL where the enctype is unknown; keeps all rows."""
    known = en.enctype_rows(enctypes)
    return events.withColumns(
        {f"{role}_weak": en.enctype_is_weak(c, known) for role, c in ROLES.items()}
    )


def forwarded_tgt(success: DataFrame, max_lag: int = 900) -> DataFrame:
    """Service tickets followed within `max_lag` seconds by a request for a TGT.

    Both requests share address, authtime and client but differ in list and server, which
    hints that the first server was handed the client's credentials.  `npairs` counts the
    pairs of requests behind a row.

    The requests of an address, authtime and client are dealt once, with a time bucket as wide as
    the lag, counted per second there, and met with the requests for TGTs of that bucket and the next,
    so the cost of a hot session follows its seconds and not its rows.  What one task holds beside the rows it
    reads is the requests for TGTs of one session and two buckets.
    """
    width = max(max_lag, 1)
    who = ["ip", "authtime", "client_name"]
    requests = (
        counted(success)
        .where(F.col("req_type") == REQ_TGS)
        .select(*who, "server_name", "req_enctypes", "log_time", COUNT)
        .withColumn("tgt", F.col("server_name").ilike("krbtgt%"))
        .withColumn("own", F.floor(F.col("log_time") / width))
    )
    # a request for a TGT is met from its own bucket and from the one before; the many others are not doubled
    buckets = F.when(F.col("tgt"), F.array(F.col("own"), F.col("own") - 1)).otherwise(F.array("own"))
    dealt = requests.withColumn("bucket", F.explode(buckets)).repartition(*who, "bucket")
    seconds = dealt.groupBy(*who, "bucket", "own", "tgt", "server_name", "req_enctypes", "log_time").agg(
        F.sum(COUNT).alias(COUNT)
    )
    second = F.struct(
        F.col("server_name").alias("forwarded_server"), F.col("req_enctypes").alias("second_list"),
        F.col("log_time").alias("second_time"), F.col(COUNT).alias("second_n"),
    )
    near = F.collect_list(F.when(F.col("tgt"), second)).over(Window.partitionBy(*who, "bucket"))
    firsts = seconds.withColumn("near", near).where((F.col("bucket") == F.col("own")) & (F.size("near") > 0))
    lag = F.col("second_time") - F.col("log_time")
    pairs = firsts.select(*who, "server_name", "req_enctypes", "log_time", COUNT, F.inline("near")).where(
        lag.between(0, max_lag)
        & (F.col("req_enctypes") != F.col("second_list"))
        & (F.col("server_name") != F.col("forwarded_server"))
    )
    return pairs.groupBy(*who, "server_name", "forwarded_server", lag.alias("lag")).agg(
        F.sum(F.col(COUNT) * F.col("second_n")).alias("npairs")
    )
