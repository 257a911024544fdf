"""The dimension of distinct offered enctype lists and its member rows.

Work here is per distinct list, never per event: the only shuffle that sees events is the
distinct in `discover_lists`, which combines before it shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from realmwatch.functions.enctypes import enctype_dim, tokens

KEY = ["enctype_list", "enctype_list_orig"]


def _pairs(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("req_enctypes").alias("enctype_list"),
        F.col("req_enctypes_orig").alias("enctype_list_orig"),
    )


def discover_lists(
    success: DataFrame, failure: DataFrame | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Distinct (canonical, original) lists of the events that `known` does not hold."""
    pairs = _pairs(success)
    if failure is not None:
        pairs = pairs.unionByName(_pairs(failure))
    found = pairs.distinct()
    return found if known is None else found.join(known.select(*KEY), KEY, "left_anti")


def _token_rows(lists: DataFrame, enctypes: DataFrame | None) -> DataFrame:
    """One row per list position: the token, its enctype if known, and `in_prefix`.

    A position is in the prefix while every token up to it is known and not seen before.
    Whether the token is a repeat is decided inside the row, so one window by list is the
    only shuffle.
    """
    dim = enctype_dim(lists.sparkSession) if enctypes is None else enctypes
    numbers = dim.withColumn("token", F.col("enctype").cast("string"))
    placed = lists.select(*KEY, tokens(F.col("enctype_list")).alias("tokens")).select(
        *KEY, "tokens", F.posexplode_outer("tokens").alias("pos", "token")
    )
    return placed.join(numbers, "token", "left").select(
        *KEY,
        "tokens",
        "pos",
        "enctype",
        "name",
        "is_modern",
        "is_weak",
        (F.col("enctype").isNotNull() & (F.array_position("tokens", F.col("token")) == F.col("pos") + 1))
        .alias("fits"),
    )


def _by_list(lists: DataFrame, enctypes: DataFrame | None) -> DataFrame:
    """One row per list: `known` members in list order and the length of the prefix."""
    rows = _token_rows(lists, enctypes)
    member = F.struct("pos", "enctype", "name", "is_modern", "is_weak", "fits")
    grouped = rows.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.when(F.col("enctype").isNotNull(), member))).alias("members"),
        F.coalesce(F.min(F.when(~F.col("fits"), F.col("pos"))), F.max(F.size("tokens"))).alias("prefix"),
    )
    return grouped


def _names(members: Column, upto: Column) -> Column:
    inside = F.filter(members, lambda m: m["pos"] < upto)
    return F.array_join(F.transform(inside, lambda m: m["name"]), ",")


def list_members(lists: DataFrame, enctypes: DataFrame | None = None) -> DataFrame:
    """One row per list and distinct known enctype offered anywhere in it."""
    return list_sequence(lists, enctypes).select(*KEY, "enctype_num")


def list_sequence(lists: DataFrame, enctypes: DataFrame | None = None) -> DataFrame:
    """Members with their ordinal and running list texts.

    `seq_num` and the texts are NULL for members outside the longest prefix of known,
    distinct enctypes.
    """
    grouped = _by_list(lists, enctypes)
    member = F.explode(F.filter("members", lambda m: m["fits"])).alias("m")
    rows = grouped.select(*KEY, "members", "prefix", member)
    at = F.col("m.pos")
    sequenced = at < F.col("prefix")
    upto = at + 1
    text = F.array_join(F.slice(tokens(F.col("enctype_list")), F.lit(1), upto), " ")
    return rows.select(
        *KEY,
        F.col("m.enctype").alias("enctype_num"),
        F.when(sequenced, at).alias("seq_num"),
        F.when(sequenced, text).alias("partial_enctype_list"),
        F.when(sequenced, _names(F.col("members"), upto)).alias("partial_enctype_name_list"),
    )


def list_flags(lists: DataFrame, enctypes: DataFrame | None = None) -> DataFrame:
    """The list dimension: names of the prefix and the three strength flags."""
    grouped = _by_list(lists, enctypes)
    members, prefix = F.col("members"), F.col("prefix")

    def first_in_prefix(weak: int) -> Column:
        hits = F.filter(members, lambda m: (m["pos"] < prefix) & (m["is_weak"] == weak))
        return F.coalesce(F.array_min(F.transform(hits, lambda m: m["pos"])), F.lit(0))

    def any_member(flag: str) -> Column:
        return F.exists(members, lambda m: m[flag] == 1).cast("int")

    return grouped.select(
        *KEY,
        F.when(prefix > 0, _names(members, prefix)).alias("enctype_name_list"),
        any_member("is_modern").alias("modern_client"),
        any_member("is_weak").alias("is_weak"),
        (first_in_prefix(1) < first_in_prefix(0)).cast("int").alias("is_too_weak"),
    )
