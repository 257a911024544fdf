"""Averages over daily slices, and the trends they show.

Decayed averages are kept, not recomputed: a slice counts half as much for every half-life that has passed
since.  Weights are taken from the beginning of a long period, not from the newest slice, so a kept row is a
plain sum, batches add up in any order, and only reading brings periods to one date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from realmwatch.schemas import CLIENT_COUNTS, DAY_SECONDS

HALF_LIFE = 7 * DAY_SECONDS
# Weights within a period stay below 2^52.
_PERIOD = 52


def _rates(slices: DataFrame) -> list[str]:
    return [c for c in slices.columns if c.endswith("_rate")]


def running_averages(slices: DataFrame, keys: list[str], rows: int = 7) -> DataFrame:
    """Mean of each rate over a key's last `rows` slices.

    The window holds one row per key and day, so its groups are bounded by the days kept.
    """
    recent = Window.partitionBy(*keys).orderBy("starttime").rowsBetween(1 - rows, 0)
    return slices.select(
        *keys,
        "starttime",
        "endtime",
        *[F.avg(c).over(recent).alias(f"{c}_avg") for c in _rates(slices)],
    )


def period_averages(slices: DataFrame) -> DataFrame:
    """Mean of each rate over all slices of a period, with its bounds."""
    return slices.groupBy("starttime", "endtime").agg(
        F.count("*").alias("nslices"), *[F.avg(c).alias(f"{c}_avg") for c in _rates(slices)]
    )


def decayed_counts(
    slices: DataFrame, keys: list[str], counts: list[str] = CLIENT_COUNTS, half_life: int = HALF_LIFE
) -> DataFrame:
    """Sums of a key's counts by period, each slice weighted by how late in the period it began."""
    period = F.floor(F.col("starttime") / (half_life * _PERIOD))
    weight = F.pow(F.lit(2.0), (F.col("starttime") - F.col("period") * (half_life * _PERIOD)) / half_life)
    weighted = slices.withColumn("period", period).withColumn("weight", weight)
    return weighted.groupBy(*keys, "period").agg(
        F.max("starttime").alias("last_start"),
        F.sum(F.col("weight") * F.col("nentries")).alias("nentries"),
        *[F.sum(F.col("weight") * F.col(c)).alias(c) for c in counts],
    )


def decayed_averages(
    sums: DataFrame, keys: list[str], counts: list[str] = CLIENT_COUNTS, half_life: int = HALF_LIFE
) -> DataFrame:
    """Of kept sums: each count's decayed share of the entries, and the entries that still weigh.

    A key has one row for each period of a year or so, so its group is small.
    """
    of_key = Window.partitionBy(*keys)
    last = F.max("last_start").over(of_key)
    begin = F.col("period") * (half_life * _PERIOD)
    dated = sums.withColumn("last", last).withColumn("scale", F.pow(F.lit(2.0), (begin - F.col("last")) / half_life))
    weighed = dated.groupBy(*keys).agg(
        F.max("last").alias("last_start"),
        F.sum(F.col("nentries") * F.col("scale")).alias("weight"),
        *[F.sum(F.col(c) * F.col("scale")).alias(c) for c in counts],
    )
    shares = [F.try_divide(F.col(c), F.col("weight")).alias(f"{c.removeprefix('n')}_decayed_avg") for c in counts]
    return weighed.select(*keys, "last_start", "weight", *shares)


def trend_slopes(rated: DataFrame, keys: list[str]) -> DataFrame:
    """Change of each rate per day, by least squares over a key's slices; NULL for fewer than two."""
    day = F.col("starttime") / DAY_SECONDS
    slopes = [
        F.when(F.count(c) > 1, F.regr_slope(F.col(c), day)).alias(f"{c.removesuffix('_rate')}_slope") for c in _rates(rated)
    ]
    return rated.groupBy(*keys).agg(F.count("*").alias("nslices"), *slopes)
