"""Templates of failure messages: what messages have in common, without their variable parts.

A message is cut at blanks.  Words that are variable by their structure (principals, addresses, numbers,
paths) are masked first.  What is left is merged by a prefix tree of fixed depth, one level at a time: under a
code, a number of words and the template so far, a place with more than `most` different words is variable.
Places below the tree are judged one by one under the template of its leaf.  Every step is an aggregate over
different masked messages, of which a log has few; events are read once, and counted before they are
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from realmwatch.functions.times import day_start
from realmwatch.operators.conditions import COUNT, counted

ANY = "<*>"
# Masks, and what they stand for; the first that fits a word counts.
MASKS = {
    "<principal>": r"^[^@\s]+@[^@\s]+$",
    "<address>": r"^\[?(?:\d{1,3}(?:\.\d{1,3}){3}|[0-9a-fA-F]{0,4}(?::[0-9a-fA-F]{0,4}){2,7})\]?$",
    "<number>": r"^[-+#]?(?:0x[0-9a-fA-F]+|\d+(?:[.,:]\d+)*)%?$",
    "<path>": r"^/\S+$",
}
_EDGE = r"^([('\"]*)(.*?)([)'\",;:.!?]*)$"


def masked_words(message: Column) -> Column:
    """The message's words, those of a variable structure as their masks; punctuation around a word stays."""

    def mask(word: Column) -> Column:
        bare = F.regexp_extract(word, _EDGE, 2)
        name = F.coalesce(*[F.when(bare.rlike(pattern), F.lit(mask)) for mask, pattern in MASKS.items()])
        around = F.concat(F.regexp_extract(word, _EDGE, 1), name, F.regexp_extract(word, _EDGE, 3))
        return F.coalesce(around, word)

    return F.transform(F.filter(F.split(F.coalesce(message, F.lit("")), r"\s+"), lambda w: w != ""), mask)


def failure_templates(failure: DataFrame, depth: int = 4, most: int = 20) -> DataFrame:
    """Failures by code, template and day; every failure counts under one template."""
    if depth < 0 or most < 1:
        raise ValueError("depth is at least 0 and most at least 1")
    messages = (
        counted(failure)
        .groupBy("code", masked_words(F.col("reason")).alias("words"), day_start(F.col("log_time")).alias("starttime"))
        .agg(F.sum(COUNT).alias("nfail"))
    )
    merged = messages.withColumn("length", F.size("words")).withColumn("template", F.array().cast("array<string>"))
    for level in range(depth):
        merged = _merge_level(merged, level, most)
    merged = _merge_rest(merged, depth, most)
    return (
        merged.groupBy("code", F.array_join("template", " ").alias("template"), "starttime")
        .agg(F.sum("nfail").alias("nfail"))
        .select("code", "template", "starttime", "nfail")
    )


def _merge_level(messages: DataFrame, level: int, most: int) -> DataFrame:
    """The template longer by the word at one level of the tree, or by a wildcard."""
    node, word = ["code", "length", "template"], F.get("words", F.lit(level))
    known = messages.select(*node, word.alias("word")).where("word IS NOT NULL").distinct()
    wide = known.groupBy(*node).agg((F.count("*") > most).alias("wide"))
    # a message that has ended joins nothing and stays as it is
    return messages.join(wide, node, "left").select(
        *[c for c in messages.columns if c != "template"],
        F.when(word.isNull(), F.col("template"))
        .otherwise(F.concat("template", F.array(F.when(F.col("wide"), ANY).otherwise(word))))
        .alias("template"),
    )


def _merge_rest(messages: DataFrame, depth: int, most: int) -> DataFrame:
    """The words below the tree, a wildcard at each place that has too many under its leaf."""
    leaf = ["code", "length", "template"]
    rest = F.slice("words", depth + 1, F.greatest(F.size("words") - depth, F.lit(0)))
    places = messages.select(*leaf, F.posexplode(rest).alias("place", "word")).distinct()
    counted_places = places.groupBy(*leaf, "place").agg((F.count("*") > most).alias("wide"))
    wide = counted_places.where("wide").groupBy(*leaf).agg(F.collect_set("place").alias("places"))
    named = F.transform(rest, lambda w, i: F.when(F.array_contains(F.coalesce("places", F.array().cast("array<int>")), i), ANY).otherwise(w))
    return messages.join(wide, leaf, "left").select(
        *[c for c in messages.columns if c != "template"], F.concat("template", named).alias("template")
    )
