"""Documents to a training mix: five stages, each one of the training-data operators.

Every stage gets the documents that the one before it kept, as they were written and read again, and
returns the columns of `documents`; the last one adds the places in the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from realmwatch.llm.decontaminate import contamination, match_benchmark
from realmwatch.llm.minhash_dedup import drop_near_duplicates
from realmwatch.llm.mixing import mix_documents
from realmwatch.llm.queries import MIX_OTHER, MIX_WEIGHTS
from realmwatch.llm.suffix_dedup import remove_repeats
from realmwatch.llm.texts import stored, table
from realmwatch.llm.toxicity import fit_toxicity, score_toxicity


def _whole_row(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5; learned from the labels of those that are not held out."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, [_whole_row(docs)]).where("score < 0.5").select("row.*")


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near-duplicates, the document of the smallest id."""
    return drop_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 200 bytes that stand in more than one place."""
    kept = remove_repeats(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stands in benchmark windows."""
    matched = match_benchmark(docs, table(spark, sf_dir, "benchmark"), [_whole_row(docs)])
    return contamination(matched).where("NOT contaminated").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix."""
    return mix_documents(docs, weights=MIX_WEIGHTS, other=MIX_OTHER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("minhash_dedup", minhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Trained scores, hashing and scheduling have no SQL form; the tests compare with a plain version.
ORACLE_SQL = None
