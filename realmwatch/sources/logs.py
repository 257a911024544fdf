"""Scans of raw log text and the line filters applied before parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_logs(spark: SparkSession, paths: str | Sequence[str], provenance: bool = False) -> DataFrame:
    """Lines of one or many log files, optionally with the file each came from."""
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths))
    if provenance:
        return lines.select("value", F.col("_metadata.file_path").alias("log_file"))
    return lines


def scan_stream(spark: SparkSession, directory: str, max_files: int | None = None) -> DataFrame:
    """Lines of log files as they arrive in a directory."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(directory)


def is_kdc_line(line: Column) -> Column:
    return line.contains("krb5kdc")


def is_local_tgt(line: Column) -> Column:
    """TGS request for the ticket-granting service of the realm that answers it.

    The realm after the @ only has to begin with the one before it.
    """
    candidate = line.contains("TGS_REQ") & line.contains("krbtgt/")
    return candidate & line.rlike(r"TGS_REQ.*krbtgt/(.*)@\1")


def kdc_lines(raw: DataFrame) -> DataFrame:
    return raw.where(is_kdc_line(F.col("value")))


def drop_local_tgt(raw: DataFrame) -> DataFrame:
    return raw.where(~is_local_tgt(F.col("value")))
