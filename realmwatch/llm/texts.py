"""Reading tables and texts, shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def to_bytes(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null is empty."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def words(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased, as UTF-8."""
    return to_bytes(text).translate(_WORD_BYTES).split()


def blank_words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased, as UTF-8."""
    return to_bytes(text).translate(_LOWER_BYTES).split()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable for Python on the executors, once per application.

    Nothing is sent where it is installed or on PYTHONPATH, which executors have as well.
    """
    context = spark.sparkContext
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home in known or home.endswith("site-packages") or context.applicationId in _SHIPPED:
        return
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "realmwatch"), "zip", home, "realmwatch")
    context.addPyFile(made)
    _SHIPPED.add(context.applicationId)


def map_texts(
    docs: DataFrame,
    text: str,
    keep: Iterable[str | Column],
    rows: Callable[[list[str | None]], list[list]],
    fields: list[T.StructField],
) -> DataFrame:
    """`keep` columns of every row, and the columns that `rows` makes of a batch's texts.

    `rows` gets a list of texts and returns one list of values for each field.  Only the named
    columns are read, so other columns of `docs` are free to have any name.
    """
    ship(docs.sparkSession)
    kept = [F.col(c) if isinstance(c, str) else c for c in keep]
    base = docs.select(F.col(text).cast("string").alias("__text"), *kept)
    schema = T.StructType([*base.schema.fields[1:], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            made = rows(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array(v, t) for v, t in zip(made, kinds, strict=True))], names=schema.names
            )

    return base.mapInArrow(run, schema)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`, which every executor sees.

    Only where the session names none, and Spark runs on this machine alone, it is a temporary one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="realmwatch-llm-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again, which cuts its lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
