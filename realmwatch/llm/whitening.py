"""Whitening of embeddings with MLlib's distributed block matrices.

Entries become whole numbers on a fixed grid, and the vectors that differ there are the fit list: each
counts once, however many rows hold it.  Their centred rows are dealt into blocks of a distributed matrix
whose transpose times itself is the scatter; its eigenvectors, taken on the driver from a matrix as
small as the vectors are long, make the whitening matrix, and multiplying blocks of all rows by it
projects them.  Sums are whole numbers of any size, so the mean has no rounding, and rows are centred
before they are multiplied.

Blocks have a fixed number of rows and are made where the rows lie; the last one of a task is filled up
with rows of zeros, which add nothing.  The scatter is summed in groups of a few blocks and then
over groups, so no task meets all of them.  The list of block numbers is what the driver holds.

Rows whose vector is null or holds null or non-finite entries are dropped, and so are rows whose vector
has another length than most rows (of two equally common lengths the greater counts): they share no
space with the others.  Entries beyond 2**46 in size are taken as 2**46.  A null id is an id of its own.
Repeated rows are rows of their own, and get equal values.  A component without variance keeps its place
with a null `whitened`; `explained` is null where nothing varies at all, and a deviation beyond 63 bits is
null.  An empty table gives an empty result.  Only the two named columns are read, so others may have any
name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch.llm.texts import shared_folder, ship

GRID, OFFSET = 64, 1_000_000
_MOST = float(2**46)
_BLOCK_BYTES = 1 << 20
_BLOCK_COLUMNS = 1024
_BLOCKS_A_TASK = 32
# Variance below this share of the whole is rounding.
_NO_VARIANCE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: its size, column sums, and the components by falling variance."""

    n: int
    sums: list[int]
    variances: list[float]  # of the components kept; 0 where there is none
    trace: float
    projection: np.ndarray  # length x components, scaled to unit variance
    identity_error: float

    @property
    def length(self) -> int:
        return len(self.sums)


def on_grid(vector: Column) -> Column:
    """Whole numbers floor(64 c) + 1000000 of a vector's entries."""
    scaled = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * GRID, F.lit(_MOST)), F.lit(-_MOST))))
    return F.transform(scaled, lambda v: v + OFFSET)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`id` and `x`, the vector on the grid, of the rows that have one of the table's length."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull()).where(finite)
    common = rows.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    length = common.length if common else 0
    return rows.where(F.size("v") == length).select("id", on_grid(F.col("v")).alias("x"))


def _numbers(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _column_sums(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """One row for each dimension: the sum over the task's rows, exact, as text; and their number."""
    sums, rows = [0] * length, 0
    for batch in batches:
        # below 2**47 each, and a batch has at most 2**16 rows in one addition
        x = _numbers(batch.column(0), length)
        for start in range(0, len(x), 1 << 15):
            sums = [a + int(b) for a, b in zip(sums, x[start : start + (1 << 15)].sum(0), strict=True)]
        rows += len(x)
    if rows:
        columns = [pa.array(range(length), pa.int32()), pa.array([str(s) for s in sums]), pa.array([rows] * length)]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "total", "rows"])


def _sums(fit: DataFrame, length: int) -> tuple[int, list[int]]:
    parts = fit.select("x").mapInArrow(partial(_column_sums, length=length), "at int, total string, rows bigint")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = sorted(parts.groupBy("at").agg(total, F.sum("rows").alias("rows")).collect())
    return (int(found[0].rows), [int(r.total) for r in found]) if found else (0, [])


def _away_from_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - sums: exact, in 64 bits where they hold it."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 2**62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _deviation(away: np.ndarray) -> list[int | None]:
    most = int(np.abs(away).max(initial=0))
    if most * most * max(away.shape[1], 1) < 2**63:
        return (away.astype(np.int64) ** 2).sum(1).tolist()
    exact = (away.astype(object) ** 2).sum(1).tolist()
    return [v if v < 2**63 else None for v in exact]


def _block_rows(
    batches: Iterator[pa.RecordBatch], n: int, sums: list[int], height: int, wide: int, names: list[str]
) -> Iterator[pa.RecordBatch]:
    """Blocks of centred rows: for each its task, number, column block and matrix, and with the first
    column block the ids and deviations of its rows."""
    length, task, number = len(sums), TaskContext.get().partitionId(), 0
    has_ids = "ids" in names

    def made(x: np.ndarray, ids: pa.Array | None) -> Iterator[pa.RecordBatch]:
        away = _away_from_mean(x, n, sums)
        centred = np.zeros((height, length))
        centred[: len(x)] = away.astype(np.float64) / n
        for first in range(0, length, wide):
            part = centred[:, first : first + wide]
            matrix = {
                "type": 1, "numRows": height, "numCols": part.shape[1], "colPtrs": None, "rowIndices": None,
                "values": part.T.ravel(), "isTransposed": False,
            }
            columns = [
                pa.array([task], pa.int32()), pa.array([number], pa.int64()), pa.array([first // wide], pa.int64()),
                pa.array([matrix], _ARROW_MATRIX),
            ]
            if has_ids:
                whole = pa.ListArray.from_arrays(pa.array([0, len(x) if first == 0 else 0], pa.int32()), ids)
                columns += [whole, pa.array([_deviation(away) if first == 0 else []], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    waiting, waiting_ids, held = [], [], 0
    for batch in batches:
        waiting.append(_numbers(batch.column(0), length))
        if has_ids:
            waiting_ids.append(batch.column(1))
        held += batch.num_rows
        if held < height:
            continue
        x, ids = np.concatenate(waiting), pa.concat_arrays(waiting_ids) if has_ids else None
        for start in range(0, held - height + 1, height):
            yield from made(x[start : start + height], ids.slice(start, height) if has_ids else None)
            number += 1
        rest = held - held % height
        waiting, held = [x[rest:]], held % height
        waiting_ids = [ids.slice(rest)] if has_ids else []
    if held:
        yield from made(np.concatenate(waiting), pa.concat_arrays(waiting_ids) if has_ids else None)


_ARROW_MATRIX = pa.struct(
    [
        pa.field("type", pa.int8(), False), pa.field("numRows", pa.int32(), False), pa.field("numCols", pa.int32(), False),
        pa.field("colPtrs", pa.list_(pa.int32())), pa.field("rowIndices", pa.list_(pa.int32())),
        pa.field("values", pa.list_(pa.float64())), pa.field("isTransposed", pa.bool_(), False),
    ]
)
# The same columns, all of them nullable, as a task returns them.
_MATRIX = "struct<type:tinyint,numRows:int,numCols:int,colPtrs:array<int>,rowIndices:array<int>,values:array<double>,isTransposed:boolean>"


class _Blocks:
    """Centred rows as blocks in the shared folder, and the matrix they make."""

    def __init__(self, rows: DataFrame, n: int, sums: list[int]) -> None:
        self.spark, self.length = rows.sparkSession, len(sums)
        self.height = max(1, _BLOCK_BYTES // (8 * self.length))
        self.wide = min(_BLOCK_COLUMNS, self.length)
        self.path = shared_folder(self.spark, "whitening-blocks")
        schema = f"task int, number bigint, part bigint, m {_MATRIX}"
        names = ["task", "number", "part", "m"]
        if "id" in rows.columns:
            schema += f", ids array<{rows.schema['id'].dataType.simpleString()}>, deviations array<bigint>"
            names += ["ids", "deviations"]
            rows = rows.select("x", "id")
        self.schema = schema
        make = partial(_block_rows, n=n, sums=sums, height=self.height, wide=self.wide, names=names)
        made = rows.mapInArrow(make, schema)
        made.write.option("parquet.block.size", 16 * _BLOCK_BYTES).parquet(self.path)

    def _numbered(self, blocks: DataFrame) -> DataFrame:
        """Blocks with their row of blocks: numbers run on from task to task, and there are few tasks."""
        counted = self.spark.read.schema(self.schema).parquet(self.path).where("part = 0").groupBy("task").count()
        before = F.coalesce(F.sum("count").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return blocks.join(F.broadcast(counted.select("task", before.alias("before"))), "task").withColumn(
            "row", F.col("before") + F.col("number")
        )

    def matrix(self) -> BlockMatrix:
        stored = T.StructType(
            [T.StructField("task", T.IntegerType()), T.StructField("number", T.LongType()),
             T.StructField("part", T.LongType()), T.StructField("m", MatrixUDT())]
        )
        blocks = self._numbered(self.spark.read.schema(stored).parquet(self.path))
        at = F.struct(F.col("row").alias("_1"), F.col("part").alias("_2"))
        model = callMLlibFunc("createBlockMatrix", blocks.select(at.alias("at"), "m"), self.height, self.wide, 0, 0)
        return BlockMatrix(model, self.height, self.wide)

    def labels(self) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(self.path).where("part = 0")
        return self._numbered(rows.select("task", "number", "ids", "deviations")).select("row", "ids", "deviations")


def _gram(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times itself, with the long inner side summed in groups of some blocks."""
    groups = max(1, -(-matrix.numRowBlocks // _BLOCKS_A_TASK))
    turned = matrix.transpose()
    model = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, groups)
    return BlockMatrix(model, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _projected(spark: SparkSession, matrix: BlockMatrix, projection: np.ndarray) -> BlockMatrix:
    """The matrix times the whitening matrix, which is as small as a block of columns."""
    wide, kept = matrix.colsPerBlock, projection.shape[1]
    pieces = [
        ((k, 0), Matrices.dense(len(p), kept, p.T.ravel().tolist()))
        for k, p in ((k, projection[k * wide : (k + 1) * wide]) for k in range(matrix.numColBlocks))
    ]
    return matrix.multiply(BlockMatrix(spark.sparkContext.parallelize(pieces, 1), wide, kept))


def fit_whitening(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16
) -> Whitening | None:
    """The whitening of a table's vectors, each one that differs from the others counted once; None
    without any."""
    return _fit(usable(vectors, id_col, vector_col), components)


def _fit(rows: DataFrame, components: int) -> Whitening | None:
    spark = rows.sparkSession
    ship(spark)
    path = shared_folder(spark, "whitening-fit")
    # equal vectors meet on the map side first, so a vector of many copies is one row of each task
    rows.select("x").distinct().write.parquet(path)
    fit = spark.read.schema("x array<bigint>").parquet(path)
    first = fit.first()
    if first is None or not len(first.x):
        return None
    length = len(first.x)
    n, sums = _sums(fit, length)
    matrix = _Blocks(fit, n, sums).matrix()
    covariance = _gram(matrix) / n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    falling = np.argsort(values)[::-1][:components]
    values, directions, trace = values[falling], directions[:, falling], float(np.trace(covariance))
    varies = values > _NO_VARIANCE * max(trace, np.finfo(float).tiny)
    values = np.where(varies, values, 0.0)
    projection = np.where(varies, directions / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    error = 0.0
    if varies.any():
        spread = _gram(_projected(spark, matrix, projection)) / n
        error = float(np.abs(spread - np.diag(varies.astype(float))).max())
    return Whitening(n, sums, values.tolist(), trace, projection, error)


def whiten(
    vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """A row for every row and component: id, component, deviation and whitened value.

    The vectors need not be those of the fit; rows of another length than its vectors are dropped.
    """
    return _whiten(usable(vectors, id_col, vector_col), model, id_col)


def _whiten(rows: DataFrame, model: Whitening, id_col: str) -> DataFrame:
    spark = rows.sparkSession
    ship(spark)
    blocks = _Blocks(rows.where(F.size("x") == model.length), model.n, model.sums)
    kept = len(model.variances)
    empty = f"`{id_col}` {rows.schema['id'].dataType.simpleString()}, component int, deviation bigint, whitened double"
    if not kept or spark.read.schema(blocks.schema).parquet(blocks.path).isEmpty():
        return spark.createDataFrame([], empty)
    path = shared_folder(spark, "whitening-projected")
    product = _projected(spark, blocks.matrix(), model.projection)
    made = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
    made.toDF("at", "m").write.option("parquet.block.size", 16 * _BLOCK_BYTES).parquet(path)
    stored = spark.read.schema(f"at struct<_1:int,_2:int>, m {_MATRIX}").parquet(path)
    projected = stored.select(F.col("at._1").cast("bigint").alias("row"), F.col("m.values").alias("values"))
    cells = projected.join(blocks.labels(), "row")
    # column by column in the matrix, row by row here
    varies = F.array(*[F.lit(v > 0) for v in model.variances])
    place = F.sequence(F.lit(0), F.size("ids") * kept - 1)

    def cell(t: Column) -> Column:
        row, component = F.floor(t / kept).cast("int"), (t % kept).cast("int")
        value = F.get("values", component * blocks.height + row)
        return F.struct(
            F.get("ids", row).alias(id_col),
            (component + 1).alias("component"),
            F.get("deviations", row).alias("deviation"),
            F.when(F.get(varies, component), value).alias("whitened"),
        )

    return cells.select(F.inline(F.transform(place, cell)))


def whitening_report(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16
) -> DataFrame:
    """Every row's whitened components, with the size of the fit list, the share of variance that each
    component explains, and how far the whitened covariance is from the identity."""
    rows = usable(vectors, id_col, vector_col)
    model = _fit(rows, components)
    if model is None:
        kind = rows.schema["id"].dataType.simpleString()
        schema = (
            f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
            "identity_error double"
        )
        return vectors.sparkSession.createDataFrame([], schema)
    share = [v / model.trace if model.trace > 0 else None for v in model.variances]
    shares = F.array(*[F.lit(s).cast("double") for s in share])
    return _whiten(rows, model, id_col).select(
        id_col,
        "component",
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
