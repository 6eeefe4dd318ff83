"""Whitened projections of vectors on their principal components, with MLlib's distributed block matrices.

Entries become integers, so sums and deviations are exact. Each task lays its centred rows down as dense blocks of a BlockMatrix B, in the
form in which Spark stores MLlib matrices; B^T B is the scatter, whose eigenvectors are taken on the driver (as large as the vectors are
long, squared); B times the eigenvectors over the square roots of the eigenvalues gives the whitened rows, block by block. How
far their covariance is from the identity is measured on them, by another block product.

The multiplications stay in the JVM, and the driver sees sums and matrices of the vectors' length only. MLlib shuffles blocks, never
rows: the index of a row is that of its block and its place in it. (Blocks made by MLlib's own conversion of indexed rows took 30 s
for 50,000 vectors, as it serialises every entry by itself.) The middle dimension of B^T B is cut into ``SPLIT`` blocks a task, so no
task multiplies all rows.

Edge cases: rows whose vector is null, empty, or holds null or non-finite entries are left out, as are those of another
length than the most common one (of equally common ones the largest); null ids, repeated ids and rows count each; a component
without variance has whitened 0.0, which ``identity_error`` shows; explained is 0.0 where nothing varies; a deviation beyond 64 bits is null;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .scratch import stored
from .vectors import finite, matrix, scaled

ROWS = 1024  # of a block
SPLIT = 16
FLAT = 1e-12  # an eigenvalue below this share of the largest one counts as none
OUT = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"

MATRIX = MatrixUDT.sqlType()
DENSE = 1  # type of a dense matrix in it
PLACE = T.StructType([T.StructField("_1", T.LongType()), T.StructField("_2", T.LongType())])
BLOCKS = T.StructType([T.StructField("blockIndex", PLACE), T.StructField("subMatrix", MATRIX)])
AS_MATRICES = T.StructType([T.StructField("blockIndex", PLACE), T.StructField("subMatrix", MatrixUDT())])


def matrix_column(values: np.ndarray) -> pa.Array:
    """One dense matrix as Spark stores it."""
    fields = {"type": DENSE, "numRows": values.shape[0], "numCols": values.shape[1], "colPtrs": None, "rowIndices": None,
              "values": None, "isTransposed": False}
    kinds = {"type": pa.int8(), "numRows": pa.int32(), "numCols": pa.int32(), "colPtrs": pa.list_(pa.int32()),
             "rowIndices": pa.list_(pa.int32()), "isTransposed": pa.bool_()}
    flat = pa.array(values.ravel(order="F"))
    columns = [pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat) if n == "values" else pa.array([v], kinds[n])
               for n, v in fields.items()]
    return pa.StructArray.from_arrays(columns, list(fields))


def local_matrices(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    """Stored matrices of a batch as arrays."""
    found = batch.column(column)
    shapes = zip(*[found.field(n).to_pylist() for n in ("numRows", "numCols", "isTransposed")])
    values = found.field("values")
    out = []
    for i, (rows, cols, transposed) in enumerate(shapes):
        flat = values[i].values.to_numpy()
        out.append(flat.reshape(rows, cols) if transposed else flat.reshape(cols, rows).T)
    return out


def centred_blocks(vectors: DataFrame, n: int, sums: list[int], kind: str) -> DataFrame:
    """part, number, ids and deviations of the rows of each block, and the block: x minus the mean, from exact integers.

    Blocks are numbered in the order of the task's rows and written once.
    """
    total = np.array(sums, np.int64)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        waiting: list[tuple[pa.Array, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            off = np.concatenate([x for _, x in waiting]) * n - total
            large = np.abs(off).max() >= 2 ** 31 / np.sqrt(off.shape[1])
            deviations = [_long(sum(v * v for v in row)) for row in off.tolist()] if large else np.einsum("ij,ij->i", off, off).tolist()
            ids = pa.concat_arrays([i for i, _ in waiting])
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([deviations], pa.list_(pa.int64())), matrix_column(off / n)],
                ["part", "number", "ids", "deviations", "subMatrix"])

        rows = 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                piece = batch.slice(start, ROWS - rows)
                waiting.append((piece.column("vec_id"), matrix(piece, "x")))
                start, rows = start + piece.num_rows, rows + piece.num_rows
                if rows == ROWS:
                    yield block()
                    number, rows, waiting = number + 1, 0, []
        if rows:
            yield block()

    shape = f"part int, number long, ids array<{kind}>, deviations array<long>, subMatrix {MATRIX.simpleString()}"
    blocks = stored(vectors.mapInArrow(lay, shape), "centred")
    parts = blocks.groupBy("part").agg(F.count(F.lit(1)).alias("blocks"))  # one row per task
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("blocks").over(order), F.lit(0)).alias("before"))
    return blocks.join(before, "part").withColumn("block", F.col("before") + F.col("number"))


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None


def block_matrix(blocks: DataFrame, dims: int) -> BlockMatrix:
    """Rows (block, subMatrix) as a distributed matrix, one block wide. Written and read again as MLlib matrices."""
    spark, path = blocks.sparkSession, scratch_path(blocks.sparkSession, "llm-blocks")
    index = F.struct(F.col("block").cast("long").alias("_1"), F.lit(0).cast("long").alias("_2"))
    blocks.select(index.alias("blockIndex"), "subMatrix").write.parquet(path)
    made = callMLlibFunc("createBlockMatrix", spark.read.schema(AS_MATRICES).parquet(path), ROWS, dims, 0, 0)
    return BlockMatrix(made, ROWS, dims)


def stored_blocks(blocks: BlockMatrix, spark) -> DataFrame:
    """block and matrix of each block of a one block wide matrix, as plain columns."""
    path = scratch_path(spark, "llm-blocks")
    callMLlibFunc("getMatrixBlocks", blocks._java_matrix_wrapper._java_model).toDF("blockIndex", "subMatrix").write.parquet(path)
    return spark.read.schema(BLOCKS).parquet(path).select(F.col("blockIndex._1").alias("block"), "subMatrix")


def product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """left times right; ``splits`` cuts the middle dimension, so that a small result of long sides is made by many tasks."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transposed blocks times blocks, as a local matrix of the row length."""
    return product(blocks.transpose(), blocks, max(1, -(-blocks.numRowBlocks // SPLIT))).toLocalMatrix().toArray()


def local_block(spark, values: np.ndarray) -> BlockMatrix:
    """A small matrix as a BlockMatrix of one block."""
    block = Matrices.dense(*values.shape, values.flatten(order="F").tolist())
    return BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), *values.shape, *values.shape)


def whiten(vectors: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """One row per vector of (vec_id, embedding) and component, numbered from 1 by falling eigenvalue."""
    spark, kind = vectors.sparkSession, dict(vectors.dtypes)["vec_id"]
    rows = stored(vectors.filter(finite("embedding") & (F.size("embedding") > 0)).select("vec_id", scaled("embedding", scale, shift).alias("x")), "vectors")
    common = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if common is None:
        return spark.createDataFrame([], OUT.format(kind))
    dims, n = common.dims, common.n
    rows = rows.filter(F.size("x") == dims)
    sums = list(rows.agg(*[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(dims)]).first())
    blocks = stored(centred_blocks(rows, n, sums, kind).select("block", "ids", "deviations", "subMatrix"), "blocks")
    given = block_matrix(blocks, dims)
    spread = scatter(given) / n
    values, axes = np.linalg.eigh(spread)
    k = min(components, dims)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    live = values > FLAT * max(values[0], 0)
    weights = np.where(live, axes / np.sqrt(np.where(live, values, 1)), 0)
    white = stored_blocks(product(given, local_block(spark, weights)), spark)
    error = identity_error(white, n, k)
    total = float(np.trace(spread))
    explained = [float(max(v, 0) / total) if total else 0.0 for v in values]

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, z in enumerate(local_matrices(batch, "subMatrix")):
                m, ids, deviations = len(z), batch.column("ids")[i].values, batch.column("deviations")[i].values
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                    deviations.take(each), pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.drop("subMatrix").join(white, "block").select("ids", "deviations", "subMatrix").mapInArrow(unfold, OUT.format(kind))


def identity_error(white: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, centred before multiplying."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k)
        for batch in batches:
            for z in local_matrices(batch, "subMatrix"):
                total += z.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    parts = white.select("subMatrix").mapInArrow(add, "sums array<double>")
    means = np.array(parts.agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(k)]).first()) / n
    covariance = scatter(block_matrix(on_matrices(white, lambda z: z - means), k)) / n
    return float(np.abs(covariance - np.eye(k)).max())


def on_matrices(blocks: DataFrame, change: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(block, subMatrix) with every matrix changed."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, z in enumerate(local_matrices(batch, "subMatrix")):
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), matrix_column(change(z))], ["block", "subMatrix"])

    return blocks.select("block", "subMatrix").mapInArrow(each, f"block long, subMatrix {MATRIX.simpleString()}")
