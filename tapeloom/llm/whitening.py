"""Embedding whitening over MLlib's distributed matrices.

Entries become whole numbers, so that sums are exact. Centred rows are indexed into the blocks of a BlockMatrix;
its transpose times itself is the scatter, whose eigenvectors are found locally, as it is as small as a vector is
long; and the BlockMatrix times the whitening matrix projects every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom import scratch

# Entries are floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
# A block holds about this many bytes, and this many rows at least.
BLOCK_BYTES, LEAST_ROWS = 8 * 1024 * 1024, 256


@dataclass(frozen=True)
class Fit:
    """Rows, exact sums per dimension, eigenvalues from the largest on, eigenvectors in columns, and the trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whitening(self, components: int) -> np.ndarray:
        """Dimensions by components: a column is an eigenvector over the root of its eigenvalue.

        An eigenvalue that is 0 but for rounding has no spread to scale; its column is 0.
        """
        least = max(self.values[:1].sum(), 0.0) * len(self.sums) * np.finfo(float).eps
        held = self.values[:components]
        scales = np.where(held > least, 1 / np.sqrt(np.where(held > least, held, 1)), 0)
        return self.vectors[:, :components] * scales


def whole_numbers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x, an array of bigint, of each row whose vector can be used.

    A vector that is NULL, or holds a NULL or an entry that is not finite, is dropped. Where vectors are of
    several lengths, those of the most frequent length are used, the longest of such, and vectors without entries never.
    """
    given = F.transform(F.col(column), lambda entry: entry.cast("double"))
    usable = F.forall(given, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), given.alias("c"))
    rows = rows.where(F.col("c").isNotNull() & (F.size("c") > 0) & F.coalesce(usable, F.lit(False)))
    lengths = rows.groupBy(F.size("c").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    rows = rows.where(F.size("c") == (first["length"] if first else 0))
    return rows.select("vec_id", F.transform("c", lambda c: F.floor(c * SCALE) + OFFSET).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def sums_of(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and the exact sum of each dimension; tasks sum up their own rows first.

    An error where rows times the largest entry, which bounds all that follows, is over 2^62.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, most = 0, None, 0
        for batch in batches:
            if batch.num_rows:
                own = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                n, most = n + batch.num_rows, max(most, int(own.max()), -int(own.min()))
                if n * most >= 1 << 62:
                    raise ValueError("the entries are too large for exact sums in 64 bits")
                sums = own.sum(axis=0) if sums is None else sums + own.sum(axis=0)
        if n:
            same = [pa.array([value] * len(sums), pa.int64()) for value in (n, most)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums), *same], ["at", "s", "n", "most"])

    partial = rows.select("x").mapInArrow(run, "at int, s bigint, n bigint, most bigint")
    each = partial.groupBy("at").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("most").alias("most"))
    found = each.orderBy("at").collect()  # a row for each dimension
    n = found[0]["n"] if found else 0
    if any(n * row["most"] >= 1 << 62 for row in found):
        raise ValueError("the entries are too large for exact sums in 64 bits")
    return n, np.array([row["s"] for row in found], np.int64)


def centred(rows: DataFrame, n: int, sums: np.ndarray) -> DataFrame:
    """A written table: vec_id, index from 0, x - S/n as doubles, and the exact sum of (n*x - S)^2.

    n*x - S is a whole number, so each centred entry is rounded once. The squares are summed up as Python
    numbers where 64 bits might not hold them.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((n, sums))  # one number for each dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = shared.value
        width = len(sums)
        for batch in batches:
            if not batch.num_rows:
                continue
            moved = _matrix(batch.column("x"), width) * n - sums
            if np.abs(moved).max() < 3e9 / np.sqrt(width):
                deviations = [str(value) for value in (moved * moved).sum(axis=1).tolist()]
            else:
                deviations = [str(sum(value * value for value in row)) for row in moved.tolist()]
            ends = pa.array(np.arange(0, moved.size + 1, width).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array((moved / n).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), lists, pa.array(deviations)], ["vec_id", "centred", "deviation"]
            )

    made = rows.mapInArrow(run, "vec_id bigint, centred array<double>, deviation string")
    numbered = scratch.keep(made.withColumn("id", F.monotonically_increasing_id()), "centred")
    # Rows are numbered inside each task; one count for each task makes the numbers run on.
    task = F.shiftright("id", 33)
    counts = {row["task"]: row["n"] for row in numbered.groupBy(task.alias("task")).count().withColumnRenamed("count", "n").collect()}
    before = np.cumsum([0, *(counts[key] for key in sorted(counts))]).tolist()
    offsets = spark.createDataFrame(list(zip(sorted(counts), before)), "task bigint, before bigint")
    met = numbered.withColumn("task", task).join(F.broadcast(offsets), "task")  # a row for each task
    at = F.col("before") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    return met.select("vec_id", at.alias("index"), "centred", "deviation")


def block_matrix(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """The centred rows as blocks of whole rows; a block is small whatever the number of rows."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, BLOCK_BYTES // (8 * width))
    per_block = min(most, max(LEAST_ROWS, -(-n // parts)))
    vectors = rows.select("index", array_to_vector("centred").alias("vector"))
    old = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    matrix = IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", old, n, width), n, width)
    return matrix.toBlockMatrix(per_block, width)


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """The product, with the dimension in the middle dealt over ``splits`` tasks, which Python's own call leaves at one."""
    other = right._java_matrix_wrapper._java_model
    made = left._java_matrix_wrapper.call("multiply", other, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def decomposed(matrix: BlockMatrix, n: int, sums: np.ndarray, parts: int) -> Fit:
    """Covariance by the blocks' products, summed up in the cluster; only the small square comes back."""
    scatter = _times(matrix.transpose(), matrix, min(parts, matrix.numRowBlocks)).toLocalMatrix().toArray()
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    return Fit(n, sums, values[::-1].copy(), vectors[:, ::-1].copy(), float(np.trace(covariance)))


def projected(spark: SparkSession, matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """index and ``whitened``, an array, of every row: the blocks times the matrix of weights."""
    width, components = weights.shape
    block = ((0, 0), DenseMatrix(width, components, weights.ravel(order="F").tolist()))
    right = BlockMatrix(spark.sparkContext.parallelize([block], 1), width, components)
    product = matrix.multiply(right).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("whitened"))


def identity_error(rows: DataFrame, components: int) -> float:
    """The largest entry of the covariance of ``whitened`` less the identity, over all rows."""
    of = [F.get("whitened", F.lit(i)) for i in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    found = rows.agg(*[F.covar_pop(of[i], of[j]).alias(f"c_{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c_{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, and deviation_exact.

    One row for each usable row and component, up to ``components`` or the length of the vectors. A vector
    counts as ``whole_numbers`` says; repeated rows and NULL ids are rows like others. ``deviation`` is the
    sum of (n*x - S)^2; where 64 bits do not hold it, it is NULL, and ``deviation_exact`` has it as text.
    Components go by falling eigenvalue of the covariance of x. One without spread, as of equal rows, has
    ``whitened`` 0; without any spread ``explained`` is 0. No usable rows: no rows. Other columns are not
    read. Entries so large that rows times the largest one is over 2^62 are an error.
    """
    spark = vectors.sparkSession
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double, deviation_exact string"
    )
    rows = scratch.keep(whole_numbers(vectors, column), "vectors")
    n, sums = sums_of(rows)
    if not n:
        return spark.createDataFrame([], schema)
    width = len(sums)
    count = min(components, width)
    table = centred(rows, n, sums)
    matrix = block_matrix(table, n, width)
    fit = decomposed(matrix, n, sums, int(spark.conf.get("spark.sql.shuffle.partitions")))
    scores = scratch.keep(projected(spark, matrix, fit.whitening(count)), "whitened")
    error = identity_error(scores, count)
    shares = [float(value / fit.trace) if fit.trace > 0 else 0.0 for value in fit.values[:count]]
    met = table.drop("centred").join(scores, "index")
    each = met.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"),
        F.expr("try_cast(deviation as bigint)").alias("deviation"), "whitened",
        F.get(F.lit(shares), F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
        F.col("deviation").alias("deviation_exact"),
    )
