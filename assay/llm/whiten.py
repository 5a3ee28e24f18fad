"""Embedding whitening with MLlib's BlockMatrix.

Entries c become whole numbers x = floor(64 * c) + 1,000,000.  With n vectors and per-dimension
sums S, a centred entry is (n * x - S) / n, whose numerator is exact.  The centred rows get
dense indices and are cut into blocks of ``BLOCK_ROWS`` rows; the scatter matrix is a
transpose-multiply of block matrices, its eigenvectors come from ``numpy.linalg.eigh`` on the
driver (dimensions x dimensions numbers, whatever the number of rows), and a second block
multiplication by the whitening matrix projects all rows.

A block product adds up all blocks of its inner dimension in one place.  For the scatter
matrix that would be one place for all rows, so row block t stands in column t div a on the left side and
t mod a on the right, a * a at least the number of groups: the product is then a grid of a * a
partial scatter matrices, one per group of row blocks, and their sum is the scatter matrix.  The
projection uses the same grid: row blocks are laid out in ``a`` columns, and the right side holds
the whitening matrix a times on its diagonal, so that the product is spread over all partitions.

Defined results: rows whose vector is null, or holds null or non-finite entries, are dropped; a
null ``vec_id`` stays null; shorter vectors count as padded with zeros; repeated rows count
as often as they stand there; other columns are ignored; no rows left, no result.  Components whose eigenvalue is
zero within double precision (fewer rows than dimensions, constant dimensions) have no
whitened value and are left out.  The sign of a component makes its largest entry positive.
A deviation that does not fit into a long raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import RDD
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

SCALE, SHIFT = 64, 1_000_000    # of the whole numbers; fixed by the query's definition
BLOCK_ROWS = 1024
GROUP_BLOCKS = 4                # row blocks of a partial scatter matrix, about


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` (array<long>) of the rows that take part."""
    c = F.col("embedding")
    fine = c.isNotNull() & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("long") + SHIFT).alias("x"))


def _longs(values: list[int]):
    return F.from_json(F.lit(str(values)), "array<long>")


def centre(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """``idx, vec_id, dev`` (array of n * x - S), n and the number of dimensions."""
    rows = cut(rows)    # fixed partitions: the indices below are the same in every pass
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n or not dims:
        return rows.select(F.lit(0).cast("long").alias("idx"), "vec_id", F.col("x").alias("dev")), n, 0
    missing = F.lit(dims) - F.size("x")
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), missing)))
    sums = {r["pos"]: r["s"] for r in rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).collect()}
    total = _longs([sums[i] for i in range(dims)])
    placed = rows.withColumn("part", F.spark_partition_id()).withColumn(
        "place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    counts = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}     # one per partition
    starts, at = [], 0
    for part in sorted(counts):
        starts.append((part, at))
        at += counts[part]
    offset = rows.sparkSession.createDataFrame(starts, "part int, start long")
    dev = F.zip_with("x", total, lambda x, s: x * F.lit(n).cast("long") - s)
    return placed.join(offset, "part").select((F.col("start") + F.col("place")).alias("idx"), "vec_id", dev.alias("dev")), n, dims


def row_blocks(centred: DataFrame, n: int, dims: int) -> RDD:
    """((row block, 0), matrix) of the centred rows."""
    rows = centred.select("idx", array_to_vector(F.transform("dev", lambda v: v.cast("double") / n)).alias("v"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v"), n, dims)
    return matrix.toBlockMatrix(BLOCK_ROWS, dims).blocks


def _side(blocks: int, per_group: int) -> int:
    groups = -(-blocks // per_group)
    return max(1, int(np.ceil(np.sqrt(groups))))


def scatter(blocks: RDD, n: int, dims: int) -> np.ndarray:
    """Sum of the rows' outer products: a grid of partial sums, each one block of a product, then their sum."""
    side = _side(-(-n // BLOCK_ROWS), GROUP_BLOCKS)
    cells = side * side

    def layout(column) -> BlockMatrix:
        return BlockMatrix(blocks.map(lambda b: ((b[0][0], column(b[0][0] % cells)), b[1])), BLOCK_ROWS, dims, n, side * dims)

    left, right = layout(lambda t: t // side), layout(lambda t: t % side)
    partial = left.transpose().multiply(right).blocks.map(lambda b: b[1].toArray())
    return partial.treeAggregate(np.zeros((dims, dims)), np.add, np.add)


def project(blocks: RDD, weights: np.ndarray, n: int) -> RDD:
    """((row block, 0), matrix) of the rows times ``weights``."""
    dims, kept = weights.shape
    count = -(-n // BLOCK_ROWS)
    side = _side(count, 1)
    deep = -(-count // side)
    rows = BlockMatrix(blocks.map(lambda b: ((b[0][0] // side, b[0][0] % side), _full(b[1]))),
                       BLOCK_ROWS, dims, deep * BLOCK_ROWS, side * dims)
    w = DenseMatrix(dims, kept, weights.ravel(order="F"))
    diagonal = blocks.context.range(side).map(lambda q: ((q, q), w))
    out = rows.multiply(BlockMatrix(diagonal, dims, kept, side * dims, side * kept)).blocks

    def back(b):
        t = b[0][0] * side + b[0][1]
        return (t, 0), _matrix(b[1].toArray()[:min(BLOCK_ROWS, n - t * BLOCK_ROWS)])
    return out.map(back)


def _matrix(a: np.ndarray) -> DenseMatrix:
    return DenseMatrix(*a.shape, a.ravel(order="F"))


def _full(block) -> DenseMatrix:
    """The last block is shorter than the others; in the grid all have one height."""
    a = block.toArray()
    return _matrix(np.pad(a, ((0, BLOCK_ROWS - len(a)), (0, 0))))


def principal(scattered: np.ndarray, n: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of scatter / n that are not zero, ``limit`` at most, and their unit vectors as columns."""
    cov = (scattered + scattered.T) / (2 * n)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = values > max(values[0], 0) * len(values) * 1e-14
    values, vectors = values[keep][:limit], vectors[:, keep][:, :limit]
    if values.size:
        top = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
        vectors = vectors * np.sign(top)
    return values, vectors


def _identity_error(whitened: RDD, n: int, kept: int) -> float:
    sums = whitened.map(lambda b: b[1].toArray().sum(axis=0)).treeAggregate(np.zeros(kept), np.add, np.add)
    mean = sums / n
    centred = whitened.map(lambda b: (b[0], _matrix(b[1].toArray() - mean)))
    return float(np.abs(scatter(centred, n, kept) / n - np.eye(kept)).max())


def whiten(vectors: DataFrame, limit: int = 32) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row and component."""
    centred, n, dims = centre(whole_numbers(vectors))
    deviation = F.aggregate("dev", F.lit(0).cast("long"), lambda a, v: a + v * v)
    blocks = values = None
    if dims:
        blocks = row_blocks(centred, n, dims)
        scattered = scatter(blocks, n, dims)
        values, axes = principal(scattered, n, limit)
    if values is None or not values.size:
        return centred.where("false").select("vec_id", F.lit(1).alias("component"), F.lit(n).cast("long").alias("n"),
                                             deviation.alias("deviation"), *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])
    kept = len(values)
    whitened = project(blocks, axes / np.sqrt(values), n)
    error = _identity_error(whitened, n, kept)

    def rows(b) -> Iterator[tuple[int, list[float]]]:
        start = b[0][0] * BLOCK_ROWS
        return ((start + i, y) for i, y in enumerate(b[1].toArray().tolist()))

    placed = centred.sparkSession.createDataFrame(whitened.flatMap(rows), "idx long, y array<double>")
    explained = F.from_json(F.lit(str((values / (np.trace(scattered) / n)).tolist())), "array<double>")
    zeros = F.array_repeat(F.lit(0.0), kept)    # a block of nothing but zeros has no entry in a block matrix
    return centred.withColumn("deviation", deviation).drop("dev").join(placed, "idx", "left").select(
        "vec_id", "deviation", F.posexplode(F.coalesce("y", zeros)).alias("p", "whitened")).select(
        "vec_id", (F.col("p") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("p")).alias("explained"), F.lit(error).alias("identity_error"))
