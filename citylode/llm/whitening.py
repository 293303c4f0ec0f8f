"""Whitening of embeddings with distributed block matrices.

Centred rows become a BlockMatrix; its transpose times itself is the scatter matrix, whose eigenvectors are
found on the driver; rows are projected by a product with the whitening matrix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylode.llm.blocks import finite, matrix, numbered, vector_column
from citylode.llm.common import small, stored

BLOCK = 1024  # rows and columns of a block: at most 8 MB
FLAT = 1e-12  # an eigenvalue below this share of their sum is none
LONG = 1 << 63
OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def with_index(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Stored rows with an ``index`` from 0 without gaps, so that blocks are full.

    A row's number tells its partition and its place in it; the partitions' sizes, one row a partition, are
    added up.
    """
    part = F.shiftright("row", 33)
    sizes = stored(spark, rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size")).select(
        "part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before")), "partition-sizes")
    placed = rows.withColumn("part", part).join(small(sizes), "part")
    return placed.withColumn("index", F.col("before") + F.col("row").bitwiseAND((1 << 33) - 1)).drop("part", "before")


def block_matrix(rows: DataFrame, name: str) -> BlockMatrix:
    """A table of ``index`` and an array of doubles as a BlockMatrix, made inside the JVM."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(name).alias(name)), name)
    return IndexedRowMatrix(vectors).toBlockMatrix(BLOCK, BLOCK)


def local_blocks(spark: SparkSession, values: np.ndarray) -> BlockMatrix:
    """A matrix of the driver in blocks; it has as many rows as the vectors have dimensions."""
    d, k = values.shape
    parts = []
    for i in range(0, d, BLOCK):
        for j in range(0, k, BLOCK):
            part = values[i:i + BLOCK, j:j + BLOCK]
            parts.append(((i // BLOCK, j // BLOCK), Matrices.dense(*part.shape, part.T.reshape(-1).tolist())))
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), BLOCK, BLOCK, d, k)


def rows_of(product: BlockMatrix, name: str) -> DataFrame:
    """The rows of a BlockMatrix as a table of ``index`` and an array, made inside the JVM."""
    rows = product.toIndexedRowMatrix()
    vectors = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return vectors.select("index", vector_to_array("vector").alias(name))


def split_product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left @ right, its inner dimension dealt to ``splits`` tasks; Python's own ``multiply`` does not pass that on."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def covariance(rows: DataFrame, name: str, width: int) -> np.ndarray:
    """The covariance of the components of an array, divisor n, centred where it is added up."""
    pairs = [(a, b) for a in range(width) for b in range(a, width)]
    found = rows.agg(*[F.covar_pop(F.col(name)[a], F.col(name)[b]) for a, b in pairs]).first()
    out = np.zeros((width, width))
    for (a, b), x in zip(pairs, found, strict=True):
        out[a, b] = out[b, a] = x
    return out


def deviations(levels: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S) ** 2 of each row; None if no long holds it."""
    reach = max(n * max(abs(int(levels.max())), abs(int(levels.min()))) + max(map(abs, sums)), 1)
    if reach * reach * levels.shape[1] < LONG:
        return np.square(n * levels - np.array(sums)).sum(axis=1).tolist()
    # The sums' own digits are of no use: rows less a common offset give the same differences.
    base = [s // n for s in sums]
    near, rest = levels - np.array(base, np.int64), [s - n * b for s, b in zip(sums, base, strict=True)]
    reach = n * max(abs(int(near.max())), abs(int(near.min())), 1) + n
    if reach * reach * levels.shape[1] < LONG:
        return np.square(n * near - np.array(rest)).sum(axis=1).tolist()
    exact = ((near.astype(object) * n - np.array(rest, object)) ** 2).sum(axis=1)
    return [x if x < LONG else None for x in exact.tolist()]


def whiten(
    spark: SparkSession, vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000,
    id_column: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error): each vector's projections.

    Entries c become x = floor(scale * c) + offset. All vectors are the fit list: n of them, with sums S by
    dimension. ``deviation`` is the sum over dimensions of (n * x - S) ** 2, exact, null if no long holds it;
    ``whitened`` is x - S / n on the component's unit eigenvector over the root of its eigenvalue; ``explained``
    is the eigenvalue over the sum of all; ``identity_error`` is the largest absolute difference of the
    covariance of ``whitened`` from the identity. Components count from 1 by falling eigenvalue. Those of
    an eigenvalue below 1e-12 of the sum are left out: with fewer dimensions or distinct vectors than
    ``components``, fewer are returned, none if all vectors are equal.

    Vectors that are null or hold null, NaN or infinite entries, or entries that fit no long as x, take no
    part. Where lengths differ, the most frequent one counts (the smaller of two), others take no part.
    A null id stays null; repeated ids and rows are rows of their own. An empty table gives no rows. Other
    columns are not read.
    """
    v = vector_column(vectors, vector)

    def too_large(x):
        return F.abs(x.cast("double") * scale) + abs(offset) >= float(1 << 62)

    rows = numbered(spark, vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), v.alias("raw"), finite(v, scale).alias("good")).filter(
        F.col("good") & (F.size("raw") > 0) & ~F.exists("raw", too_large)).select("vec_id", F.transform(
            "raw", lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset)).alias("x")), "levels")
    widths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(2).collect()
    if not widths:
        return spark.createDataFrame([], OUT)
    d = widths[0].d
    if len(widths) > 1:
        rows = numbered(spark, rows.filter(F.size("x") == d).drop("row"), "levels-of-one-length")
    rows = with_index(spark, rows)
    # Sums as decimals: exact, and added up before they are shuffled.
    sums = [int(r.s) for r in rows.select(F.posexplode("x").alias("k", "x")).groupBy("k").agg(
        F.sum(F.col("x").cast("decimal(19,0)")).alias("s")).orderBy("k").collect()]
    n = rows.count()

    def centre(batches):
        base = np.array([s // n for s in sums], np.int64)
        rest = np.array([(s - n * int(b)) / n for s, b in zip(sums, base, strict=True)])
        for batch in batches:
            if batch.num_rows:
                levels = matrix(pa.Table.from_batches([batch]), "x")
                centred = (levels - base).astype(np.float64) - rest
                yield pa.RecordBatch.from_arrays([
                    batch.column("index"), batch.column("vec_id"), pa.array(deviations(levels, n, sums), pa.int64()),
                    pa.FixedSizeListArray.from_arrays(pa.array(centred.reshape(-1)), d).cast(pa.list_(pa.float64()))],
                    ["index", "vec_id", "deviation", "centred"])

    centred = stored(spark, rows.select("index", "vec_id", "x").mapInArrow(
        centre, "index bigint, vec_id bigint, deviation bigint, centred array<double>"), "centred")
    blocks = block_matrix(centred, "centred")
    # The blocks' products are added up in as many tasks as hold blocks, not in the one of the result.
    splits = max(1, min(-(-n // BLOCK), 4 * spark.sparkContext.defaultParallelism))
    scatter = split_product(blocks.transpose(), blocks, splits).toLocalMatrix().toArray()
    values, directions = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    total = float(values.sum())
    order = [k for k in np.argsort(-values)[:components] if total > 0 and values[k] > FLAT * total]
    if not order:
        return spark.createDataFrame([], OUT)
    whitening = directions[:, order] / np.sqrt(values[order])
    projected = stored(spark, rows_of(blocks.multiply(local_blocks(spark, whitening)), "whitened"), "whitened")
    error = float(np.abs(covariance(projected, "whitened", len(order)) - np.eye(len(order))).max())
    shares = F.array(*[F.lit(float(values[k]) / total) for k in order])
    return centred.select("index", "vec_id", "deviation").join(projected, "index").select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
