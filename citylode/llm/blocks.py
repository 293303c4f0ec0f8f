"""Queries against all rows, block against block: which of them meet in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.llm.common import stored

BLOCK_BYTES = 1 << 25  # of the vectors of one block, as doubles
BLOCK_ROWS = 1 << 16
LEAST_ROWS = 1 << 11  # smaller blocks are not worth a task


def vector_column(vectors: DataFrame, name: str) -> Column:
    """The vector as an array of floats or doubles."""
    kind = vectors.select(F.col(name)).schema[0].dataType.simpleString()
    return F.col(name) if kind in ("array<float>", "array<double>") else F.col(name).cast("array<double>")


def finite(vector: Column, scale: float = 1.0) -> Column:
    """Whether a vector is there and all of its components are finite, also when scaled."""
    def bad(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.coalesce(F.isnan(y) | (F.abs(y) == float("inf")), F.lit(True))

    return vector.isNotNull() & ~F.exists(vector, bad)


def numbered(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows, stored with a number of their own in ``row``, which stays the same from then on."""
    return stored(spark, df.withColumn("row", F.monotonically_increasing_id()), name)


def block_rows(dimensions: int, most: int = BLOCK_ROWS) -> int:
    """Rows of a block, such that its memory is bounded."""
    return max(256, min(most, BLOCK_BYTES // (8 * max(1, dimensions))))


def block_count(rows: int, size: int, spread: int) -> int:
    """Blocks of ``size`` rows at most; more and smaller ones for a small table, so that ``spread`` tasks have work."""
    return max(1, -(-rows // size), min(spread, rows // LEAST_ROWS))


def meet(index: DataFrame, queries: DataFrame, index_blocks: int, query_blocks: int):
    """Both tables grouped such that each block of one meets each block of the other, once, by dimensions.

    Rows are dealt to blocks by their hashed number, so no id, label or vector fills a block. With square
    blocks each row is sent as often as there are blocks on the other side, the least that can be.
    """
    def dealt(df: DataFrame, own: str, other: str, blocks: int, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
        # Columns are named anew: a cogroup confuses columns that both of its tables took from one.
        return df.select(*[F.col(c).alias(c) for c in df.columns], F.size("v").alias("d"), block.alias(own)).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    return dealt(index, "i", "j", index_blocks, query_blocks).groupBy("d", "i", "j").cogroup(
        dealt(queries, "j", "i", query_blocks, index_blocks).groupBy("d", "i", "j"))


def matrix(table: pa.Table, name: str = "v") -> np.ndarray:
    """A column of arrays of equal length as a matrix of its own type."""
    chunks = [c.flatten().to_numpy(zero_copy_only=False) for c in table.column(name).chunks]
    flat = np.concatenate(chunks) if chunks else np.zeros(0)
    return flat.reshape(table.num_rows, -1) if len(flat) else np.zeros((table.num_rows, 0))


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()
