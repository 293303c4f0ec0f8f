"""Sums of matrices over partitions, for models that are fitted by their normal equations."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 16  # partial sums that reach the driver of a fit
PIECE = 1 << 14  # numbers added up in one row


def partition_sums(rows: DataFrame, add: Callable[[pa.RecordBatch], Iterable[np.ndarray]]) -> list[np.ndarray] | None:
    """Sum over all batches of ``rows`` of the arrays that ``add`` makes of one; None of no rows.

    For fits on a bounded sample: each of PARTS partitions adds up its own and sends its sums.
    """
    def work(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                made = [np.asarray(x, np.float64) for x in add(batch)]
                total = made if total is None else [t + m for t, m in zip(total, made, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array([[x.tobytes() for x in total]], pa.list_(pa.binary())),
                pa.array([[list(x.shape) for x in total]], pa.list_(pa.list_(pa.int64())))], ["sums", "shapes"])

    total = None
    for row in rows.repartition(PARTS).mapInArrow(work, "sums array<binary>, shapes array<array<bigint>>").collect():
        part = [np.frombuffer(bytes(x)).reshape(shape) for x, shape in zip(row.sums, row.shapes, strict=True)]
        total = part if total is None else [t + p for t, p in zip(total, part, strict=True)]
    return total


def merged_sums(rows: DataFrame, add: Callable[[pa.RecordBatch], Iterable[np.ndarray]]) -> list[np.ndarray] | None:
    """The same for large matrices: Spark adds up the partitions' sums, piece by piece, and the driver receives one."""
    kind = "k int, sums binary, shapes array<array<bigint>>"

    def send(pieces):
        for k, (x, shapes) in pieces:
            yield pa.RecordBatch.from_arrays([
                pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary()),
                pa.array([shapes], pa.list_(pa.list_(pa.int64())))], ["k", "sums", "shapes"])

    def work(batches):
        total, shapes = None, None
        for batch in batches:
            if batch.num_rows:
                made = [np.asarray(x, np.float64) for x in add(batch)]
                shapes = [list(x.shape) for x in made]
                if total is None:
                    total = np.zeros(sum(x.size for x in made))
                at = 0
                for x in made:
                    total[at:at + x.size] += x.reshape(-1)
                    at += x.size
        if total is not None:
            yield from send((at // PIECE, (total[at:at + PIECE], shapes)) for at in range(0, len(total), PIECE))

    def merge(batches):
        found: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for batch in batches:
            for k, x, shapes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found[k] = (np.frombuffer(x) + found[k][0] if k in found else np.frombuffer(x), shapes)
        yield from send(found.items())

    parts = rows.repartition(PARTS).mapInArrow(work, kind).repartition(PARTS, "k").mapInArrow(merge, kind).collect()
    if not parts:
        return None
    whole = np.concatenate([np.frombuffer(bytes(r.sums)) for r in sorted(parts, key=lambda r: r.k)])
    shapes = parts[0].shapes
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    return [x.reshape(s) for x, s in zip(np.split(whole, ends[:-1]), shapes, strict=True)]


def table_sums(
    rows: DataFrame, add: Callable[[pa.RecordBatch], Iterable[np.ndarray]], shapes: list[tuple[int, ...]],
) -> list[np.ndarray] | None:
    """The same for few numbers and tables of any size: each task sums where its rows are, Spark sums the rest."""
    def work(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                made = np.concatenate([np.asarray(x, np.float64).reshape(-1) for x in add(batch)])
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

    each = rows.mapInArrow(work, "sums array<double>").select(F.posexplode("sums").alias("k", "x"))
    found = sorted(each.groupBy("k").agg(F.sum("x")).collect())
    if not found:
        return None
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    return [x.reshape(s) for x, s in zip(np.split(np.array([r[1] for r in found]), ends[:-1]), shapes, strict=True)]


def doubles(column: pa.Array) -> np.ndarray:
    """A column of arrays of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lists(matrix: np.ndarray) -> pa.Array:
    """A matrix as a column of arrays."""
    flat = np.ascontiguousarray(matrix, np.float64).reshape(-1)
    width = matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1) * width, pa.int32()), pa.array(flat))
