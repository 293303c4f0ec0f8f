"""Best-fit packing of documents into sequences of several permitted lengths.

Only lengths matter to a packing, so it is planned on the histogram of lengths, at most one entry per length
up to the longest sequence, and written as placements of ranges of ranks: "of the documents of length 37,
ranks 1000 to 1999 go to bins 50 to 549, two each, from position 411". Documents get ranks within their
length by Spark, and each task looks up the placements of its own documents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylode.llm import scan
from citylode.llm.common import stored

CAPACITIES = (512, 1024, 2048, 4096, 8192)
ROWS_PER_SALT = 100_000
SALTS = 4096


def sequence_cost(capacity: int) -> float:
    """Cost of a sequence: its tokens, a part that grows with their square, and a fixed part."""
    return capacity + capacity * capacity / 65536 + 16


@dataclass(frozen=True)
class Plan:
    """Placements, sorted by length and first rank, and bins as runs of equal content."""
    length: np.ndarray
    rank: np.ndarray
    bin: np.ndarray
    per_bin: np.ndarray
    position: np.ndarray
    run_bin: np.ndarray
    run_content: np.ndarray
    run_capacity: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bin, position in it and its capacity, for documents by length and rank."""
        key = (self.length.astype(np.int64) << 44) + self.rank
        at = np.searchsorted(key, (length.astype(np.int64) << 44) + rank, "right") - 1
        beyond = rank - self.rank[at]
        bins = self.bin[at] + beyond // self.per_bin[at]
        position = self.position[at] + beyond % self.per_bin[at] * length
        return bins, position, self.run_capacity[np.searchsorted(self.run_bin, bins, "right") - 1]


def plan_packing(histogram: dict[int, int], capacities=CAPACITIES, cost=sequence_cost) -> Plan:
    """Best-fit decreasing over all capacities at once, on counts of lengths (1 to the largest capacity).

    Documents go, longest first, to the open bin with the least room that takes them. If there is none, the
    capacity is opened that costs least per token it can be expected to hold: copies of this length and what
    shorter documents are left. At the end each bin shrinks to the smallest capacity that holds its contents.
    Bins in the same state are one run of consecutive bin numbers, so the work does not grow with the number
    of documents.
    """
    capacities = sorted(set(capacities))
    left = sum(length * n for length, n in histogram.items())
    rooms: list[int] = []
    open_bins: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # room -> (first bin, bins, content)
    closed, placed, next_bin = [], [], 0

    def put(room: int, first: int, bins: int, content: int) -> None:
        if room == 0:
            closed.append((first, bins, content))
            return
        if not open_bins[room]:
            insort(rooms, room)
        open_bins[room].append((first, bins, content))

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        left -= length * todo

        def fill(first: int, bins: int, content: int, room: int, length=length) -> None:
            """Put what is to do into these bins, as many in each as fit before the next."""
            nonlocal todo, rank
            most = room // length
            whole = min(bins, todo // most)
            if whole:
                placed.append((length, rank, first, most, content))
                put(room - most * length, first, whole, content + most * length)
                rank, todo = rank + whole * most, todo - whole * most
            if whole < bins:
                if todo:
                    placed.append((length, rank, first + whole, todo, content))
                    put(room - todo * length, first + whole, 1, content + todo * length)
                    rank, todo, whole = rank + todo, 0, whole + 1
                if whole < bins:
                    put(room, first + whole, bins - whole, content)

        while todo:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, bins, content = open_bins[room].pop()
                if not open_bins[room]:
                    rooms.pop(k)
                fill(first, bins, content, room)
                continue

            def per_token(c: int, length=length, todo=todo) -> tuple[float, int]:
                copies = min(c // length, todo)
                return cost(c) / (copies * length + min(c - copies * length, left)), c

            best = min((c for c in capacities if c >= length), key=per_token)
            bins = -(-todo // (best // length))
            first, next_bin = next_bin, next_bin + bins
            fill(first, bins, 0, best)
    runs = sorted(closed + [b for group in open_bins.values() for b in group])
    content = np.array([r[2] for r in runs], np.int64)
    placed.sort(key=lambda p: p[:2])
    columns = [np.array(c, np.int64) for c in zip(*placed, strict=True)] if placed else [np.zeros(0, np.int64)] * 5
    return Plan(*columns, np.array([r[0] for r in runs], np.int64), content,
                np.array(capacities)[np.searchsorted(capacities, content)])


def word_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens): the number of words of every whole text."""
    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scan.count_words(batch.column(1)), pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id bigint, n_tokens bigint")


def ranked(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 within each length.

    A length may be that of a third of all documents, so it is numbered in salted parts, and each part
    starts after the ones before it. The table of parts has at most SALTS rows per length.
    """
    salts = max(1, min(SALTS, pieces.count() // ROWS_PER_SALT * 4 + 8))
    salted = pieces.withColumn("salt", F.pmod("uid", F.lit(salts)).cast("int"))
    parts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("length", "salt").orderBy("uid", "piece")
    numbered = salted.withColumn("nth", F.row_number().over(order) - 1)
    return numbered.join(starts, ["length", "salt"]).withColumn("rank", F.col("first") + F.col("nth"))


def pack(
    spark: SparkSession, counts: DataFrame, capacities=CAPACITIES, cost=sequence_cost,
) -> DataFrame:
    """Pack (doc_id, n_tokens). A row per piece: doc_id, piece, start, length, bin_id, position, capacity.

    A document longer than the largest capacity becomes pieces of that capacity and a rest; ``start`` is a
    piece's first token in its document, ``position`` its first place in the sequence ``bin_id``, whose
    permitted length is ``capacity``. Every row is packed, repeated rows and rows without doc_id too. A
    document without tokens is one piece of length 0 in no bin (null bin_id, position and capacity), as is
    one with a null or negative count. An empty table gives no rows.
    """
    largest = max(capacities)
    whole = stored(spark, counts.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
        F.greatest(F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)), F.lit(0)).alias("n_tokens")), "lengths")
    last = F.greatest((F.col("n_tokens") - 1).cast("long"), F.lit(0)) / F.lit(largest)
    cut = whole.select("uid", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), F.floor(last).cast("int"))).alias("piece"))
    start = F.col("piece").cast("long") * largest
    pieces = cut.select("uid", "doc_id", "piece", start.alias("start"), F.least(
        F.lit(largest).cast("long"), F.col("n_tokens") - start).cast("int").alias("length"))
    some = pieces.filter("length > 0")
    histogram = {r.length: r.n for r in some.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_packing(histogram, capacities, cost)

    def work(batches):
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            bins, position, capacity = plan.place(length, rank) if len(length) else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(bins, pa.int64()), pa.array(position, pa.int32()),
                 pa.array(capacity, pa.int32())], SCHEMA_NAMES)

    packed = ranked(spark, some).select("doc_id", "piece", "start", "length", "rank").mapInArrow(work, SCHEMA)
    none: Column = F.lit(None)
    return packed.unionByName(pieces.filter("length <= 0").select(
        "doc_id", "piece", "start", "length", none.cast("long").alias("bin_id"), none.cast("int").alias("position"),
        none.cast("int").alias("capacity")))


SCHEMA = "doc_id bigint, piece int, start bigint, length int, bin_id bigint, position int, capacity int"
SCHEMA_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def pack_documents(spark: SparkSession, docs: DataFrame, capacities=CAPACITIES, cost=sequence_cost) -> DataFrame:
    """Pack whole texts by their number of words; see ``pack``."""
    return pack(spark, word_counts(docs), capacities, cost)
