"""Exact top-k by inner product on a bit-sliced index.

The components of a block of vectors are integers, kept as bitmaps: one per dimension and binary digit, a bit
per vector. A query's scores are sums of such bitmaps, made for all vectors of a block at once by carry-save
adders, and are bitmaps again. The best rows are then read off from the most significant digit downward; rows
that tie at the boundary are settled by id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INDEX_ROWS = 65_536
QUERY_ROWS = 1_024
WIDE = 1 << 26  # rows with a component from here on have an index of their own, as it needs more digits
LONG = 1 << 63


def bitmaps(values: np.ndarray) -> np.ndarray:
    """Nonnegative integers (rows, dimensions) as packed bitmaps (digits, dimensions, bytes of rows)."""
    digits = max(1, int(values.max(initial=0)).bit_length())
    return np.stack([np.packbits((values >> d & 1).astype(np.uint8).T, axis=1, bitorder="little") for d in range(digits)])


class BlockIndex:
    """The bit slices of a block of integer vectors, rows in ascending order of id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, vectors = ids[order], vectors[order]
        self.rows = len(ids)
        padded = np.zeros((-(-self.rows // 64) * 64, vectors.shape[1]), np.int64)
        self.least = int(vectors.min(initial=0))
        padded[:self.rows] = vectors - self.least
        slices = bitmaps(padded)
        self.digits = len(slices)
        self.up = np.ascontiguousarray(slices).view(np.uint64)
        self.down = ~self.up  # slices of (2 ** digits - 1) - value, for negative weights
        self.valid = np.packbits(np.arange(len(padded)) < self.rows, bitorder="little").view(np.uint64)

    def sums(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the scores' digits, least significant first, and what to add to each score."""
        columns: dict[int, list[np.ndarray]] = {}
        for d in np.flatnonzero(query).tolist():
            weight, source = abs(int(query[d])), self.up if query[d] > 0 else self.down
            for w in range(weight.bit_length()):
                if weight >> w & 1:
                    for s in range(self.digits):
                        columns.setdefault(w + s, []).append(source[s, d])
        negative = -int(query[query < 0].sum())
        base = self.least * int(query.sum()) - negative * ((1 << self.digits) - 1)
        out, k = [], 0
        while k <= max(columns, default=-1):
            pile = columns.get(k, [])
            above = columns.setdefault(k + 1, []) if len(pile) > 1 else []
            while len(pile) > 2:
                a, b, c = pile.pop(), pile.pop(), pile.pop()
                half = a ^ b
                pile.insert(0, half ^ c)
                above.append((a & b) | (half & c))
            if len(pile) == 2:
                a, b = pile
                pile = [a ^ b]
                above.append(a & b)
            out.append(pile[0] if pile else np.zeros_like(self.valid))
            k += 1
        return out, base

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows without those of id ``own``; ties go to smaller ids."""
        digits, base = self.sums(query)
        sure, open_rows = np.zeros_like(self.valid), self.valid.copy()
        lo, hi = np.searchsorted(self.ids, [own, own + 1])
        for at in range(lo, hi):
            open_rows[at >> 6] &= ~(np.uint64(1) << np.uint64(at & 63))
        have, left = 0, int(np.bitwise_count(open_rows).sum())
        for bits in reversed(digits):
            if have + left <= k:
                break
            ones = open_rows & bits
            n = int(np.bitwise_count(ones).sum())
            if have + n > k:
                open_rows, left = ones, n
            else:
                sure |= ones
                have, open_rows, left = have + n, open_rows & ~bits, left - n
        # What is open either all fits or ties with the last one taken: its first rows have the smallest ids.
        rows = np.concatenate([positions(sure), positions(open_rows)[:k - have]])
        scores = np.full(len(rows), base, np.int64)
        for d, bits in enumerate(digits):
            scores += ((bits[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << d
        return self.ids[rows], scores


def exact_top(ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The same as ``BlockIndex.top`` in integers of any size, without the rows whose scores do not fit a long."""
    rows = np.flatnonzero(ids != own)
    scores = (vectors[rows].astype(object) @ query.astype(object)).tolist() if len(rows) else []
    fit = (j for j, score in enumerate(scores) if -LONG <= score < LONG)
    best = sorted(fit, key=lambda j: (-scores[j], ids[rows[j]]))[:k]
    return ids[rows[best]] if best else ids[:0], np.array([scores[j] for j in best], np.int64)


class Block:
    """Rows of any long components: bit slices where no sum can pass a long, exact integers elsewhere."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        least, largest = int(vectors.min(initial=0)), int(vectors.max(initial=0))
        self.reach = max(-least, 0) + (1 << (largest - least).bit_length())
        self.index = BlockIndex(ids, vectors) if largest - least < LONG >> 1 else None

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        if self.index is not None and sum(map(abs, query.tolist())) * self.reach < LONG >> 1:
            return self.index.top(query, own, k)
        return exact_top(self.ids, self.vectors, query, own, k)


def blocks(ids: np.ndarray, vectors: np.ndarray) -> list[Block]:
    wide = ((vectors >= WIDE) | (vectors <= -WIDE)).any(axis=1)
    return [Block(ids[part], vectors[part]) for part in (~wide, wide) if part.any()]


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def quantised(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of every component as a double, and null for vectors that take no part."""
    levels = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    bad = F.exists(embedding, lambda x: F.coalesce(
        F.isnan(x.cast("double")) | (x.cast("double") * scale >= float(LONG)) | (x.cast("double") * scale < -float(LONG)),
        F.lit(True)))
    return F.when(embedding.isNotNull() & ~bad, levels)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_column: str = "vec_id",
    vector_column: str = "embedding", index_rows: int = INDEX_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k best rows for each row where ``is_query`` holds: query_id, rank (from 1), vec_id, score.

    Components become floor(scale * x); the score is the integer inner product. Candidates are all rows of as
    many dimensions with another id. Ties go to the smaller id. Vectors that are null, or hold null, NaN or
    infinite components or ones that do not fit a long after scaling, take no part, nor do rows without id, nor
    pairs whose score does not fit a long. Where scores may come near that, they are added up one by one. Rows that
    share an id are candidates each; as queries equal ones ask once, and different ones share a ranking. With fewer candidates all are returned; an empty
    table gives no rows. Other columns are not read.

    Every block of queries meets every block of the index in a task of its own, of bounded size; a block
    yields k rows per query, and the best k of those are chosen by rank.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), quantised(F.col(vector_column), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q")).filter("v is not null and vec_id is not null")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("q")).first()
    index_blocks, query_blocks = max(1, -(-n // index_rows)), max(1, -(-asked // query_rows))

    def crossed(df: DataFrame, number: Column, own: str, other: str, own_blocks: int, other_blocks: int) -> DataFrame:
        block = F.pmod(number, F.lit(own_blocks)).cast("int")
        return df.select("vec_id", "v", F.size("v").alias("d"), block.alias(own)).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))))

    # Rows are dealt to the index in the order they are read, so a frequent id or vector fills no block.
    index = crossed(rows, F.monotonically_increasing_id(), "i", "j", index_blocks, query_blocks)
    queries = crossed(rows.filter("q").dropDuplicates(["vec_id", "v"]), F.xxhash64("vec_id", "v"),
                      "j", "i", query_blocks, index_blocks)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            parts = blocks(left.column("vec_id").to_numpy(), matrix(left))
            for own, query in zip(right.column("vec_id").to_pylist(), matrix(right), strict=True):
                for part in parts:
                    ids, scores = part.top(query, own, k)
                    out.append((np.full(len(ids), own), ids, scores))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    def matrix(table: pa.Table) -> np.ndarray:
        flat = np.concatenate([c.flatten().to_numpy() for c in table.column("v").chunks])
        return flat.reshape(table.num_rows, -1) if len(flat) else np.zeros((table.num_rows, 0), np.int64)

    best = index.groupBy("d", "i", "j").cogroup(queries.groupBy("d", "i", "j")).applyInArrow(work, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
