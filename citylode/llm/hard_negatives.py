"""Hard negatives: for an anchor and one of its positives, rows of other labels that score nearly as high.

Scores are inner products of integer vectors, made block against block from products modulo small primes
(``residues``), so that they are exact. A first pass finds the positives, a second one what lies in the window
of scores below each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylode.llm.blocks import block_count, block_rows, finite, matrix, meet, numbered, numbers, vector_column
from citylode.llm.common import stored
from citylode.llm.residues import Residues, log_norms, primes_for, product

ROWS, COLUMNS = 512, 4096  # of a piece of the scores
NARROW = 23.0  # binary logarithm of the length of rows whose scores are compared as longs
LONG = 1 << 63
POSITIVE = "anchor_row bigint, anchor_id bigint, positive_id bigint, positive_row bigint, positive_score bigint"
NEGATIVE = (
    "anchor_row bigint, anchor_id bigint, positive_rank int, positive_id bigint, positive_score bigint, "
    "negative_id bigint, negative_row bigint, negative_score bigint")


def pieces(left: np.ndarray, right: np.ndarray):
    """All scores of two matrices of integers: (left rows, right rows, scores), piece by piece.

    Long rows are kept apart from the others, whose scores need fewer primes and fit a long.
    """
    lengths = log_norms(left), log_norms(right)
    for a_wide in (False, True):
        for b_wide in (False, True):
            a, b = (np.flatnonzero((n > NARROW) == w) for n, w in zip(lengths, (a_wide, b_wide), strict=True))
            if not len(a) or not len(b):
                continue
            moduli = primes_for(lengths[0][a].max() + lengths[1][b].max())
            x, y = Residues(left[a], moduli), Residues(right[b], moduli)
            for i in range(0, len(a), ROWS):
                for j in range(0, len(b), COLUMNS):
                    rows, columns = slice(i, i + ROWS), slice(j, j + COLUMNS)
                    yield a[rows], b[columns], product(x, y, rows, columns)


def leaders(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best allowed scores of each row; of equal ones the first columns."""
    n, width = scores.shape
    if scores.dtype == object:
        allowed = allowed & np.array([[-LONG <= s < LONG for s in row] for row in scores], bool).reshape(n, width)
        best = np.argsort(np.where(allowed, -scores, 1 << 4000), axis=1, kind="stable")[:, :k]
    else:  # narrow rows: a score and a column fit a long together
        key = np.where(allowed, scores * width + np.arange(width - 1, -1, -1), np.iinfo(np.int64).min)
        best = np.argpartition(key, width - k, axis=1)[:, width - k:] if width > k else np.tile(np.arange(width), (n, 1))
    row = np.repeat(np.arange(n), best.shape[1])
    column = best.reshape(-1)
    good = allowed[row, column]
    return row[good], column[good]


def best_of(groups: list[np.ndarray], score: np.ndarray, ties: list[np.ndarray], k: int) -> np.ndarray:
    """Positions of the k first of each group: highest score, then the least of ``ties``."""
    order = np.lexsort([*reversed(ties), -score, *reversed(groups)])
    first = np.ones(len(order), bool)
    first[1:] = np.any([g[order][1:] != g[order][:-1] for g in groups], axis=0)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


def window_below(
    scores: np.ndarray, allowed: np.ndarray, row: np.ndarray, limit: np.ndarray, low: int, high: int, k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """For each limit, a positive's score, of a row: the first k allowed columns with low * limit <= high * score
    and score <= limit, as (number of the limit, column)."""
    if scores.dtype == object:
        out = []
        for t, (r, top) in enumerate(zip(row.tolist(), limit.tolist(), strict=True)):
            found = [(-s, c) for c, s in enumerate(scores[r].tolist()) if allowed[r, c] and low * top <= high * s and s <= top]
            out += [(t, c) for _, c in sorted(found)[:k]]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]
    # A limit beyond the narrow scores has nothing near it; cut, it still has not.
    limit = np.clip(limit, -(1 << 56), 1 << 56)
    least = np.full(len(scores), np.iinfo(np.int64).max)
    most = np.full(len(scores), np.iinfo(np.int64).min)
    np.minimum.at(least, row, -(-low * limit // high))
    np.maximum.at(most, row, limit)
    r, c = np.nonzero(allowed & (scores >= least[:, None]) & (scores <= most[:, None]))
    found = scores[r, c]
    # Limits and scores of a row in one falling order, a limit before equal scores: what follows a limit is below it.
    n = len(row)
    order = np.lexsort([
        np.concatenate([np.full(n, -1), c]), -np.concatenate([limit, found]), np.concatenate([row, r])])
    is_score = order >= n
    at = np.empty(n, np.int64)
    at[order[~is_score]] = np.cumsum(is_score)[~is_score]
    listed = order[is_score] - n
    which = np.repeat(np.arange(n), k)
    place = (at[:, None] + np.arange(k)).reshape(-1)
    inside = place < len(listed)
    which, hit = which[inside], listed[place[inside]]
    good = (r[hit] == row[which]) & (high * found[hit] >= low * limit[which])
    return which[good], c[hit[good]]


def labels_of(*tables: pa.Table) -> list[np.ndarray]:
    """Labels of several tables as numbers."""
    whole = pa.chunked_array([c for t in tables for c in t.column("label").chunks], tables[0].schema.field("label").type)
    codes = whole.combine_chunks().dictionary_encode().indices.to_numpy()
    return np.split(codes, np.cumsum([t.num_rows for t in tables])[:-1])


def in_order(table: pa.Table) -> pa.Table:
    """By id and number, so that of equal scores the first column has the smaller id."""
    return table.sort_by([("vec_id", "ascending"), ("row", "ascending")])


def made(schema: str, parts: list[tuple]) -> pa.Table:
    """The parts' columns one below the other; ranks are ints, all else longs."""
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*parts, strict=True)) or [[np.zeros(0, np.int64)]] * len(fields)
    return pa.table({
        name: pa.array(np.concatenate(c).astype(np.int64), pa.int32() if kind == "int" else pa.int64())
        for (name, kind), c in zip(fields, columns, strict=True)})


def hard_negatives(
    spark: SparkSession, vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80,
    high: int = 100, scale: int = 256, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
    block: int | None = None,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x); the score is the integer inner product, higher ones come first, ties go
    to the smaller id. The positives of a row where ``is_anchor`` holds are its first ``positives`` other rows of
    the same label; for each, the first ``negatives`` rows of other labels with
    low * positive_score <= high * negative_score <= high * positive_score are returned, ranked from 1. With fewer
    all are returned.

    Rows without id, label or vector, or with a component that is null, NaN or infinite (also after scaling)
    take no part, nor do pairs of different dimensions and pairs whose score does not fit a long. Rows that
    share an id, or are equal in all columns, are rows of their own: each is an anchor, positive or negative by
    itself. An empty table gives no rows. Other columns are not read.

    Every block of anchors meets every block of rows in a task of bounded size, twice: a positive's score must be
    known before what lies below it can be chosen.
    """
    v = vector_column(vectors, vector)
    rows = numbered(spark, vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label).alias("label"), v.alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), finite(v, scale).alias("good")).filter(
        "good and vec_id is not null and label is not null").drop("good"), "negatives-rows")
    n, asked, d = rows.agg(F.count(F.lit(1)), F.count_if("anchor"), F.max(F.size("v"))).first()
    size = block or block_rows(d or 1)
    index_blocks = block_count(n, size, spark.sparkContext.defaultParallelism)
    anchor_blocks = block_count(asked, size, 1)
    index, anchors = rows.drop("anchor"), rows.filter("anchor").drop("anchor")

    def levels(table: pa.Table) -> np.ndarray:
        return np.floor(matrix(table).astype(np.float64) * scale)

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            left = in_order(left)
            ids, row, anchor_ids, anchor_row = (
                numbers(t, c) for t in (left, right) for c in ("vec_id", "row"))
            own, asked_for = labels_of(left, right)
            x, y = levels(right), levels(left)
            for code in np.unique(asked_for):
                at, of = np.flatnonzero(asked_for == code), np.flatnonzero(own == code)
                for i, j, scores in pieces(x[at], y[of]):
                    a, b = at[i], of[j]
                    r, c = leaders(scores, anchor_row[a][:, None] != row[b][None, :], positives)
                    parts.append((anchor_row[a[r]], anchor_ids[a[r]], ids[b[c]], row[b[c]], scores[r, c]))
            if parts:
                whole = [np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)]
                keep = best_of([whole[0]], whole[4], [whole[2], whole[3]], positives)
                parts = [tuple(c[keep] for c in whole)]
        return made(POSITIVE, parts)

    order = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    found = meet(index, anchors, index_blocks, anchor_blocks).applyInArrow(find_positives, POSITIVE).withColumn(
        "positive_rank", F.row_number().over(order)).filter(F.col("positive_rank") <= positives)
    # At most ``positives`` rows an anchor.
    listed = stored(spark, found.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct(
        "positive_rank", "positive_id", "positive_score"))).alias("positives")), "positives")
    with_positives = anchors.join(listed, F.col("row") == F.col("anchor_row")).select(
        "row", "vec_id", "label", "v", *[F.col(f"positives.{c}").alias(c) for c in (
            "positive_rank", "positive_id", "positive_score")])

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            left = in_order(left)
            ids, row, anchor_ids, anchor_row = (
                numbers(t, c) for t in (left, right) for c in ("vec_id", "row"))
            own, asked_for = labels_of(left, right)
            lists = [right.column(c).combine_chunks() for c in ("positive_rank", "positive_id", "positive_score")]
            owner = pc.list_parent_indices(lists[0]).to_numpy()
            rank, positive_id, limit = (x.flatten().to_numpy() for x in lists)
            for a, b, scores in pieces(levels(right), levels(left)):
                place = np.full(right.num_rows, -1)
                place[a] = np.arange(len(a))
                mine = np.flatnonzero(place[owner] >= 0)
                which, c = window_below(
                    scores, asked_for[a][:, None] != own[b][None, :], place[owner[mine]], limit[mine], low, high, negatives)
                t, r = mine[which], a[place[owner[mine[which]]]]
                parts.append((
                    anchor_row[r], anchor_ids[r], rank[t], positive_id[t], limit[t], ids[b[c]], row[b[c]],
                    scores[place[owner[t]], c]))
            if parts:
                whole = [np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)]
                keep = best_of([whole[0], whole[2]], whole[7], [whole[5], whole[6]], negatives)
                parts = [tuple(c[keep] for c in whole)]
        return made(NEGATIVE, parts)

    below = meet(index, with_positives, index_blocks, anchor_blocks).applyInArrow(find_negatives, NEGATIVE)
    order = Window.partitionBy("anchor_row", "positive_rank").orderBy(
        F.desc("negative_score"), "negative_id", "negative_row")
    return below.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
