"""Approximate nearest neighbours: a small-world graph per shard, stored as flat arrays, results merged.

Rows are dealt to shards of bounded size. One task builds a shard's graph and stores its arrays in pieces;
every block of queries then meets every shard in a task of its own, and the best of all shards are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylode.llm.blocks import BLOCK_ROWS, block_count, block_rows, finite, matrix, numbered, numbers, vector_column
from citylode.llm.common import stored
from citylode.llm.hard_negatives import best_of
from citylode.llm.small_world import NONE, SmallWorld, node_levels, unit_sphere

BEAM = 256
PIECE_BYTES = 1 << 22
QUERIES = 256  # answered together
ARRAYS = "d int, i int, name string, piece int, kind string, width int, data binary"
FOUND = "query_row bigint, query_id bigint, vec_id bigint, row bigint, score double"


def pieces_of(d: int, i: int, arrays: dict[str, np.ndarray]) -> pa.Table:
    """A shard's arrays as rows of at most ``PIECE_BYTES`` each."""
    out: list[tuple] = []
    for name, array in arrays.items():
        flat = np.ascontiguousarray(array)
        width = flat.shape[1] if flat.ndim == 2 else 0
        data = flat.tobytes()
        out += [(d, i, name, k, flat.dtype.str, width, data[at:at + PIECE_BYTES])
                for k, at in enumerate(range(0, max(1, len(data)), PIECE_BYTES))]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=[f.split()[0] for f in ARRAYS.split(", ")])


def arrays_of(table: pa.Table) -> dict[str, np.ndarray]:
    """The arrays again."""
    found: dict[str, list] = {}
    for row in table.sort_by([("name", "ascending"), ("piece", "ascending")]).select(
            ["name", "kind", "width", "data"]).to_pylist():
        found.setdefault(row["name"], []).append(row)
    out = {}
    for name, rows in found.items():
        flat = np.frombuffer(b"".join(r["data"] for r in rows), np.dtype(rows[0]["kind"]))
        out[name] = flat.reshape(-1, rows[0]["width"]) if rows[0]["width"] else flat
    return out


def build_shard(table: pa.Table) -> pa.Table:
    """The graph of a shard's distinct vectors; equal ones share a node, which lists their rows by id."""
    table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
    vectors = matrix(table) + 0.0  # no negative zeros
    bytes_ = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).reshape(-1)
    _, first, node = np.unique(bytes_, return_index=True, return_inverse=True)
    levels = node_levels(numbers(table, "row")[first])
    order = np.argsort(-levels, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    node = place[node.reshape(-1)]
    members = np.argsort(node, kind="stable")  # of a node in the order of the rows: by id
    distinct = vectors[first[order]]
    longest = float(np.sqrt(np.square(distinct.astype(np.float64)).sum(axis=1).max()))
    graph = SmallWorld.build(unit_sphere(distinct, longest), levels[order])
    d, i = table.column("d")[0].as_py(), table.column("i")[0].as_py()
    return pieces_of(d, i, {
        "vectors": distinct, "longest": np.array([longest]), "starts": np.searchsorted(node[members], np.arange(len(order) + 1)),
        "ids": numbers(table, "vec_id")[members], "rows": numbers(table, "row")[members],
    } | {f"links{k}": links for k, links in enumerate(graph.links)})


def search_shard(arrays: dict[str, np.ndarray], queries: pa.Table, k: int, beam: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The best rows of a shard for each query, by the exact product of the vectors found."""
    vectors = arrays["vectors"]
    layers = sum(name.startswith("links") for name in arrays)
    graph = SmallWorld(unit_sphere(vectors, float(arrays["longest"][0])), [arrays[f"links{n}"] for n in range(layers)])
    wanted, ids, rows = matrix(queries), numbers(queries, "vec_id"), numbers(queries, "row")
    starts = arrays["starts"]
    for at in range(0, len(ids), QUERIES):
        asked = wanted[at:at + QUERIES].astype(np.float64)
        unit = asked / np.sqrt(np.square(asked).sum(axis=1, keepdims=True))
        found = graph.search(np.concatenate([unit, np.zeros((len(unit), 1))], axis=1).astype(np.float32), beam)
        q, c = np.nonzero(found != NONE)
        nodes = found[q, c]
        score = np.einsum("ij,ij->i", asked[q], vectors[nodes].astype(np.float64))
        # Of a node's rows only the first can be among the best, one more than wanted as one may be the query.
        size = np.minimum(np.diff(starts)[nodes], k + 1)
        pair = np.repeat(np.arange(len(nodes)), size)
        member = starts[nodes[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        q, score = q[pair], score[pair]
        other = arrays["rows"][member] != rows[at:at + QUERIES][q]
        q, score, member = q[other], score[other], member[other]
        keep = best_of([q], score, [arrays["ids"][member], arrays["rows"][member]], k)
        q, member = q[keep], member[keep]
        yield (rows[at:at + QUERIES][q], ids[at:at + QUERIES][q], arrays["ids"][member], arrays["rows"][member], score[keep])


def nearest(
    spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20, beam: int = BEAM, id_column: str = "vec_id",
    vector: str = "embedding", shard: int | None = None, query_block: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): about the k other rows of largest inner product for each row where
    ``is_query`` holds.

    Nearest rows come first, equal scores by id; the score is the product of the vectors as doubles. All rows
    are indexed; what a graph does not find is missing, so that a rank may hold a row that comes later. Of
    equal vectors none is lost in favour of one with a larger id.

    Rows without id or vector, zero vectors, and vectors with a null, NaN or infinite component or whose
    squared length is no finite positive double take no part. A query meets the rows of as many dimensions. Rows that share an id are
    rows of their own, as queries and as candidates. With fewer candidates all are found; an empty table gives
    no rows. Other columns are not read.
    """
    v = vector_column(vectors, vector)
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = numbered(spark, vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"),
        finite(v).alias("good")).filter("good and vec_id is not null").filter(
        (square > 0) & (square < float("inf"))).drop("good"), "neighbour-rows").withColumn("d", F.size("v"))
    counts = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("asked")).collect()  # a row a dimension
    cores = spark.sparkContext.defaultParallelism

    def number(sizes: dict[int, int]) -> Column:
        of = F.lit(1)
        for d, n in sizes.items():
            of = F.when(F.col("d") == d, F.lit(n)).otherwise(of)
        return of

    shards = number({r.d: block_count(r.n, shard or block_rows(r.d), cores) for r in counts})
    blocks = number({r.d: block_count(r.asked, query_block, 1) for r in counts})

    def dealt(salt: int, count: Column) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), count).cast("int")

    index = stored(spark, rows.select("d", dealt(0, shards).alias("i"), "vec_id", "row", "v").groupBy("d", "i").applyInArrow(
        build_shard, ARRAYS), "graphs")

    def every(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), (count - 1).cast("int")))

    left = index.withColumn("j", every(blocks))
    right = rows.filter("q").select(
        F.col("d").alias("d"), F.col("vec_id").alias("vec_id"), F.col("row").alias("row"), F.col("v").alias("v"),
        dealt(1, blocks).alias("j"), every(shards).alias("i"))

    def work(graph: pa.Table, queries: pa.Table) -> pa.Table:
        parts = list(search_shard(arrays_of(graph), queries, k, beam)) if graph.num_rows and queries.num_rows else []
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0)] * 5
        kinds = [pa.int64()] * 4 + [pa.float64()]
        return pa.table([pa.array(c, t) if len(c) else pa.array([], t) for c, t in zip(columns, kinds, strict=True)],
                        names=[f.split()[0] for f in FOUND.split(", ")])

    best = left.groupBy("d", "i", "j").cogroup(right.groupBy("d", "i", "j")).applyInArrow(work, FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
