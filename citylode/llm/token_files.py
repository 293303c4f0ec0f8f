"""Documents as token ids in binary shards, in ascending doc_id order, and back."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylode.llm.common import documents, stored
from citylode.llm.encoder import chunks
from citylode.llm.repair import open_shard, pack_shard

SHARD_IDS = 1 << 20
SHARDS = "part int, shard int, part_start bigint, n_docs bigint, n_ids bigint, data binary"
DOCS = "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, base: int, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Packed shards of all documents: a row (part, shard, part_start, n_docs, n_ids, data) per shard.

    Rows go to as many parts as Spark is set to shuffle into, by ranges of doc_id and then of the order they
    are read in, so a doc_id of many rows is spread. Inside a part documents are read in order and a shard is closed once it has ``shard_ids`` ids;
    a document is never cut, so the memory of a task holds one shard and one document.
    """
    keyed = documents(docs).withColumn("nth", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("nth")]

    def work(batches):
        encoder = chunks(tokenizer)
        end, part = np.array([end_id], "<u2").tobytes(), TaskContext.get().partitionId()
        waiting: list[tuple[int | None, bytes]] = []
        n_ids = shard = before = 0

        def close():
            nonlocal n_ids, shard, before, waiting
            data = pack_shard(
                np.array([d or 0 for d, _ in waiting], np.int64), np.array([len(x) // 2 for _, x in waiting]),
                np.frombuffer(b"".join(x for _, x in waiting), "<u2"), base, sum(d is None for d, _ in waiting))
            row = [part, shard, before, len(waiting), n_ids, data]
            before, shard, n_ids, waiting = before + n_ids, shard + 1, 0, []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, KINDS, strict=True)], NAMES)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py()) + end
                waiting.append((doc_id, ids))
                n_ids += len(ids) // 2
                if n_ids >= shard_ids:
                    yield close()
        if waiting:
            yield close()

    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "doc_id", "text").mapInArrow(work, SHARDS)


NAMES = [part.split()[0] for part in SHARDS.split(", ")]
KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def read_documents(shards: DataFrame) -> DataFrame:
    """(part, doc_id, start, n_tokens, ids_crc32) of every document; start counts within the part."""
    def work(batches):
        for batch in batches:
            for part, before, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                shard = open_shard(data)
                ids = shard.ids().astype("<u4")
                ends = np.cumsum(shard.lengths.astype(np.int64))
                starts = ends - shard.lengths
                null = np.arange(len(ends)) < shard.nameless
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ends), part), pa.int32()), pa.array(shard.doc_ids, pa.int64(), mask=null),
                    pa.array(before + starts), pa.array(shard.lengths, pa.int64()),
                    pa.array([crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int64())],
                    ["part", "doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("part", "part_start", "data").mapInArrow(work, DOCS)


def token_files(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2, base: int = 49408,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Write the shards to the shared folder and return them as read: see ``write_shards``.

    ``tokenizer`` names a vocabulary file with ids below ``base``. Null counts as empty text, of which only
    ``end_id`` is written. Null doc_ids come first; rows that share a doc_id follow each other as they
    are read. An empty table writes no shard. Other columns are not read.
    """
    return stored(spark, write_shards(docs, tokenizer, end_id, base, shard_ids), "token-shards")


def documents_of(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of stored shards, all from their contents.

    ``start`` counts all ids before the document in the order of the shards. A running sum over the parts,
    one row each, gives where parts start.
    """
    sizes = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return read_documents(shards).join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
