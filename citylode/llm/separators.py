"""Token counts by a separator scan.

Flat token files carry no index: documents end where the end-of-document id stands. Files are read in blocks
of ids that begin and end anywhere. Each block is searched at once, a prefix scan over the blocks of a file
tells every block where the last separator before it was, and so documents are counted across blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylode.llm.common import stored
from citylode.llm.encoder import chunks

BLOCK_IDS = 1 << 20
BLOCKS = "file int, block int, ids binary, doc_ids array<bigint>"


def write_flat(docs: DataFrame, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Flat token files: a row (file, block, ids) per block of ``block_ids`` 16-bit ids, cut anywhere.

    A file holds the documents of one partition in the order they are read; no row moves. ``doc_ids`` lists
    the documents that end in the block, for labelling counts; it says nothing of where they end.
    """
    def work(batches):
        encoder, end = chunks(tokenizer, True), np.array([end_id], "<u2").tobytes()
        file, block, size = TaskContext.get().partitionId(), 0, 2 * block_ids
        buffer, ended = bytearray(), []

        def row(ids: bytes, doc_ids: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([block], pa.int32()), pa.array([ids], pa.binary()),
                 pa.array([doc_ids], pa.list_(pa.int64()))], ["file", "block", "ids", "doc_ids"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                buffer += encoder.encode(text.as_py())
                buffer += end
                while len(buffer) > size:  # this document ends in a later block
                    yield row(bytes(buffer[:size]), ended)
                    del buffer[:size]
                    block, ended = block + 1, []
                ended.append(doc_id)
                if len(buffer) == size:
                    yield row(bytes(buffer), ended)
                    buffer.clear()
                    block, ended = block + 1, []
        if buffer:
            yield row(bytes(buffer), ended)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, BLOCKS)


def count_tokens(blocks: DataFrame, end_id: int) -> DataFrame:
    """A row per document of flat files (file, block, ids): file, block, nth, start, n_tokens, terminated.

    ``block`` is where the document ends and ``nth`` which of the documents that end there it is; ``start`` its
    first id in the file; ``n_tokens`` counts its ids without the separator. What follows a file's last
    separator is a document with ``terminated`` false. Blocks of null or no ids hold nothing; an empty table
    gives no rows.
    """
    @F.pandas_udf("array<bigint>")
    def ends(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: np.flatnonzero(np.frombuffer(x, "<u2") == end_id))

    each = blocks.filter("ids is not null").select(
        "file", "block", (F.octet_length("ids") / 2).cast("long").alias("n"), ends("ids").alias("ends"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0))
    # One row per block: its length and its separators. A file has as many blocks as its partition fills.
    placed = each.select("file", "block", "n", "ends", offset.alias("offset"))
    last = F.when(F.size("ends") > 0, F.col("offset") + F.element_at("ends", -1))
    carried = placed.select("*", F.coalesce(F.last(last, ignorenulls=True).over(before), F.lit(-1)).alias("carry"),
                            F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("final"))
    docs = carried.select("file", "block", "offset", "carry", "ends", F.posexplode("ends").alias("nth", "end")).select(
        "file", "block", "nth", (F.when(F.col("nth") == 0, F.col("carry")).otherwise(
            F.col("offset") + F.get("ends", F.col("nth") - 1)) + 1).alias("start"),
        (F.col("offset") + F.col("end")).alias("stop"), F.lit(True).alias("terminated"))
    tail = carried.filter("final").select(
        "file", "block", F.size("ends").alias("nth"), (F.coalesce(last, F.col("carry")) + 1).alias("start"),
        (F.col("offset") + F.col("n")).alias("stop"), F.lit(False).alias("terminated")).filter("stop > start")
    return docs.unionByName(tail).select(
        "file", "block", "nth", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "terminated")


def document_token_counts(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 49407, block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Write flat token files of ``docs``, scan them, and name the documents: doc_id, file, start, n_tokens.

    The counts come from the separators alone. ``end_id`` is a special token of the vocabulary, whose string
    in a text is ordinary text here, so that no text holds it. Null counts as empty text and has 0 tokens;
    null doc_ids and repeated rows are counted like all. An empty table gives no rows.
    """
    blocks = stored(spark, write_flat(docs, tokenizer, end_id, block_ids), "flat-tokens")
    names = blocks.select("file", "block", F.posexplode("doc_ids").alias("nth", "doc_id"))
    return count_tokens(blocks, end_id).join(names, ["file", "block", "nth"]).select(
        "doc_id", "file", "start", "n_tokens")
