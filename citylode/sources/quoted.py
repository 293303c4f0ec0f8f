"""Delimited files whose quoted values hold line breaks, read in splits like any other.

A line begins a record if an even number of quotes lies before it in its file. Each split counts its quotes and
its lines once; a prefix scan over the splits of a file, one row each, tells every split whether it begins inside
a quoted value and how many records lie before it. With that, a second scan numbers records where the lines are.
Records of one line stay there; only the lines of longer ones are shuffled, to be put together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylode.operators.lookup import is_small
from citylode.sources.files import CORRUPT, corruptible, delimited_options, with_lineage

SPLITS = "file string, block bigint, quotes bigint, even bigint, lines bigint"
LINES = "file string, block bigint, nth bigint, record bigint, whole boolean, value string, stamp timestamp_ntz"


def quotes_in(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines.fill_null(""), '"').to_numpy(zero_copy_only=False).astype(np.int64)


def runs(batch: pa.RecordBatch):
    """Stretches of a batch that lie in one split of a file: (file, block, first row, number of rows)."""
    file, block = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
    codes = file.indices.to_numpy()
    edges = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (block[1:] != block[:-1]), [True]]))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield file.dictionary[int(codes[a])].as_py(), int(block[a]), int(a), int(b - a)


def count_splits(batches):
    """Of every split: its quotes, its lines, and those with an even number of the split's quotes before them."""
    found: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        quotes = quotes_in(batch.column("value")) if batch.num_rows else None
        for file, block, at, n in runs(batch) if batch.num_rows else ():
            total = found.setdefault((file, block), [0, 0, 0])
            mine = quotes[at:at + n]
            before = total[0] + np.cumsum(mine) - mine
            total[0] += int(mine.sum())
            total[1] += int((before % 2 == 0).sum())
            total[2] += n
    columns = [[k[0] for k in found], [k[1] for k in found], *([v[i] for v in found.values()] for i in range(3))]
    kinds = [pa.string(), *[pa.int64()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                     [f.split()[0] for f in SPLITS.split(", ")])


def number_lines(batches):
    """Of every line: its place, the number of its record in the file, and whether it is a whole record."""
    state: dict[tuple[str, int], list[int]] = {}  # quotes, records and lines so far
    for batch in batches:
        if not batch.num_rows:
            continue
        quotes = quotes_in(batch.column("value"))
        record, whole, nth = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        odd, before = batch.column("odd").to_numpy(), batch.column("before").to_numpy()
        for file, block, at, n in runs(batch):
            now = state.setdefault((file, block), [int(odd[at]), int(before[at]), 0])
            part = slice(at, at + n)
            passed = now[0] + np.cumsum(quotes[part])
            begins = (passed - quotes[part]) % 2 == 0
            record[part] = now[1] + np.cumsum(begins) - 1
            whole[part] = begins & (passed % 2 == 0)
            nth[part] = now[2] + np.arange(n)
            state[file, block] = [int(passed[-1]), now[1] + int(begins.sum()), now[2] + n]
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), batch.column("block"), pa.array(nth), pa.array(record), pa.array(whole.astype(bool)),
             batch.column("value"), batch.column("stamp")], [f.split()[0] for f in LINES.split(", ")])


def numbered_lines(spark: SparkSession, path: str | list[str], loaded_at: str) -> DataFrame:
    scan = with_lineage(spark.read.option("lineSep", "\n").text(path), loaded_at)
    lines = scan.select(
        "value", F.col("_file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_loaded_at").alias("stamp"))
    splits = lines.select("file", "block", "value").mapInArrow(count_splits, SPLITS).groupBy("file", "block").agg(
        *[F.sum(c).alias(c) for c in ("quotes", "even", "lines")])
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.withColumn("odd", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).withColumn(
        "begun", F.when(F.col("odd") == 0, F.col("even")).otherwise(F.col("lines") - F.col("even"))).select(
        "file", "block", "odd", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("before"))
    if not is_small(placed, 2_000_000):
        raise ValueError("too many splits: set spark.sql.files.maxPartitionBytes higher")
    # The join keeps the order of the lines, as the splits are broadcast.
    return lines.join(F.broadcast(placed), ["file", "block"]).select(
        "file", "block", "odd", "before", "value", "stamp").mapInArrow(number_lines, LINES)


def read_quoted(
    spark: SparkSession, path: str | list[str], columns: list[str], loaded_at: str = "run",
) -> DataFrame:
    """The same table as ``files.read_delimited`` gives, of files with line breaks in quoted values.

    Quotes stand only around whole values, and doubled inside them, as the format has it: a single one elsewhere
    opens a value that runs to the next one, and one that is never closed runs to the end of its file. The first
    record of a file is its header; empty lines between records are none. The file is scanned twice.
    """
    lines = numbered_lines(spark, path, loaded_at)
    single = lines.filter("whole").select("file", "record", "value", "stamp")
    longer = lines.filter("not whole").groupBy("file", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "nth", "value"))), lambda x: x["value"]), "\n")
        .alias("value"), F.max("stamp").alias("stamp"))
    records = single.unionByName(longer).filter("record > 0").withColumn(
        "value", F.regexp_replace("value", "\r$", "")).filter("value <> ''")
    options = {k: v for k, v in delimited_options().items() if k not in ("header", "enforceSchema", "columnPruning")}
    schema = corruptible(columns)
    parsed = records.withColumn("row", F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "), options))
    return parsed.select(
        *[F.col(f"row.{c}").alias(c) for c in columns], F.col(f"row.{CORRUPT}").alias(CORRUPT),
        F.col("file").alias("_file_name"), F.col("stamp").alias("_loaded_at"))
