"""Continuous loading of landed files into raw tables, each file once.

Which files have been loaded is kept in a ledger beside the table: path, size and modification time. It does
not depend on the stream's checkpoint, so a new checkpoint neither loads a file again nor touches what is there.
What is streamed are the files, not their rows: only files that the ledger does not know are opened.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from citylode.operators.ledger import BATCH, ENTRY, Ledger
from citylode.operators.storage import remove
from citylode.session import scratch_path
from citylode.sources.files import (
    CORRUPT, FILE_COLUMNS, corruptible, delimited_options, document_columns, split_corrupt, station_columns, station_record,
    with_lineage,
)

FILES_PER_BATCH = 1_000
LISTED = "path string, modificationTime timestamp, length bigint, content binary"
Split = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


@dataclass(frozen=True)
class FileStream:
    """Files as they arrive, and how the rows of some of them are read."""
    files: DataFrame
    scan: Callable[[list[str]], DataFrame]


def with_file(scan: DataFrame, loaded_at: str) -> DataFrame:
    """A scan with lineage and with the size and time of each row's file."""
    return with_lineage(scan, loaded_at).withColumns(file_columns())


def file_columns() -> dict[str, Column]:
    return {
        "_file_size": F.col("_metadata.file_size"),
        "_file_modified": F.col("_metadata.file_modification_time").cast("timestamp_ntz")}


def arriving(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """The files below a folder, unopened, in bounded batches, so that a backlog is taken in steps."""
    listed = spark.readStream.format("binaryFile").schema(LISTED).option("recursiveFileLookup", "true").option(
        "maxFilesPerTrigger", files_per_batch).load(path)
    return listed.select("path", F.col("_metadata.file_path").alias("_file_name"), *[
        column.alias(name) for name, column in file_columns().items()])


def stream_delimited(
    spark: SparkSession, path: str, columns: list[str], loaded_at: str = "run", files_per_batch: int = FILES_PER_BATCH,
) -> FileStream:
    """Rows of the delimited files below a landing folder; see ``files.with_lineage`` for ``loaded_at``."""
    def scan(paths: list[str]) -> DataFrame:
        reader = spark.read.schema(corruptible(columns)).options(**delimited_options())
        return with_file(reader.csv(paths), loaded_at)

    return FileStream(arriving(spark, path, files_per_batch), scan)


def stream_stations(
    spark: SparkSession, path: str, loaded_at: str = "run", files_per_batch: int = FILES_PER_BATCH,
) -> FileStream:
    """Station records of the files below a folder that hold a JSON array each."""
    def scan(paths: list[str]) -> DataFrame:
        reader = spark.read.schema(station_record(corrupt=True)).options(multiLine="true", mode="PERMISSIVE")
        rows = with_file(reader.json(paths), loaded_at)
        return rows.select(*station_columns(rows))

    return FileStream(arriving(spark, path, files_per_batch), scan)


def stream_documents(
    spark: SparkSession, path: str, loaded_at: str = "run", files_per_batch: int = FILES_PER_BATCH,
) -> FileStream:
    """The JSON documents below a folder, one row per file. To be loaded with ``files.split_documents``."""
    def scan(paths: list[str]) -> DataFrame:
        rows = with_file(spark.read.text(paths, wholetext=True), loaded_at)
        return rows.select(*document_columns(), "_file_name", "_loaded_at", *FILE_COLUMNS)

    return FileStream(arriving(spark, path, files_per_batch), scan)


def literal_path(path: str) -> str:
    """A path whose marks are not taken for a pattern."""
    return "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in path)


def load_batch(
    batch: DataFrame, scan: Callable[[list[str]], DataFrame], table: str, quarantine: str, split: Split = split_corrupt,
) -> int:
    """Append the rows of those files of a batch that the table has not got yet; gives their number.

    Good rows and malformed ones go to their tables under the batch's number in the ledger. A file that is
    replaced meanwhile gives no rows here; as it is now, it is another file, which arrives later. Files are
    scanned once, and again only if they hold malformed rows.
    """
    spark = batch.sparkSession
    ledger = Ledger(spark, table)
    staged = scratch_path(spark, "files")
    try:
        batch.coalesce(1).write.parquet(f"{staged}/found")
        found = spark.read.parquet(f"{staged}/found")
        ledger.unknown(found).coalesce(1).write.parquet(f"{staged}/new")
        files = spark.read.parquet(f"{staged}/new")
        paths = [literal_path(r[0]) for r in files.select("path").distinct().collect()]
        if not paths:
            return 0
        files = files.select(*ENTRY).distinct()
        seen = Observation()
        rows = scan(paths).join(F.broadcast(files), ENTRY, "left_semi").observe(
            seen, F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"))
        good, bad = (part.drop(*FILE_COLUMNS) for part in split(rows))
        number = ledger.last() + 1
        good.write.mode("overwrite").parquet(f"{table}/{BATCH}={number}")
        bad = bad if seen.get["bad"] else bad.limit(0)
        bad.write.mode("overwrite").parquet(f"{quarantine}/{BATCH}={number}")
        ledger.add(files, number, good.schema)
        return len(paths)
    finally:
        remove(spark, staged)


def load_new_files(stream: FileStream, table: str, quarantine: str, checkpoint: str, split: Split = split_corrupt):
    """Append everything that has arrived, good rows and malformed ones apart, then stop."""
    query = (
        stream.files.writeStream.foreachBatch(lambda batch, _: load_batch(batch, stream.scan, table, quarantine, split))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def loaded_batches(spark: SparkSession, table: str) -> DataFrame | None:
    """A table written by ``load_new_files`` with the batch of each row; None before the first one."""
    ledger = Ledger(spark, table)
    schema = ledger.schema()
    if schema is None:
        return None
    whole = StructType([*schema.fields, StructField(BATCH, IntegerType())])
    return spark.read.schema(whole).parquet(table).filter(F.col(BATCH) <= ledger.last())


def loaded(spark: SparkSession, table: str) -> DataFrame | None:
    """The rows of a table written by ``load_new_files``; None before the first batch."""
    rows = loaded_batches(spark, table)
    return None if rows is None else rows.drop(BATCH)


def has_text(column: str) -> Column:
    """Neither missing nor empty."""
    return F.coalesce(F.col(column), F.lit("")) != ""

