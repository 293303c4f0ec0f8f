"""The dated landing layout source/yyyy/MM/dd/HH/mm/file and routing by path."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.reference_values import MERGE_KEYS

STAMP_IN_PATH = r"/(\d{4})/(\d{2})/(\d{2})/(\d{2})/(\d{2})/[^/]+$"


def landing_path(root: str, source: str, day: dt.date, run: dt.datetime) -> str:
    """Folder of one extraction run: the data day, then the hour and minute of the run."""
    return f"{root.rstrip('/')}/{source}/{day:%Y/%m/%d}/{run:%H/%M}"


def all_runs(root: str, source: str) -> str:
    """Glob over every run of a source."""
    return f"{root.rstrip('/')}/{source}/*/*/*/*/*"


def run_stamp(path: Column) -> Column:
    """Data day and run time written in a landing path, NULL for other paths."""
    parts = [F.regexp_extract(path, STAMP_IN_PATH, i) for i in range(1, 6)]
    text = F.concat(
        parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2], F.lit(" "),
        parts[3], F.lit(":"), parts[4], F.lit(":00"))
    return text.try_cast("timestamp_ntz")


def dataset_of(path: Column) -> Column:
    """Dataset of an exported file: the folder below gold_export."""
    return F.regexp_extract(path, r"(?:^|/)gold_export/([^/]+)/", 1)


def run_of(path: Column) -> Column:
    """Folder of the run that exported a file."""
    return F.regexp_extract(path, r"^(.*/gold_export/[^/]+/.*)/[^/]+$", 1)


def exported_files(spark: SparkSession, root: str) -> DataFrame:
    """The files of all exports below a folder that belong to a served dataset, with dataset and run folder.

    Only names, sizes and times are listed; no content is read.
    """
    found = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet").load(
        f"{root.rstrip('/')}/gold_export").select(
        F.col("_metadata.file_path").alias("_file_name"), F.col("_metadata.file_size").alias("_file_size"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_file_modified"))
    return route(found, "_file_name").withColumn("run", run_of(F.col("_file_name")))


def route(files: DataFrame, path: str = "path") -> DataFrame:
    """Files with the dataset they belong to; files of unmapped datasets are left out."""
    return files.withColumn("dataset", dataset_of(F.col(path))).filter(
        F.col("dataset").isin(list(MERGE_KEYS)))
