"""Raw file scans: delimited text, JSON arrays, whole documents, Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from citylode.functions.casts import load_stamp
from citylode.schemas import STATION_RECORD, text_schema
from citylode.sources.landing import run_stamp

CORRUPT = "_corrupt_record"

# What tells one landed file from another, beside its path.
FILE_COLUMNS = ["_file_size", "_file_modified"]

# A value that no field holds. With it, an empty field is NULL and a quoted empty field is ''.
NO_NULL_TEXT = "\u0001"


def delimited_options() -> dict[str, str]:
    return {
        "sep": ";", "quote": '"', "escape": '"', "header": "true", "enforceSchema": "true",
        "nullValue": NO_NULL_TEXT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
        "encoding": "UTF-8",
        # A row's fields are only counted if all columns are parsed.
        "columnPruning": "false",
    }


def with_lineage(df: DataFrame, loaded_at: str = "run") -> DataFrame:
    """Add the source file and the load time.

    ``run`` stamps the run written in a landing path, the same for all files of a run, so that of a day
    loaded twice the last run is known; a file outside the landing layout gets its modification time.
    ``arrival`` always takes that time: only for runs of one file each. ``batch`` takes the time of the
    running query: only for files of a single run.
    """
    arrival = F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    stamps = {
        "run": F.coalesce(run_stamp(F.col("_metadata.file_path")), arrival), "arrival": arrival,
        "batch": load_stamp()}
    return df.select(
        "*", F.col("_metadata.file_path").alias("_file_name"), stamps[loaded_at].alias("_loaded_at"))


def corruptible(columns: list[str]) -> StructType:
    return StructType([*text_schema(columns).fields, StructField(CORRUPT, StringType())])


def read_delimited(
    spark: SparkSession, path: str | list[str], columns: list[str], loaded_at: str = "run",
) -> DataFrame:
    """Semicolon files with one header line, columns by position, all text, plus lineage.

    Rows with the wrong number of fields carry their text in ``_corrupt_record``; see
    ``split_corrupt``. Files stay splittable, so a large file is read by many tasks.
    """
    reader = spark.read.schema(corruptible(columns)).options(**delimited_options())
    return with_lineage(reader.csv(path), loaded_at)


def split_corrupt(scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the quarantined text of malformed ones with how many fields they had.

    Spark refuses a file scan that needs the corrupt-record column alone, as a plain count of good
    rows would. The always true length test makes every query need a data column as well.
    """
    fields = [c for c in scan.columns if c not in (CORRUPT, "_file_name", "_loaded_at", *FILE_COLUMNS)]
    scan = scan.filter(F.length(F.coalesce(F.col(fields[0]), F.lit(""))) >= 0)
    good = scan.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    present = F.size(F.array_compact(F.array(*fields))).alias("fields_present")
    bad = scan.filter(F.col(CORRUPT).isNotNull()).select(
        CORRUPT, present, "_file_name", "_loaded_at")
    return good, bad


def station_record(corrupt: bool = False) -> StructType:
    return StructType([*STATION_RECORD.fields, *([StructField(CORRUPT, StringType())] if corrupt else [])])


def station_columns(scan: DataFrame) -> list[Column]:
    """The flat columns of scanned station records, and whatever the scan has added."""
    added = [c for c in scan.columns if c not in STATION_RECORD.fieldNames()]
    return [
        F.col("stationcode"), F.col("name"), F.col("capacity"),
        F.col("coordonnees_geo.lat").alias("coordonnees_geo_lat"),
        F.col("coordonnees_geo.lon").alias("coordonnees_geo_lon"),
        F.col("nom_arrondissement_communes"), F.col("code_insee_commune"), *[F.col(c) for c in added]]


def read_stations(
    spark: SparkSession, path: str | list[str], loaded_at: str = "run", array_files: bool = True,
) -> DataFrame:
    """Station records from files holding one JSON array each (or, splittable, one array per line)."""
    scan = with_lineage(spark.read.schema(station_record()).option("multiLine", array_files).json(path), loaded_at)
    return scan.select(*station_columns(scan))


def document_columns() -> list[Column]:
    """A whole file's text as a variant, or as it is in the corrupt-record column if it is not JSON."""
    parsed = F.try_parse_json("value")
    return [parsed.alias("raw_geojson"), F.when(parsed.isNull(), F.coalesce("value", F.lit(""))).alias(CORRUPT)]


def scan_documents(spark: SparkSession, path: str | list[str], loaded_at: str = "run") -> DataFrame:
    """One row per file, as a variant; a file that is not JSON has its text in ``_corrupt_record``."""
    scan = with_lineage(spark.read.text(path, wholetext=True), loaded_at)
    return scan.select(*document_columns(), "_file_name", "_loaded_at")


def split_documents(scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents, and the files that are none: their text and name."""
    bad = scan.filter(F.col(CORRUPT).isNotNull()).select(
        CORRUPT, F.lit(0).alias("fields_present"), "_file_name", "_loaded_at")
    return scan.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per JSON file, its content as a variant; see ``split_documents`` for files that are not JSON."""
    return split_documents(scan_documents(spark, path))[0]


def read_lowered(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet with lower-case column names."""
    df = spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)
    return df.toDF(*[c.lower() for c in df.columns])
