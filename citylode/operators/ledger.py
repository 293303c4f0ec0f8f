"""Which files have been taken, so that each is taken once."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citylode.operators.lookup import is_small
from citylode.operators.predicates import MONTH, month_of
from citylode.operators.versions import VersionedTable, months_in

BATCH = "batch"
ENTRY = ["_file_name", "_file_size", "_file_modified"]  # what tells one file from another


class Ledger:
    """The files that have been loaded into a table, in months of their modification.

    A batch's entries are published together with its number, in one step, after its rows have been written:
    rows of a batch that was never published do not count, and the next batch takes its number.
    """

    def __init__(self, spark: SparkSession, table: str):
        self.entries = VersionedTable(spark, f"{table.rstrip('/')}__ledger", "_file_modified")

    def last(self) -> int:
        return int(self.entries.manifest().notes.get(BATCH, 0))

    def schema(self) -> StructType | None:
        """The columns of the loaded rows."""
        found = self.entries.manifest().notes.get("schema")
        return found and StructType.fromJson(json.loads(found))

    def unknown(self, files: DataFrame) -> DataFrame:
        """Those of some files that have not been taken. Only the months of their modification are read."""
        known = self.entries.read(months_in(files.withColumn(MONTH, month_of(F.col("_file_modified")))))
        if known is None:
            return files
        if not is_small(files):
            return files.join(known.select(*ENTRY), ENTRY, "left_anti")
        # The files of a batch are few beside those of all time.
        taken = known.join(F.broadcast(files.select(*ENTRY)), ENTRY, "left_semi").select(*ENTRY)
        return files.join(F.broadcast(taken), ENTRY, "left_anti")

    def add(self, files: DataFrame, number: int, schema: StructType | None = None) -> None:
        """Publish a batch: its files, its number, and the columns of the rows that were loaded."""
        files = files.withColumn(BATCH, F.lit(number))
        months = months_in(files.withColumn(MONTH, month_of(F.col("_file_modified"))))
        known = self.entries.read(months)
        self.entries.commit(
            files if known is None else known.drop(MONTH).unionByName(files), months,
            {BATCH: number, "schema": schema and json.dumps(schema.jsonValue())})
