"""High-water marks of the daily marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.operators.merge import merge_rows
from citylode.operators.predicates import EPOCH
from citylode.operators.slots import SlotTable

SCHEMA = "dataset string, last_date date"


def merge_marks(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Set the mark of each dataset named in ``updates``; the others stay."""
    return merge_rows(current, updates, ["dataset"])


def marks_from(outputs: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The greatest date of each output as (dataset, last_date); empty outputs give no row."""
    marks = None
    for dataset, (df, column) in outputs.items():
        one = df.agg(F.max(column).alias("last_date")).filter("last_date is not null").select(
            F.lit(dataset).alias("dataset"), "last_date")
        marks = one if marks is None else marks.unionByName(one)
    return marks


class Watermarks:
    """One mark per dataset, in a stored table that each advance merges into."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = SlotTable(spark, path)

    def current(self) -> DataFrame:
        marks = self.table.read()
        return self.spark.createDataFrame([], SCHEMA) if marks is None else marks

    def all(self) -> dict[str, dt.date]:
        """Every dataset's mark; the table has one row per dataset."""
        return {r["dataset"]: r["last_date"] for r in self.current().collect()}

    def get(self, dataset: str) -> dt.date:
        """The dataset's mark, the epoch when it has none."""
        return self.all().get(dataset, EPOCH)

    def advance(self, marks: dict[str, dt.date]) -> None:
        """Set the marks of the named datasets; the others stay."""
        if marks:
            updates = self.spark.createDataFrame(list(marks.items()), SCHEMA)
            self.table.replace(merge_marks(self.current(), updates).coalesce(1))


def delta_start(mark: dt.date | None, lookback_days: int = 0) -> dt.date:
    """Where the next delta starts. With a lookback, the last days are computed again, which picks
    up late rows; the upsert makes the repetition harmless."""
    return EPOCH if mark in (None, EPOCH) else mark - dt.timedelta(days=lookback_days)
