"""Small tables that are replaced as a whole."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.operators.storage import exists


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at a path, or None when nothing has been written there yet."""
    if not exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return None
        raise


class SlotTable:
    """A table whose versions take turns in a few folders.

    A new version is written next to the current one and counts only once its number has been noted.
    A writer lost half way leaves the current version in place, old versions are overwritten in
    turn, and readers of the last ones are not disturbed. One writer at a time.
    """

    SLOTS = 4

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def version(self) -> int:
        """Number of the current version, 0 when there is none."""
        noted = read_if_present(self.spark, f"{self.path}/noted")
        return 0 if noted is None else noted.agg(F.max("version")).first()[0] or 0

    def data_path(self, version: int) -> str:
        return f"{self.path}/data-{version % self.SLOTS}"

    def read(self) -> DataFrame | None:
        """The current version, None before the first."""
        version = self.version()
        return self.spark.read.parquet(self.data_path(version)) if version else None

    def replace(self, df: DataFrame) -> None:
        """Make ``df``, which may be derived from the current version, the next one."""
        version = self.version() + 1
        df.write.mode("overwrite").parquet(self.data_path(version))
        self.spark.range(1).select(F.lit(version).alias("version")).write.mode("overwrite").parquet(
            f"{self.path}/noted/slot={version % self.SLOTS}")
