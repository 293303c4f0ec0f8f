"""Keyed, repeatable upsert of Parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.operators.dedup import keep_latest_row
from citylode.operators.predicates import with_month
from citylode.operators.storage import remove
from citylode.operators.versions import VersionedTable, months_in
from citylode.session import scratch_path


def one_row_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """Resolve repeated keys the same way on every run: newest stamp first, then by all values."""
    others = [c for c in source.columns if c not in keys]
    stamps = [c for c in ("updated_at",) if c in others]
    order = [F.col(c).desc_nulls_last() for c in stamps + [c for c in others if c not in stamps]]
    if not order:
        return source.dropDuplicates(keys)
    return keep_latest_row(source, keys, order)


def same_key(keys: list[str], left: str, right: str) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys],
    )


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target with every source row inserted, or replacing the target row of the same key.

    An anti join drops the replaced rows, and the source is appended. Applying the same source
    again gives the same table.
    """
    newest = one_row_per_key(source, keys)
    kept = target.alias("t").join(
        newest.select(*keys).alias("s"), same_key(keys, "t", "s"), "left_anti")
    return kept.unionByName(newest.select(target.columns))


def upsert_table(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str],
    date_column: str | None = None,
) -> None:
    """Upsert into a versioned table, rewriting only the months the source touches.

    The source is written out once, so that it is not evaluated again by each step. With a date
    column (part of the key), only months that the source names are read, merged and published as a
    new version; the others keep their folders. Readers see the version before or the one after, and
    a writer that is lost leaves the one before.
    """
    table = VersionedTable(spark, path, date_column)
    staged = scratch_path(spark, "upsert-source")
    (source if date_column is None else with_month(source, date_column)).write.parquet(staged)
    try:
        source = spark.read.parquet(staged)
        if source.isEmpty():
            return
        # Rows without a date have no month; they are a part like any other.
        months = None if date_column is None else months_in(source)
        target = table.read(months)
        merged = one_row_per_key(source, keys) if target is None else merge_rows(
            target.select(source.columns), source, keys)
        table.commit(merged, months)
    finally:
        remove(spark, staged)
