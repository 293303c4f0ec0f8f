"""Joins to a dimension table whose size is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Count a dimension; one aggregate job, answered from file footers for plain Parquet."""
    return df.count() <= max_rows


class RepeatedKey(ValueError):
    """A dimension has several rows for a key."""


def lookup(
    facts: DataFrame, dimension: DataFrame, on: list[str], how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Attach dimension columns to facts.

    A dimension within the checked bound is broadcast and the facts are not shuffled. A larger one
    is joined by shuffle, where adaptive execution splits a hot key's partition. A key that the dimension
    holds twice would multiply facts, and is an error.
    """
    repeated = dimension.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("rows_")).filter("rows_ > 1").first()
    if repeated is not None:
        raise RepeatedKey(", ".join(f"{c} {repeated[c]!r}" for c in on) + f": {repeated['rows_']} rows")
    side = F.broadcast(dimension) if is_small(dimension, max_rows) else dimension
    return facts.join(side, on, how)
