"""Keeping the newest load of a day and the newest row of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_calendar(day: Column) -> Column:
    """Whether a day lies in the years 1 to 9999."""
    first, last = (F.lit(text).cast("date") for text in ("0001-01-01", "9999-12-31"))
    return day.between(first, last)


def newest_load_per_day(raw: DataFrame, day: Column, loaded_at: str = "_loaded_at") -> DataFrame:
    """The latest load time of every day from year 1 to 9999."""
    return raw.filter(in_calendar(day)).groupBy(
        day.alias("load_day")).agg(F.max(loaded_at).alias("newest_load"))


def keep_last_load(
    raw: DataFrame, day: Column, loaded_at: str = "_loaded_at", newest: DataFrame | None = None,
) -> DataFrame:
    """Rows that belong to the last load of their calendar day, as found in the rows or given by ``newest``.

    The rule is per day over the whole table, not per key: a partial reload of a day replaces every
    earlier row of that day. Rows without a load time never match, nor do rows without a day. A day
    outside the years 1 to 9999 is no day that could be loaded again: all its rows stay, and the check
    for dates in the future reports them.

    The per-day table has one row per calendar day of the years 1 to 9999, at most 3.7 million rows
    of a date and a time however large the input, so it is broadcast: the wide table is neither
    shuffled nor sorted, and a day holding a third of all rows stays spread over its input splits.
    """
    newest = newest_load_per_day(raw, day, loaded_at) if newest is None else newest
    joined = raw.withColumn("load_day_", day).join(
        F.broadcast(newest),
        (F.col("load_day_") == F.col("load_day")) & (F.col(loaded_at) == F.col("newest_load")), "left")
    odd = ~in_calendar(F.col("load_day_")) & F.col(loaded_at).isNotNull()
    return joined.filter(F.col("load_day").isNotNull() | odd).drop("load_day_", "load_day", "newest_load")


def keep_latest_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order.

    Spark prunes to one row per key inside every input partition (WindowGroupLimit) before the
    shuffle, so a hot key brings at most one row per map task to its reducer.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("position_", position).filter(F.col("position_") == 1).drop("position_")


def newest_first(column: str) -> Column:
    """Descending order in which a missing time counts as newest."""
    return F.col(column).desc_nulls_first()
