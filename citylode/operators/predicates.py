"""Optional predicates, folded into one column so that they reach the scan."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = dt.date(1970, 1, 1)

# Stored tables are partitioned by the first day of the month of their date: a day per folder would
# give thousands of small ones over the years, a month still prunes a delta or a date range.
MONTH = "month"


def all_of(*conditions: Column | None) -> Column:
    """AND of the given conditions; absent ones are left out."""
    given = [c for c in conditions if c is not None]
    return reduce(lambda a, b: a & b, given) if given else F.lit(True)


def date_range(column: str, start: dt.date | None = None, end: dt.date | None = None) -> Column:
    """Inclusive range, either bound optional."""
    return all_of(
        F.col(column) >= F.lit(start) if start is not None else None,
        F.col(column) <= F.lit(end) if end is not None else None,
    )


def equals(column: str, value) -> Column | None:
    """Equality when a value is given; 0 and '' are values, only None is absent."""
    return None if value is None else F.col(column) == F.lit(value)


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def with_month(df: DataFrame, date_column: str) -> DataFrame:
    return df.withColumn(MONTH, month_of(F.col(date_column)))


def in_days(
    df: DataFrame, column: str, start: dt.date | None = None, end: dt.date | None = None,
) -> DataFrame:
    """Rows of an inclusive date range; on a stored table the month partitions are pruned too."""
    months = None
    if MONTH in df.columns:
        months = date_range(MONTH, start and start.replace(day=1), end)
    return df.filter(all_of(date_range(column, start, end), months))


def after(df: DataFrame, column: str, mark: dt.date | None) -> DataFrame:
    """Rows strictly after a high-water mark; no mark means from the beginning."""
    mark = mark or EPOCH
    later = F.col(column) > F.lit(mark)
    if MONTH in df.columns:
        later = later & date_range(MONTH, mark.replace(day=1))
    return df.filter(later)


def day_slice(df: DataFrame, column: str, day: dt.date | None = None) -> DataFrame:
    """Rows of one day as a half-open range on the timestamp; yesterday when no day is given."""
    day = day or dt.date.today() - dt.timedelta(days=1)
    begin = F.lit(day).cast("timestamp_ntz")
    end = F.lit(day + dt.timedelta(days=1)).cast("timestamp_ntz")
    return df.filter((F.col(column) >= begin) & (F.col(column) < end))


def latest_available_day(
    df: DataFrame, column: str, target: dt.date, lookback: int = 3, required: bool = True,
) -> DataFrame:
    """Rows of the newest day present among the target and the days just before it.

    The newest day is a scalar subquery over the pruned window. If no day is present, the query fails when
    it runs, or gives no rows if a day is not ``required``.
    """
    day = F.col(column).cast("date")
    oldest = target - dt.timedelta(days=lookback - 1)
    window = df.filter(
        (F.col(column) >= F.lit(oldest).cast("timestamp_ntz"))
        & (F.col(column) < F.lit(target + dt.timedelta(days=1)).cast("timestamp_ntz"))
    )
    found = F.max(day)
    if required:
        none = F.raise_error(F.lit(f"no data from {oldest} to {target}")).cast("date")
        found = F.coalesce(found, none)
    newest = window.agg(found.alias("newest")).scalar()
    return window.filter(day == newest)
