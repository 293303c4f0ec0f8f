"""Ratios, roundings and conditional aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, places: int) -> Column:
    """Round half up on the decimal rendering, so that 1.005 gives 1.01; stays a double."""
    return F.round(value.cast("decimal(28,10)"), places).cast("double")


def steady(value: Column) -> Column:
    """A double with the noise of summation order removed: six digits kept, rounded to four."""
    return F.round(value.cast("decimal(18,6)"), 4).cast("double")


def times_over(value: Column, limit: Column) -> Column:
    """How many times a value exceeds a limit, to two places."""
    return fixed(value / limit, 2)


def share(part: Column, rest: Column) -> Column:
    """part / (part + rest) with NULL counted as 0; NULL unless the total is positive."""
    top = F.coalesce(part, F.lit(0))
    total = top + F.coalesce(rest, F.lit(0))
    return F.when(total > 0, top / total)


def hours_in_state(state: Column, label: str) -> Column:
    return F.sum(F.when(state == label, 1).otherwise(0))


def mean_of(value: Column, kind: Column, label: str) -> Column:
    """Average of the values of one kind, NULL when there are none."""
    return F.avg(F.when(kind == label, value))
