"""Column expressions that turn raw text into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT = "yyyy/MM/dd HH:mm:ss"


def number(text: Column) -> Column:
    """Text to double, NULL when it does not parse."""
    return text.try_cast("double")


def whole_number(text: Column) -> Column:
    """Text to integer, rounding a fraction: '12.0' is 12, '12.5' is 13, 'bad' is NULL.

    Only text that is not plainly an integer takes the slower way through a decimal.
    """
    rounded = F.round(text.try_cast("decimal(38,6)"), 0).try_cast("bigint")
    return F.coalesce(text.try_cast("bigint"), rounded)


def stamp(text: Column, strict: bool = True) -> Column:
    """Text such as 2026/06/08 23:00:00 to a wall-clock timestamp; strict fails the query on bad text."""
    parse = F.to_timestamp_ntz if strict else F.try_to_timestamp
    parsed = parse(text, F.lit(STAMP_FORMAT))
    return parsed if strict else parsed.cast("timestamp_ntz")


def iso_stamp(text: Column) -> Column:
    """ISO text to its wall-clock timestamp (an offset is dropped, not applied), NULL when bad."""
    return text.try_cast("timestamp_ntz")


def iso_day(text: Column) -> Column:
    """Calendar day written in ISO text; fails the query on text without one."""
    return text.cast("date")


def day_in_format(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date under one pattern, NULL when it does not match."""
    return F.try_to_date(text, pattern)


def latitude(pair: Column) -> Column:
    """First half of 'lat,lon' text, NULL when absent or bad."""
    return F.substring_index(pair, ",", 1).try_cast("double")


def longitude(pair: Column) -> Column:
    """Second half of 'lat,lon' text, NULL when absent or bad. Unlike ``split_part``, this builds no array a row."""
    second = F.substring_index(F.substring_index(pair, ",", 2), ",", -1)
    return F.when(F.contains(pair, F.lit(",")), second).try_cast("double")


def is_yes(text: Column) -> Column:
    """True for 'oui' in any case; anything else, NULL included, is false."""
    return F.coalesce(F.upper(text) == F.lit("OUI"), F.lit(False))


def load_stamp() -> Column:
    """The time of the running batch as a wall-clock timestamp."""
    return F.current_timestamp().cast("timestamp_ntz")
