"""Colour ramp of the zone map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grey for "no value"; red and green run over the range, blue and alpha do not.
GREY = (190, 190, 190, 160)
RED = (40, 200)
GREEN = (200, -160)
BLUE = 60
ALPHA = 180


def ramp(value: Column, low: Column, high: Column) -> Column:
    """Colour of a value within [low, high] as a struct r, g, b, a of ints.

    Channels are truncated, not rounded. Grey when the value is missing or the range is empty.
    """
    known = value.isNotNull() & ~F.isnan(value) & (high > low)
    position = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - low) / (high - low)))

    def channel(base: int, span: int, fallback: int) -> Column:
        return F.when(known, (F.lit(base) + F.lit(span) * position).cast("int")).otherwise(fallback)

    return F.struct(
        channel(*RED, GREY[0]).alias("r"),
        channel(*GREEN, GREY[1]).alias("g"),
        F.when(known, BLUE).otherwise(GREY[2]).alias("b"),
        F.when(known, ALPHA).otherwise(GREY[3]).alias("a"),
    )
