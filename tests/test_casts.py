import datetime as dt

import pytest
from pyspark.sql import functions as F

from citylode.functions import casts
from citylode.functions.numeric import fixed, share, times_over
from citylode.functions.palette import ramp


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()[0]


@pytest.mark.parametrize("text, number", [
    ("12", 12), ("12.0", 12), ("12.5", 13), ("", None), ("bad", None), (None, None), ("-3", -3)])
def test_whole_number_rounds_fractions(spark, text, number):
    assert one(spark, casts.whole_number(F.lit(text).cast("string"))) == number


def test_iso_times_keep_the_wall_clock(spark):
    text = F.lit("2026-06-08T23:30:00+02:00")
    assert one(spark, casts.iso_stamp(text)) == dt.datetime(2026, 6, 8, 23, 30)
    assert one(spark, casts.iso_day(text)) == dt.date(2026, 6, 8)
    assert one(spark, casts.iso_stamp(F.lit("soon"))) is None


def test_stamp_is_strict_unless_told_otherwise(spark):
    assert one(spark, casts.stamp(F.lit("2026/06/08 23:00:00"))) == dt.datetime(2026, 6, 8, 23)
    assert one(spark, casts.stamp(F.lit("08-06-2026"), strict=False)) is None
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        one(spark, casts.stamp(F.lit("08-06-2026")))


@pytest.mark.parametrize("pair, place", [
    ("48.85, 2.35", (48.85, 2.35)), ("48.85", (48.85, None)), (None, (None, None)), ("x,2", (None, 2.0))])
def test_coordinate_pairs(spark, pair, place):
    text = F.lit(pair).cast("string")
    got = spark.range(1).select(casts.latitude(text), casts.longitude(text)).first()
    assert tuple(got) == place


def test_yes_and_dates(spark):
    assert one(spark, casts.is_yes(F.lit("oui"))) is True
    assert one(spark, casts.is_yes(F.lit(None).cast("string"))) is False
    assert one(spark, casts.day_in_format(F.lit("31/12/2020"))) is None
    assert one(spark, casts.day_in_format(F.lit("2020-12-31"))) == dt.date(2020, 12, 31)


def test_rounding_is_half_up_on_the_decimal(spark):
    assert one(spark, fixed(F.lit(1.005), 2)) == 1.01
    assert one(spark, fixed(F.lit(0.285), 2)) == 0.29
    assert one(spark, times_over(F.lit(150.0), F.lit(20.0))) == 7.5


def test_share_needs_a_positive_total(spark):
    none = F.lit(None).cast("double")
    assert one(spark, share(F.lit(3), F.lit(1.0))) == 0.75
    assert one(spark, share(none, F.lit(1.0))) == 0.0
    assert one(spark, share(F.lit(0), F.lit(0.0))) is None
    assert one(spark, share(none, none)) is None


def test_ramp_truncates_and_falls_back_to_grey(spark):
    def colour(v, low, high):
        return tuple(one(spark, ramp(F.lit(v).cast("double"), F.lit(low).cast("double"), F.lit(high).cast("double"))))
    assert colour(0, 0, 10) == (40, 200, 60, 180)
    assert colour(10, 0, 10) == (240, 40, 60, 180)
    assert colour(1, 0, 3) == (106, 146, 60, 180)
    assert colour(99, 0, 10) == (240, 40, 60, 180)
    for missing in ((None, 0, 10), (5, None, None), (5, 5, 5)):
        assert colour(*missing) == (190, 190, 190, 160)
