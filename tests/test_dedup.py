import datetime as dt
import random

from conftest import plan_of, rows
from pyspark.sql import functions as F

from citylode.operators.dedup import keep_last_load, keep_latest_row, newest_first
from citylode.plans import silver

D, E = dt.date(2026, 6, 8), dt.date(2026, 6, 9)
AT9, AT10 = dt.datetime(2026, 6, 9, 9), dt.datetime(2026, 6, 9, 10)


def loads(spark, data):
    return spark.createDataFrame(data, "k string, day date, _loaded_at timestamp_ntz")


def test_a_partial_reload_replaces_the_whole_day(spark):
    df = loads(spark, [("a", D, AT9), ("b", D, AT9), ("a", D, AT10), ("c", E, AT9)])
    assert rows(keep_last_load(df, F.col("day"))) == [("a", D, AT10), ("c", E, AT9)]


def test_rows_without_load_time_or_day_are_dropped(spark):
    df = loads(spark, [("a", D, None), ("b", D, None), ("c", E, AT9), ("d", E, None), ("e", None, AT9)])
    assert rows(keep_last_load(df, F.col("day"))) == [("c", E, AT9)]


def test_last_load_does_not_move_the_wide_table(spark, tmp_path):
    path = str(tmp_path / "wide")
    loads(spark, [("a", D, AT9)]).write.parquet(path)
    plan = plan_of(keep_last_load(spark.read.parquet(path), F.col("day")))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the per-day maximum only
    assert "SortMergeJoin" not in plan and "Window" not in plan


def test_days_beyond_the_calendar_stay(spark):
    df = loads(spark, [("a", D, AT9), ("b", D, AT10)]).unionByName(spark.sql(
        "select 'c' k, date '+12345-01-01' day, timestamp_ntz '2026-01-01 09:00:00' _loaded_at"))
    assert {r["k"] for r in keep_last_load(df, F.col("day")).select("k").collect()} == {"b", "c"}


def test_latest_row_prunes_before_the_shuffle(spark):
    df = loads(spark, [("a", D, AT9), ("a", E, AT10), ("b", D, None), ("b", E, AT10)])
    latest = keep_latest_row(df, ["k"], [newest_first("_loaded_at"), F.col("day")])
    assert rows(latest) == [("a", E, AT10), ("b", D, None)]
    plan = plan_of(latest)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_row_does_not_depend_on_order(spark):
    data = [("a", D, AT9), ("a", E, AT9), ("a", D, AT10), ("a", E, AT10)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(data)
        latest = keep_latest_row(loads(spark, data), ["k"], [newest_first("_loaded_at"), F.col("day").desc()])
        seen.add(tuple(rows(latest)))
    assert seen == {(("a", E, AT10),)}


def test_hot_day_and_hot_station_stay_exact(spark):
    base = spark.range(30_000)
    df = base.select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("stationcode"),
        F.concat(F.lit("n"), "id").alias("name"), F.lit("3").alias("capacity"),
        F.lit("1").alias("coordonnees_geo_lat"), F.lit("2").alias("coordonnees_geo_lon"),
        F.lit("z").alias("nom_arrondissement_communes"), F.lit("c").alias("code_insee_commune"),
        F.lpad(F.col("id").cast("string"), 8, "0").alias("_file_name"), F.lit(AT9).cast("timestamp_ntz").alias("_loaded_at"))
    stations = silver.bike_stations(df)
    assert stations.count() == 20_001
    assert stations.filter("stationcode = 'hot'").first()["nom_station"] == "n29997"
