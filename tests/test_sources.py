import datetime as dt
import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from citylode.operators.dedup import keep_last_load
from citylode.operators.predicates import all_of, date_range, day_slice, equals, latest_available_day
from citylode.plans import silver
from citylode.schemas import SITE_COLUMNS
from citylode.sinks.export import export_counted, export_snapshot, report_line, snapshot_path
from citylode.sources import files, landing


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_delimited_scan_by_position_with_quarantine(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'x;y;z\nFR1;"48;85";2\nFR2;;""\nFR3\n"FR""4";é;1\n')
    good, bad = files.split_corrupt(files.read_delimited(spark, path, SITE_COLUMNS))
    assert rows(good.select(SITE_COLUMNS)) == [('FR"4', "é", "1"), ("FR1", "48;85", "2"), ("FR2", None, "")]
    assert rows(bad.select("_corrupt_record", "fields_present")) == [("FR3", 1)]
    lineage = good.select("_file_name", "_loaded_at").distinct().collect()
    assert len(lineage) == 1 and lineage[0][0].endswith("a.csv") and lineage[0][1] is not None


def test_arrival_stamps_tell_runs_apart(spark, tmp_path):
    import os
    for name, at in (("early", 1_700_000_000), ("late", 1_700_009_000)):
        path = write(tmp_path / "in" / f"{name}.csv", f"h;h;h\n{name};1;2\n")
        os.utime(path, (at, at))
    good, _ = files.split_corrupt(files.read_delimited(spark, str(tmp_path / "in"), SITE_COLUMNS, "arrival"))
    assert good.select("_loaded_at").distinct().count() == 2


def test_station_arrays(spark, tmp_path):
    path = write(tmp_path / "s.json", json.dumps([
        {"stationcode": "1", "name": "A", "capacity": 12, "coordonnees_geo": {"lat": 48.8, "lon": 2.3}},
        {"stationcode": "2", "name": "B", "coordonnees_geo": None}], indent=1))
    scan = files.read_stations(spark, path)
    assert rows(scan.select("stationcode", "capacity", "coordonnees_geo_lat", "coordonnees_geo_lon")) == [
        ("1", "12", "48.8", "2.3"), ("2", None, None, None)]
    assert silver.bike_stations(scan).filter("stationcode = '1'").first()["capacite"] == 12


def test_geojson_documents(spark, tmp_path):
    feature = {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]},
               "properties": {"c_ar": 3, "c_arinsee": 75103, "l_aroff": "Trois", "surface": 1.5,
                              "geom_x_y": {"lat": 48.1, "lon": 2.1}}}
    write(tmp_path / "z" / "a.json", json.dumps({"type": "FeatureCollection", "features": [feature, {**feature, "properties": {}}]}, indent=2))
    write(tmp_path / "z" / "b.json", "not json")
    docs = files.read_documents(spark, str(tmp_path / "z"))
    assert docs.count() == 1
    got = silver.zones(docs).orderBy(F.col("arrondissement_code").desc_nulls_last()).collect()
    assert tuple(got[0])[:6] == (3, "75103", "Trois", 1.5, 48.1, 2.1)
    assert json.loads(got[0]["geometry"]) == feature["geometry"]
    assert got[1]["arrondissement_code"] is None


def test_landing_paths_and_routing(spark, tmp_path):
    path = landing.landing_path("/raw", "velo_counts", dt.date(2026, 6, 8), dt.datetime(2026, 6, 9, 7, 5))
    assert path == "/raw/velo_counts/2026/06/08/07/05"
    stamp = spark.range(1).select(landing.run_stamp(F.lit(path + "/f.csv")), landing.run_stamp(F.lit("/raw/f.csv"))).first()
    assert tuple(stamp) == (dt.datetime(2026, 6, 8, 7, 5), None)
    paths = spark.createDataFrame(
        [("gold_export/dm_velo_daily/20260608.parquet",), ("b/gold_export/dm_zone_kpi_daily/x/y.parquet",),
         ("gold_export/other/x.parquet",), ("elsewhere",)], "path string")
    assert rows(landing.route(paths).select("dataset")) == [("dm_velo_daily",), ("dm_zone_kpi_daily",)]
    write(tmp_path / "s" / "2026" / "06" / "08" / "07" / "05" / "f.csv", "h;h;h\na;1;2\n")
    scan = files.read_delimited(spark, landing.all_runs(str(tmp_path), "s"), SITE_COLUMNS)
    assert scan.count() == 1


def test_optional_predicates(spark):
    df = spark.createDataFrame([(i, dt.date(2026, 6, i + 1)) for i in range(5)], "z int, d date")
    assert df.filter(all_of()).count() == 5
    assert df.filter(date_range("d", dt.date(2026, 6, 2), dt.date(2026, 6, 3))).count() == 2
    assert df.filter(all_of(equals("z", 0))).count() == 1
    assert df.filter(all_of(equals("z", None), None)).count() == 5


def test_day_slice_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(
        [(dt.datetime(2026, 6, 8, 23, 59),), (dt.datetime(2026, 6, 9),), (dt.datetime(2026, 6, 9, 12),)],
        "ts timestamp_ntz").write.parquet(path)
    part = day_slice(spark.read.parquet(path), "ts", dt.date(2026, 6, 9))
    assert part.count() == 2
    assert "GreaterThanOrEqual(ts" in part._jdf.queryExecution().executedPlan().toString()


def test_latest_available_day_looks_back_three_days(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 6, d, 5),) for d in (4, 5, 6, 6)], "ts timestamp_ntz")
    assert latest_available_day(df, "ts", dt.date(2026, 6, 8)).count() == 2
    assert latest_available_day(df, "ts", dt.date(2026, 6, 5)).count() == 1
    assert latest_available_day(df, "ts", dt.date(2026, 6, 9), required=False).count() == 0
    with pytest.raises(Exception, match="no data from 2026-06-07 to 2026-06-09"):
        latest_available_day(df, "ts", dt.date(2026, 6, 9)).count()


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2026, 6, 8)), (2, dt.date(2026, 6, 9))], "K int, day date")
    root, day = str(tmp_path), dt.date(2026, 6, 10)
    for _ in range(2):
        path = export_snapshot(df, root, "dm_x", day, single_file=True)
    assert path == snapshot_path(root, "dm_x", day) and path.endswith("gold_export/dm_x/run_date=2026-06-10")
    assert files.read_lowered(spark, path).columns == ["k", "day"]
    assert files.read_lowered(spark, path).count() == 2
    assert export_counted(df, path + "/c", "day") == (2, dt.date(2026, 6, 9))
    assert export_counted(df.filter("K > 9"), path + "/d", "day") == (0, None)
    assert export_counted(df, path + "/e", None) == (2, None)
    assert report_line({"a": 1, "b": 0}) == "a:1 | b:0"


def test_unknown_load_stamp(spark, tmp_path):
    with pytest.raises(KeyError):
        files.read_delimited(spark, write(tmp_path / "a.csv", "h\n"), ["c"], "guess")


def test_malformed_rows_stay_out_of_pruned_queries(spark, tmp_path):
    path = write(tmp_path / "p.csv", "h\nA;1;2;3\nB;1\nC;1;2;3;4;5\n".replace("A;1;2;3", ";".join("A123")))
    columns = ["code", "x", "y", "z"]
    good, bad = files.split_corrupt(files.read_delimited(spark, path, columns))
    assert good.count() == 1 and bad.count() == 2
    assert [r["code"] for r in good.select("code", "x").collect()] == ["A"]
    assert good.groupBy("x").count().collect() == [("1", 1)]


def test_a_day_loaded_twice_counts_once(spark, tmp_path):
    day = dt.date(2026, 6, 1)
    for hour, value in ((8, "1"), (9, "2")):
        folder = Path(landing.landing_path(str(tmp_path), "s", day, dt.datetime(2026, 6, 2, hour, 0)))
        folder.mkdir(parents=True)
        for part in ("a", "b"):
            (folder / f"{part}.csv").write_text(f"h\n2026-06-01;{part};{value}\n")
    good, _ = files.split_corrupt(files.read_delimited(spark, landing.all_runs(str(tmp_path), "s"), ["day", "k", "v"]))
    last = keep_last_load(good, F.col("day").cast("date"))
    assert sorted((r["k"], r["v"]) for r in last.collect()) == [("a", "2"), ("b", "2")]
