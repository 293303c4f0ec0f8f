import dataclasses
import datetime as dt
import json

import pytest
from conftest import rows

from citylode.operators.lookup import RepeatedKey
from citylode.operators.quality import QualityError
from citylode.operators.versions import read_table
from citylode.operators.watermark import Watermarks
from citylode.plans import nightly
from citylode.plans.checks import REQUIRED
from citylode.reference_values import MERGE_KEYS
from citylode.schemas import AIR_COLUMNS, BIKE_COLUMNS, ROAD_COLUMNS, STATION_COLUMNS

AT = dt.datetime(2026, 6, 9, 9)


def raw_table(spark, columns, records, loaded=AT):
    schema = ", ".join(f"{c} string" for c in columns) + ", _file_name string, _loaded_at timestamp_ntz"
    return spark.createDataFrame([tuple(r.get(c) for c in columns) + ("f", loaded) for r in records], schema)


def measure(site="S1", day="2026/06/08", hour=1, value="30", pollutant="NO2"):
    return {"date_debut": f"{day} {hour:02d}:00:00", "date_fin": f"{day} {hour:02d}:59:00", "code_site": site,
            "nom_site": "Site", "organisme": "O", "polluant": pollutant, "valeur": value, "unite_mesure": "µg/m3", "taux_saisie": "90"}


def bike(day="2026-06-08", count="12.0"):
    return {"compteur_id": "c1", "compteur_nom": "C", "sum_counts": count, "date": f"{day}T08:00:00+02:00",
            "coordonnees_geographiques": "0.5, 0.5"}


def road(day="2026-06-08", hour=8, state="Bloqué"):
    return {"iu_ac": "r1", "libelle": "Rue", "t_1h": f"{day}T{hour:02d}:00:00+02:00", "q": "10", "k": "1.5",
            "etat_trafic": state, "geo_point_2d": "0.5, 0.5"}


def documents(spark):
    zone = {"type": "FeatureCollection", "features": [{
        "type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]},
        "properties": {"c_ar": 1, "c_arinsee": "75101", "l_aroff": "Un", "surface": 1.0, "geom_x_y": {"lat": .5, "lon": .5}}}]}
    return spark.createDataFrame([(json.dumps(zone),)], "t string").selectExpr("parse_json(t) as raw_geojson", "now() as _loaded_at")


def raw(spark, air, bikes, roads):
    sites = raw_table(spark, ["code_site", "latitude", "longitude"], [{"code_site": "S1", "latitude": "0.5", "longitude": "0.5"}])
    return nightly.Raw(
        raw_table(spark, AIR_COLUMNS, air), sites, raw_table(spark, BIKE_COLUMNS, bikes),
        raw_table(spark, ROAD_COLUMNS, roads), documents(spark))


def counts(exported):
    return {d: e.rows for d, e in exported.items()}


def test_a_day_then_a_repeat_then_a_new_day(spark, tmp_path):
    root = str(tmp_path)
    air, bikes, roads = [measure(), measure(hour=2, value="150")], [bike()], [road(), road(hour=9, state="Dense")]
    first = nightly.run_day(spark, raw(spark, air, bikes, roads), root, dt.datetime(2026, 6, 9, 6), sites=["S1"])
    assert counts(first) == {
        "dm_air_quality_daily": 1, "dm_alertes_pollution": 2, "dm_velo_daily": 1, "dm_trafic_routier_daily": 1,
        "dm_smartcity_kpi_daily": 1, "dm_zone_kpi_daily": 1, "ref_arrondissements": 1}

    def served(name):
        return read_table(spark, f"{root}/serving/{name}")

    before = {n: served(n).count() for n in MERGE_KEYS}
    again = nightly.run_day(spark, raw(spark, air, bikes, roads), root, dt.datetime(2026, 6, 9, 7), sites=["S1"])
    assert {d: n for d, n in counts(again).items() if n} == {"ref_arrondissements": 1}
    assert {n: served(n).count() for n in MERGE_KEYS} == before
    assert spark.read.parquet(first["dm_velo_daily"].path).count() == 1  # the repeat left it alone

    later = nightly.run_day(
        spark, raw(spark, air + [measure(day="2026/06/09")], bikes + [bike("2026-06-09", "bad")], roads), root,
        dt.datetime(2026, 6, 10, 6), sites=["S1"])
    assert counts(later)["dm_air_quality_daily"] == 1 and counts(later)["dm_velo_daily"] == 0
    kpi = rows(served("dm_smartcity_kpi_daily").select("date_jour", "nb_stations_alerte", "total_velos"))
    assert kpi == [(dt.date(2026, 6, 8), 1, 12), (dt.date(2026, 6, 9), None, None)]
    marks = dict(rows(Watermarks(spark, root + "/watermark").current()))
    assert marks["dm_air_quality_daily"] == dt.date(2026, 6, 9) and marks["dm_velo_daily"] == dt.date(2026, 6, 8)
    report = nightly.report(spark, later)
    assert report.count() == 7


def test_late_rows_need_a_lookback(spark, tmp_path):
    root = str(tmp_path)
    nightly.run_day(spark, raw(spark, [measure(day="2026/06/08")], [bike()], [road()]), root, sites=["S1"])
    late = raw(spark, [measure(day="2026/06/08"), measure(day="2026/06/07")], [bike()], [road()])
    assert counts(nightly.run_day(spark, late, root, sites=["S1"]))["dm_air_quality_daily"] == 0
    assert counts(nightly.run_day(spark, late, root, lookback_days=3, sites=["S1"]))["dm_air_quality_daily"] == 2
    assert read_table(spark, root + "/serving/dm_air_quality_daily").count() == 2


def test_a_failed_check_stops_before_the_marts(spark, tmp_path):
    bad = raw(spark, [measure(site="S2")], [bike()], [road()])  # S2 has no coordinates
    with pytest.raises(QualityError, match="not_null:latitude"):
        nightly.run_day(spark, bad, str(tmp_path), sites=["S2"])
    assert not (tmp_path / "gold_export").exists()


def test_repeated_sites_stop_a_run_before_they_are_looked_up(spark, tmp_path):
    tables = raw(spark, [measure()], [bike()], [road()])
    twice = dataclasses.replace(tables, sites=tables.sites.unionByName(tables.sites))
    with pytest.raises(QualityError, match="raw_coordonnees unique:code_site: 1; stg_coordonnees unique:code_site: 1"):
        nightly.run_day(spark, twice, str(tmp_path), sites=["S1"])
    assert not (tmp_path / "silver" / "int_air_quality_idf").exists()
    stages = spark.read.parquet(str(tmp_path / "checks")).select("stage").distinct()
    assert rows(stages) == [("staging",)]
    with pytest.raises(RepeatedKey, match="code_site 'S1': 2 rows"):
        nightly.build_silver(spark, twice, str(tmp_path), ["S1"])


def test_a_missing_key_in_a_raw_table_stops_a_run(spark, tmp_path):
    with pytest.raises(QualityError, match="raw_trafic_velo not_null:compteur_id: 1"):
        nightly.run_day(spark, raw(spark, [measure()], [bike() | {"compteur_id": None}], [road()]), str(tmp_path), sites=["S1"])


def test_all_tables_are_checked(spark, tmp_path):
    tables = raw(spark, [measure()], [bike()], [road() | {"geo_point_2d": "somewhere"}])
    stations = raw_table(spark, STATION_COLUMNS, [
        {"stationcode": "1", "name": "A", "coordonnees_geo_lat": "48.8", "coordonnees_geo_lon": "2.3"}])
    nightly.run_day(spark, dataclasses.replace(tables, stations=stations), str(tmp_path), sites=["S1"])
    report = spark.read.parquet(str(tmp_path / "checks"))
    assert {r["table_name"] for r in report.collect()} == set(REQUIRED)
    assert rows(report.filter("failures > 0").select("table_name", "check_name", "severity", "failures")) == [
        ("raw_trafic_routier", "readable:geo_point_2d", "warn", 1)]


def test_a_failed_mart_does_not_hold_back_the_others(spark, tmp_path):
    day = spark.createDataFrame([("c1", dt.date(2026, 6, 8))], "compteur_id string, date_jour date")

    def broken(since):
        raise RuntimeError("no such column")

    marks = Watermarks(spark, str(tmp_path / "marks"))
    with pytest.raises(RuntimeError, match="no such column"):
        nightly.export_marts(
            {"dm_velo_daily": lambda since: day, "dm_zone_kpi_daily": broken}, str(tmp_path), marks, AT)
    assert marks.all() == {"dm_velo_daily": dt.date(2026, 6, 8)}


def test_rows_lost_before_serving_are_exported_again(spark, tmp_path, monkeypatch):
    root, tables = str(tmp_path), raw(spark, [measure()], [bike()], [road()])
    upsert = nightly.upsert_table

    def fail(session, path, *args):
        if path.endswith("dm_velo_daily"):
            raise OSError("lost")
        upsert(session, path, *args)

    monkeypatch.setattr(nightly, "upsert_table", fail)
    with pytest.raises(OSError, match="lost"):
        nightly.run_day(spark, tables, root, dt.datetime(2026, 6, 9, 6), sites=["S1"])
    monkeypatch.undo()
    again = nightly.run_day(spark, tables, root, dt.datetime(2026, 6, 9, 7), sites=["S1"])
    assert counts(again)["dm_velo_daily"] == 1 and counts(again)["dm_trafic_routier_daily"] == 0
    assert read_table(spark, f"{root}/serving/dm_velo_daily").count() == 1
    assert spark.read.parquet(f"{root}/checks").filter("table_name is not null").count() > 0
