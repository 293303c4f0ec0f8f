import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from citylode.operators import keyset
from citylode.plans import dashboard, serving

D = [dt.date(2026, 6, d) for d in range(1, 6)]


@pytest.fixture(scope="module")
def zone_kpi(spark):
    data = [(z, f"zone {z}", d, float(z * 10 + d.day)) for z in range(3) for d in D]
    return spark.createDataFrame(data, "arrondissement_code int, nom_arrondissement string, date_jour date, no2_moyen double")


@pytest.fixture(scope="module")
def alert_table(spark):
    data = [(f"s{i}", "Site", "NO2" if i % 2 else "O3", D[i % 5], float(i), 1.0, "u", 2.0, k, i / 10, 1.0, None)
            for i in range(30) for k in ("a", "b")]
    return spark.createDataFrame(
        data, "code_site string, nom_site string, polluant string, date_mesure date, valeur_max_journaliere double, "
        "valeur_moyenne double, unite_mesure string, seuil_reglementaire double, type_seuil string, ratio_depassement double, "
        "latitude double, longitude double")


def test_zone_zero_is_a_zone(zone_kpi):
    got = serving.zone_indicators(zone_kpi, start=D[2], zone=0).collect()
    assert [(r["arrondissement_code"], r["date_jour"]) for r in got] == [(0, D[4]), (0, D[3]), (0, D[2])]


@pytest.mark.parametrize("limit", [0, 1001])
def test_limits_are_checked(zone_kpi, limit):
    with pytest.raises(ValueError):
        serving.zone_indicators(zone_kpi, limit=limit)


def test_pages_are_disjoint_and_cover(alert_table):
    whole = [tuple(r) for r in serving.all_alerts(alert_table).collect()]
    pages = [tuple(r) for o in range(0, 60, 20) for r in serving.alerts(alert_table, limit=20, offset=o).collect()]
    assert pages == whole and len(whole) == 60
    assert serving.all_alerts(alert_table).count() == alert_table.count()
    with pytest.raises(ValueError):
        serving.alerts(alert_table, offset=-1)


def test_pages_after_a_row_cover_all_without_offsets(spark, alert_table):
    """Missing values and ties in the order, and every page size, also one that ends with the table."""
    odd = alert_table.limit(3).selectExpr(*[
        f"cast(null as {t}) as {c}" if c in ("ratio_depassement", "code_site", "unite_mesure", "latitude") else c
        for c, t in alert_table.dtypes]).withColumn("nom_site", F.concat(F.lit("n"), F.monotonically_increasing_id()))
    table = alert_table.unionByName(odd)
    whole = [tuple(r) for r in serving.all_alerts(table).collect()]
    for size in (7, 21, 100):
        got = list(keyset.pages(table, serving.ALERT_ORDER, size))
        assert [tuple(r) for page in got for r in page] == whole and len(whole) == 63
        assert all(len(page) == size for page in got[:-1]) and 0 < len(got[-1]) <= size
    pages, last = [], None
    while rows_ := serving.alerts_after(alert_table, last, pollutant="NO2", limit=4).collect():
        pages += rows_
        last = rows_[-1].asDict()
    assert pages == serving.all_alerts(alert_table, pollutant="NO2").collect()
    with pytest.raises(ValueError):
        serving.alerts_after(alert_table, limit=0)


def test_pages_after_a_row_prune_months(spark, tmp_path):
    from citylode.operators.versions import VersionedTable
    days = [dt.date(2026, m, 5) for m in (1, 2, 3)]
    table = VersionedTable(spark, str(tmp_path), "date_mesure").commit(spark.createDataFrame(
        [(d, 1.0, "s", "NO2", "a", "u", "n", 1.0, 2.0) for d in days], "date_mesure date, ratio_depassement double, code_site string, "
        "polluant string, type_seuil string, unite_mesure string, nom_site string, latitude double, longitude double"))
    first = serving.alerts_after(table, limit=1).first()
    page = serving.alerts_after(table, first.asDict(), limit=5)
    assert [r["date_mesure"] for r in page.collect()] == [days[1], days[0]]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "PartitionFilters: [isnotnull(month" in plan


def test_ordered_limits_are_top_k(alert_table):
    plan = serving.alerts(alert_table, pollutant="NO2", limit=100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_station_queries(spark):
    states = spark.createDataFrame(
        [("2", "T", 3, 4, 1, 1, "A", 1.0, 2.0), ("1", "T", None, 5, 1, 1, "B", None, 2.0)],
        "stationId string, timestamp string, num_bikes_available bigint, num_docks_available bigint, mechanical bigint, "
        "ebike bigint, nom_arrondissement_communes string, latitude double, longitude double")
    assert [r["stationId"] for r in serving.stations(states).collect()] == ["1", "2"]
    assert [r["stationId"] for r in serving.stations(states, area="A", limit=1500).collect()] == ["2"]
    assert serving.station(states, "1").count() == 1 and serving.station(states, "x").count() == 0
    assert tuple(dashboard.fleet_totals(states).first()) == (2, 3, 9)
    assert tuple(dashboard.fleet_totals(states.filter("false")).first()) == (0, 0, 0)
    assert dashboard.with_coordinates(states).count() == 1


def test_exceedance_rows_and_summary(alert_table):
    over = dashboard.exceedances(alert_table, "NO2", 25, value="valeur_max_journaliere")
    assert rows(over.select("code_site", "ratio").distinct()) == [("s27", 1.08), ("s29", 1.16)]
    assert tuple(dashboard.exceedance_summary(over).first()) == (4, 2, 1.16)


def test_zone_snapshot_colours_and_features(spark, zone_kpi):
    shape = json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]})
    reference = spark.createDataFrame(
        [(0, "zone 0", shape), (1, "zone 1", None), (2, "zone 2", shape), (3, "zone 3", shape)],
        "arrondissement_code int, nom_arrondissement string, geometry string")
    snap = dashboard.zone_snapshot(reference, zone_kpi)
    assert rows(snap.select("arrondissement_code", "no2_moyen", "date_jour")) == [
        (0, 5.0, D[4]), (1, 15.0, D[4]), (2, 25.0, D[4]), (3, None, None)]
    coloured = dashboard.zone_colours(snap, "no2_moyen")
    assert [tuple(r["fill_color"]) for r in coloured.orderBy("arrondissement_code").collect()] == [
        (40, 200, 60, 180), (140, 120, 60, 180), (240, 40, 60, 180), (190, 190, 190, 160)]
    features = {r["arrondissement_code"]: json.loads(r["feature"]) for r in dashboard.zone_features(coloured, "no2_moyen").collect()}
    assert sorted(features) == [0, 2, 3]
    assert features[0]["geometry"] == json.loads(shape)
    assert features[3]["properties"] == {"nom_arrondissement": "zone 3", "value": None, "fill_color": [190, 190, 190, 160]}


def test_latest_city_day(spark):
    kpi = spark.createDataFrame([(d, float(d.day)) for d in D], "date_jour date, no2_moyen double")
    assert dashboard.latest_city_day(kpi).first()["date_jour"] == D[4]
    assert serving.city_indicators(kpi, end=D[1]).count() == 2
