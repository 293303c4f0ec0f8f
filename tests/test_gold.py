import datetime as dt
import json

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from citylode.operators.spatial import index_zones
from citylode.plans import gold, silver
from citylode.reference_values import ALERT_THRESHOLDS, MERGE_KEYS, REGION_SITES
from citylode.schemas import SERVED_TYPES, as_served

D, E = dt.date(2026, 6, 8), dt.date(2026, 6, 9)
AIR = ("code_site string, nom_site string, type_implantation string, polluant string, unite_mesure string, "
       "date_mesure date, latitude double, longitude double, valeur double, taux_saisie double")


def air(spark, *measures):
    """Measures as (site, pollutant, day, value) or with a unit."""
    data = [(m[0], "Site " + m[0], "Urbaine", m[1], m[4] if len(m) > 4 else "µg/m3", m[2], 0.5, 0.5, m[3], 90.0)
            for m in measures]
    return spark.createDataFrame(data, AIR)


def roads(spark, *days):
    data = [(a, "Rue", d, 0.5, 0.5, flow, flow, 0.1, blocked, 0, 0, 0, 3) for a, d, flow, blocked in days]
    return spark.createDataFrame(
        data, "arc_id string, libelle_arc string, date_jour date, latitude double, longitude double, debit_moyen double, "
        "debit_max double, taux_occupation_moyen double, nb_heures_bloque bigint, nb_heures_sature bigint, "
        "nb_heures_dense bigint, nb_heures_fluide bigint, nb_mesures bigint")


def bikes(spark, *days):
    data = [(c, "Compteur", "s", "Site", d, 0.5, 0.5, n, 1, n) for c, d, n in days]
    return spark.createDataFrame(
        data, "compteur_id string, compteur_nom string, site_id string, nom_site string, date_jour date, latitude double, "
        "longitude double, total_passages_jour bigint, nb_mesures_horaires bigint, pic_horaire bigint")


def square(x):
    ring = [[x, 0], [x + 1, 0], [x + 1, 1], [x, 1], [x, 0]]
    return json.dumps({"type": "Polygon", "coordinates": [ring]})


def zone_table(spark):
    return spark.createDataFrame(
        [(0, "Zero", square(0)), (1, "One", square(1))],
        "arrondissement_code int, nom_arrondissement string, geometry string")


def test_one_day_can_exceed_two_thresholds(spark):
    alerts = gold.pollution_alerts(air(spark, ("A", "NO2", D, 150.0), ("A", "NO2", D, 10.0)))
    got = rows(alerts.select("type_seuil", "seuil_reglementaire", "ratio_depassement", "valeur_moyenne"))
    assert got == [("OMS annuel", 20.0, 7.5, 80.0), ("OMS horaire", 100.0, 1.5, 80.0)]
    key = MERGE_KEYS["dm_alertes_pollution"]
    assert alerts.select(key).distinct().count() == 2


def test_thresholds_are_strict_and_need_the_unit(spark):
    data = air(spark, ("A", "SO2", D, 10.0), ("B", "SO2", D, 11.0, "mg/m3"), ("C", "SO2", D, 10.1), ("D", "CO", D, 99.0))
    assert [r["code_site"] for r in gold.pollution_alerts(data).collect()] == ["C"]
    custom = gold.pollution_alerts(data, thresholds=[("CO", 50.0, "µg/m3", "own")])
    assert rows(custom.select("code_site", "type_seuil")) == [("D", "own")]
    assert len(ALERT_THRESHOLDS) == 6


def test_air_daily_ignores_missing_values(spark):
    mart = gold.air_daily(air(spark, ("A", "O3", D, 4.0), ("A", "O3", D, 6.0), ("A", "O3", D, None), ("B", "O3", D, None)))
    assert rows(mart.select("code_site", "valeur_moyenne", "valeur_min", "valeur_max", "nb_mesures")) == [
        ("A", 5.0, 4.0, 6.0, 2)]


def test_city_days_follow_the_air_measures(spark):
    measures = air(spark, ("A", "NO2", D, 51.0), ("A", "NO2", D, 9.0), ("B", "PM10", D, 60.0), ("A", "NO2", E, 50.0))
    kpi = gold.city_kpi(
        measures, roads(spark, ("r", D, 4.0, 2), ("q", D, 8.0, 1)),
        bikes(spark, ("c", D, 5), ("c", dt.date(2026, 6, 10), 7)))
    first, second = sorted(kpi.collect(), key=lambda r: r["date_jour"])
    assert (first["no2_moyen"], first["pm10_moyen"], first["o3_moyen"]) == (30.0, 60.0, None)
    assert (first["nb_stations_alerte"], first["debit_routier_moyen"], first["total_heures_bloque"]) == (2, 6.0, 3)
    assert (first["nb_arcs_surveilles"], first["total_velos"], first["nb_compteurs_actifs"]) == (2, 5, 1)
    assert second["date_jour"] == E and second["nb_stations_alerte"] is None and second["total_velos"] is None


def zone_days(spark, measures, road_days, bike_days, since=None):
    table = zone_table(spark)
    index = index_zones(table)
    return gold.zone_kpi(
        silver.air_zoned(measures, index), silver.road_zoned(road_days, index),
        silver.bike_zoned(bike_days, index), table, since)


def test_zone_days_need_only_one_domain(spark):
    kpi = zone_days(
        spark, air(spark, ("A", "NO2", D, 10.0)), roads(spark, ("r", D, 30.0, 2)), bikes(spark, ("c", E, 10)))
    got = {r["date_jour"]: r for r in kpi.collect()}
    assert got[D]["nom_arrondissement"] == "Zero" and got[D]["no2_moyen"] == 10.0
    assert got[D]["nb_compteurs_actifs"] is None and got[D]["ratio_mobilite_verte"] == 0.0
    assert got[E]["nb_compteurs_actifs"] == 1 and got[E]["debit_routier_moyen"] is None
    assert got[E]["ratio_mobilite_verte"] == 1.0 and got[E]["total_heures_bloque"] is None


def test_zone_averages_are_nested(spark):
    """The index averages site-day means over all pollutants, not hourly values."""
    kpi = zone_days(
        spark, air(spark, ("A", "NO2", D, 10.0), ("A", "NO2", D, 20.0), ("B", "NO2", D, 45.0), ("B", "SO2", D, 90.0)),
        roads(spark), bikes(spark)).first()
    assert kpi["no2_moyen"] == 30.0  # mean of 15 and 45
    assert kpi["pollution_indice_moyen"] == 50.0  # mean of 15, 45 and 90


def test_zone_kpi_shuffles_facts_once_after_the_domains(spark):
    plan = plan_of(zone_days(spark, air(spark, ("A", "NO2", D, 1.0)), roads(spark, ("r", D, 1.0, 0)), bikes(spark, ("c", D, 1))))
    assert "SortMergeJoin" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_mark_limits_every_mart(spark):
    measures = air(spark, ("A", "NO2", D, 150.0), ("A", "NO2", E, 150.0))
    road, bike = roads(spark, ("r", D, 1.0, 0), ("r", E, 1.0, 0)), bikes(spark, ("c", D, 1), ("c", E, 1))
    assert gold.air_daily(measures, D).count() == 1
    assert gold.pollution_alerts(measures, D).count() == 2
    assert gold.bike_mart(bike, D).count() == gold.road_mart(road, D).count() == 1
    assert [r["date_jour"] for r in gold.city_kpi(measures, road, bike, D).collect()] == [E]
    assert [r["date_jour"] for r in zone_days(spark, measures, road, bike, D).collect()] == [E]
    assert gold.air_daily(measures, E).count() == 0


def test_deltas_add_up_to_a_full_run(spark):
    days = [dt.date(2026, 6, d) for d in range(1, 7)]
    measures = air(spark, *[("A", "NO2", d, float(d.day)) for d in days])
    full = rows(gold.air_daily(measures))
    pieces, mark = [], None
    for upto in (days[1], days[3], days[5]):
        delta = gold.air_daily(measures.filter(F.col("date_mesure") <= F.lit(upto)), mark)
        pieces += delta.collect()
        mark = upto
    assert sorted((tuple(r) for r in pieces), key=str) == full


def test_renamed_counter_gives_two_rows(spark):
    counts = spark.createDataFrame(
        [("c", n, "s", "Site", D, 1.0, 2.0, v) for n, v in (("old", 3), ("new", 4), ("new", None))],
        "compteur_id string, compteur_nom string, site_id string, nom_site string, date_jour date, latitude double, "
        "longitude double, nb_passages bigint")
    assert rows(silver.bike_daily(counts).select("compteur_nom", "total_passages_jour", "nb_mesures_horaires")) == [
        ("new", 4, 1), ("old", 3, 1)]


def test_region_sites(spark):
    assert len(REGION_SITES) == len(set(REGION_SITES)) == 24
    df = spark.createDataFrame([("FR04004",), ("FR99999",), (None,)], "code_site string")
    assert rows(silver.in_region(df)) == [("FR04004",)]


@pytest.mark.parametrize("dataset", list(MERGE_KEYS))
def test_served_tables_hold_their_keys(dataset):
    assert set(MERGE_KEYS[dataset]) <= set(SERVED_TYPES[dataset])


def test_served_types_round_to_scale(spark):
    mart = gold.stamped(gold.air_daily(air(spark, ("A", "O3", D, 1 / 3))))
    served = as_served(mart, "dm_air_quality_daily")
    assert str(served.first()["valeur_moyenne"]) == "0.3333"
    assert dict(served.dtypes)["updated_at"] == "timestamp_ntz"
    assert served.columns == list(SERVED_TYPES["dm_air_quality_daily"])
