"""SQL counterparts of the named queries, one self-contained statement each.

Named subqueries build on one another; a statement is prefixed by those it needs. Zones are tested by
the closed form of a diamond, and the last load of a day by a window, so both differ in kind from the
library's way.
"""

from __future__ import annotations

import re

from citylode.catalog.analogs import ANALOGS, duck_cte
from citylode.reference_values import (
    ALERT_THRESHOLDS, CLASSIFIED_HOURS, QUALITY_CODES, SITE_SETTINGS, TRAFFIC_STATES,
)


def mean(expression: str) -> str:
    return f"cast(round(cast({expression} as decimal(18,6)), 4) as double)"


def ratio(expression: str) -> str:
    return f"cast(round(cast({expression} as decimal(28,10)), 2) as double)"


def values(items) -> str:
    return ", ".join("'" + str(i).replace("'", "''") + "'" for i in items)


PARSE = "strptime({0}, '%Y/%m/%d %H:%M:%S')"
WHOLE = "cast(round(try_cast({0} as decimal(38,6)), 0) as bigint)"
THRESHOLDS = ", ".join(f"('{p}', cast({t} as double), '{u}', '{k}')" for p, t, u, k in ALERT_THRESHOLDS)
HOURS = ", ".join(
    f"cast(sum(case when etat_trafic = '{s}' then 1 else 0 end) as bigint) as {c}"
    for c, s in CLASSIFIED_HOURS.items())
CLASSIFIED = " + ".join(CLASSIFIED_HOURS)


def pivot(value: str, columns: dict[str, str]) -> str:
    return ", ".join(f"avg(case when polluant = '{p}' then {value} end) as {c}" for c, p in columns.items())


def last_load(source: str, day: str, where: str) -> str:
    return (f"select * from (select *, max(_loaded_at) over (partition by {day}) as newest_ from {source} "
            f"where {where}) t where _loaded_at = newest_")


CTES: dict[str, str] = {
    **{name: duck_cte(name) for name in ANALOGS},
    "last_air": last_load("raw_air_quality", f"cast({PARSE.format('date_debut')} as date)", "date_debut is not null"),
    "stg_air": f"""select {PARSE.format('date_debut')} as date_debut, {PARSE.format('date_fin')} as date_fin, organisme,
        code_site, nom_site, type_implantation, polluant, coalesce(upper(reglementaire) = 'OUI', false) as reglementaire,
        try_cast(valeur as double) as valeur, try_cast(valeur_brute as double) as valeur_brute, unite_mesure,
        try_cast(taux_saisie as double) as taux_saisie, code_qualite, try_cast(validite as double) as validite, _file_name
        from last_air where code_site is not null""",
    "coords": """select code_site, try_cast(latitude as double) as latitude, try_cast(longitude as double) as longitude
        from raw_coordonnees where code_site is not null""",
    "air": """select a.*, c.latitude, c.longitude, cast(a.date_debut as date) as date_mesure
        from stg_air a left join coords c on a.code_site = c.code_site
        where cast(substr(a.code_site, 5, 3) as int) < 24""",
    "last_bike": last_load("raw_trafic_velo", 'cast(substr("date", 1, 10) as date)', '"date" is not null'),
    "stg_bike": f"""select compteur_id, compteur_nom, site_id, "name" as nom_site, {WHOLE.format('sum_counts')} as nb_passages,
        cast(substr("date", 1, 10) || ' ' || substr("date", 12, 8) as timestamp) as date_comptage,
        cast(substr("date", 1, 10) as date) as date_jour,
        case when date_installation like '____-__-__' then cast(date_installation as date) end as date_installation,
        try_cast(split_part(coordonnees_geographiques, ',', 1) as double) as latitude,
        try_cast(split_part(coordonnees_geographiques, ',', 2) as double) as longitude, mois_annee_comptage, _file_name
        from last_bike where compteur_id is not null""",
    "last_road": last_load("raw_trafic_routier", "cast(substr(t_1h, 1, 10) as date)", "t_1h is not null"),
    "stg_road": """select iu_ac as arc_id, libelle as libelle_arc,
        cast(substr(t_1h, 1, 10) || ' ' || substr(t_1h, 12, 8) as timestamp) as comptage_datetime,
        cast(substr(t_1h, 1, 10) as date) as date_jour, try_cast(q as double) as debit_horaire,
        try_cast(k as double) as taux_occupation, etat_trafic, iu_nd_amont as noeud_amont_id, libelle_nd_amont,
        iu_nd_aval as noeud_aval_id, libelle_nd_aval, etat_barre,
        try_cast(split_part(geo_point_2d, ',', 1) as double) as latitude,
        try_cast(trim(split_part(geo_point_2d, ',', 2)) as double) as longitude, _file_name
        from last_road where iu_ac is not null""",
    "bikes": """select compteur_id, compteur_nom, site_id, nom_site, date_jour, latitude, longitude,
        cast(sum(nb_passages) as bigint) as total_passages_jour, count(*) as nb_mesures_horaires, max(nb_passages) as pic_horaire
        from stg_bike where nb_passages is not null group by all""",
    "roads": f"""select arc_id, libelle_arc, date_jour, latitude, longitude, avg(debit_horaire) as debit_moyen,
        max(debit_horaire) as debit_max, avg(taux_occupation) as taux_occupation_moyen, {HOURS}, count(*) as nb_mesures
        from stg_road where comptage_datetime is not null group by arc_id, libelle_arc, date_jour, latitude, longitude""",
    "diamonds": """select c_ar as arrondissement_code, c_arinsee as code_insee, l_aroff as nom_arrondissement,
        surface as surface_m2, cx, cy from zone_shapes""",
    "air_z": """select arrondissement_code, nom_arrondissement, date_mesure as date_jour, code_site, polluant,
        avg(valeur) as valeur_moyenne, max(valeur) as valeur_max
        from air join diamonds on abs(longitude - cx) + abs(latitude - cy) < 0.5
        where valeur is not null group by 1, 2, 3, 4, 5""",
    "road_z": """select arrondissement_code, nom_arrondissement, date_jour, arc_id, debit_moyen, taux_occupation_moyen,
        nb_heures_bloque from roads join diamonds on abs(longitude - cx) + abs(latitude - cy) < 0.5""",
    "bike_z": """select arrondissement_code, nom_arrondissement, date_jour, compteur_id, total_passages_jour
        from bikes join diamonds on abs(longitude - cx) + abs(latitude - cy) < 0.5""",
    "m_air": """select code_site, nom_site, type_implantation, polluant, unite_mesure, date_mesure, latitude, longitude,
        avg(valeur) as valeur_moyenne, max(valeur) as valeur_max, min(valeur) as valeur_min, count(*) as nb_mesures,
        avg(taux_saisie) as taux_saisie_moyen from air where valeur is not null group by 1, 2, 3, 4, 5, 6, 7, 8""",
    "thresholds": f"select * from (values {THRESHOLDS}) v(s_polluant, seuil, s_unite, type_seuil)",
    "peaks": """select code_site, nom_site, polluant, unite_mesure, date_mesure, latitude, longitude,
        max(valeur) as valeur_max, avg(valeur) as valeur_moyenne from air where valeur is not null group by 1, 2, 3, 4, 5, 6, 7""",
    "m_alerts": f"""select code_site, nom_site, polluant, date_mesure, valeur_max as valeur_max_journaliere, valeur_moyenne,
        unite_mesure, seuil as seuil_reglementaire, type_seuil, {ratio('valeur_max / seuil')} as ratio_depassement,
        latitude, longitude from peaks join thresholds on polluant = s_polluant and unite_mesure = s_unite
        where valeur_max > seuil""",
    "m_bike": """select compteur_id, compteur_nom, nom_site, date_jour, total_passages_jour, nb_mesures_horaires,
        pic_horaire, latitude, longitude from bikes""",
    "air_pivot": f"""select date_mesure as date_jour, {pivot('valeur', dict(no2_moyen='NO2', pm10_moyen='PM10', pm25_moyen='PM2.5', o3_moyen='O3'))}
        from air where valeur is not null group by 1""",
    "in_alert": """select date_mesure as date_jour, count(distinct code_site) as nb_stations_alerte from air
        where valeur > 50 group by 1""",
    "road_day": """select date_jour, avg(debit_moyen) as debit_routier_moyen, avg(taux_occupation_moyen) as taux_occupation_moyen,
        cast(sum(nb_heures_bloque) as bigint) as total_heures_bloque, count(distinct arc_id) as nb_arcs_surveilles from roads group by 1""",
    "bike_day": """select date_jour, cast(sum(total_passages_jour) as bigint) as total_velos,
        count(distinct compteur_id) as nb_compteurs_actifs from bikes group by 1""",
    "m_city": """select * from air_pivot left join in_alert using (date_jour) left join road_day using (date_jour)
        left join bike_day using (date_jour)""",
    "air_zd": f"""select arrondissement_code, date_jour, {pivot('valeur_moyenne', dict(no2_moyen='NO2', pm10_moyen='PM10', pm25_moyen='PM2.5'))},
        avg(valeur_moyenne) as pollution_indice_moyen from air_z group by 1, 2""",
    "road_zd": """select arrondissement_code, date_jour, avg(debit_moyen) as debit_routier_moyen,
        avg(taux_occupation_moyen) as taux_occupation_moyen, cast(sum(nb_heures_bloque) as bigint) as total_heures_bloque
        from road_z group by 1, 2""",
    "bike_zd": """select arrondissement_code, date_jour, cast(sum(total_passages_jour) as bigint) as total_velos,
        count(distinct compteur_id) as nb_compteurs_actifs from bike_z group by 1, 2""",
    "spine": """select arrondissement_code, date_jour from air_z union select arrondissement_code, date_jour from road_z
        union select arrondissement_code, date_jour from bike_z""",
    "m_zone": """select s.arrondissement_code, d.nom_arrondissement, s.date_jour, no2_moyen, pm10_moyen, pm25_moyen,
        pollution_indice_moyen, debit_routier_moyen, taux_occupation_moyen, total_heures_bloque, total_velos,
        nb_compteurs_actifs, case when coalesce(total_velos, 0) + coalesce(debit_routier_moyen, 0) > 0
        then coalesce(total_velos, 0) / (coalesce(total_velos, 0) + coalesce(debit_routier_moyen, 0)) end as ratio_mobilite_verte
        from spine s left join diamonds d on s.arrondissement_code = d.arrondissement_code
        left join air_zd a on s.arrondissement_code = a.arrondissement_code and s.date_jour = a.date_jour
        left join road_zd r on s.arrondissement_code = r.arrondissement_code and s.date_jour = r.date_jour
        left join bike_zd b on s.arrondissement_code = b.arrondissement_code and s.date_jour = b.date_jour""",
    "states": """select * exclude (rn) from (select *, row_number() over (partition by "stationId"
        order by "timestamp" desc, position desc) as rn from station_states where coalesce("stationId", '') <> '') t where rn = 1""",
    "customer_points": """select c_custkey, (c_custkey * 7919 % 5003) * 5 / cast(5003 as double) as longitude,
        (c_custkey * 104729 % 4999) * 5 / cast(4999 as double) as latitude from customer""",
    "zone_now": """select d.arrondissement_code, d.nom_arrondissement, d.cy as centroid_lat, d.cx as centroid_lon,
        k.* exclude (arrondissement_code, nom_arrondissement) from diamonds d left join
        (select * from m_zone where date_jour = (select max(date_jour) from m_zone)) k
        on d.arrondissement_code = k.arrondissement_code""",
    "ramped": """select *, case when total_velos is null or top = low then null
        else cast(total_velos - low as double) / (top - low) end as share
        from (select *, min(total_velos) over () as low, max(total_velos) over () as top from zone_now) t""",
}


def with_ctes(statement: str) -> str:
    """Prefix a statement by the named subqueries it uses, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_0-9]+", text)):
            if word in CTES and word not in needed:
                needed.add(word)
                visit(CTES[word])

    visit(statement)
    # A subquery may be named before it is defined only if listed earlier, so keep the listed order.
    parts = [f"{name} as ({body})" for name, body in CTES.items() if name in needed]
    if statement.lstrip().startswith("with ") and parts:
        statement = "," + statement.lstrip()[len("with"):]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + statement


AIR = f"""code_site, nom_site, type_implantation, polluant, unite_mesure, date_mesure, latitude, longitude,
    {mean('valeur_moyenne')} as valeur_moyenne, valeur_max, valeur_min, nb_mesures, {mean('taux_saisie_moyen')} as taux_saisie_moyen"""
ALERT = f"""code_site, nom_site, polluant, date_mesure, valeur_max_journaliere, {mean('valeur_moyenne')} as valeur_moyenne,
    unite_mesure, seuil_reglementaire, type_seuil, ratio_depassement, latitude, longitude"""
ROAD = f"""arc_id, libelle_arc, date_jour, {mean('debit_moyen')} as debit_moyen, debit_max,
    {mean('taux_occupation_moyen')} as taux_occupation_moyen, nb_heures_bloque, nb_heures_sature, nb_heures_dense,
    nb_heures_fluide, nb_mesures, latitude, longitude"""
PIVOT = ", ".join(f"{mean(c)} as {c}" for c in ("no2_moyen", "pm10_moyen", "pm25_moyen", "o3_moyen"))
CITY = f"""date_jour, {PIVOT}, nb_stations_alerte, {mean('debit_routier_moyen')} as debit_routier_moyen,
    {mean('taux_occupation_moyen')} as taux_occupation_moyen, total_heures_bloque, nb_arcs_surveilles, total_velos,
    nb_compteurs_actifs"""
ZONE_MEANS = ", ".join(f"{mean(c)} as {c}" for c in (
    "no2_moyen", "pm10_moyen", "pm25_moyen", "pollution_indice_moyen", "debit_routier_moyen", "taux_occupation_moyen"))
ZONE_REST = f"total_heures_bloque, total_velos, nb_compteurs_actifs, {mean('ratio_mobilite_verte')} as ratio_mobilite_verte"
ZONE = f"arrondissement_code, nom_arrondissement, date_jour, {ZONE_MEANS}, {ZONE_REST}"
RAW_AIR_TEXT = """date_debut, date_fin, organisme, code_zas, zas, code_site, nom_site, type_implantation, polluant,
    type_influence, discriminant, reglementaire, type_evaluation, procedure_mesure, type_valeur, valeur, valeur_brute,
    unite_mesure, taux_saisie, couverture_temporelle, couverture_donnees, code_qualite, validite"""
COUNTS = {
    "dm_air_quality_daily": "m_air", "dm_alertes_pollution": "m_alerts", "dm_velo_daily": "bikes",
    "dm_trafic_routier_daily": "roads", "dm_smartcity_kpi_daily": "air_pivot", "dm_zone_kpi_daily": "spine",
}
AIR_ORDER = "date_mesure desc, code_site, polluant, nom_site, type_implantation, unite_mesure, latitude, longitude"


def check(name: str, table: str, severity: str, failures: str) -> str:
    return (f"select '{name}' as check_name, '{table}' as table_name, '{severity}' as severity, "
            f"cast(({failures}) as bigint) as failures")


def missing(table: str, source: str, columns: str) -> list[str]:
    return [check(f"not_null:{c}", table, "error", f'select count(*) from {source} where "{c}" is null')
            for c in columns.split()]


def repeated(table: str, source: str, columns: str) -> str:
    keys = columns.split("|")
    present = " and ".join(f"{k} is not null" for k in keys)
    return check(
        f"unique:{columns}", table, "error",
        f"select count(*) from (select 1 from {source} where {present} group by {', '.join(keys)} having count(*) > 1)")


def unexpected(table: str, source: str, column: str, allowed) -> str:
    return check(
        f"accepted_values:{column}", table, "warn",
        f"select count(distinct {column}) from {source} where {column} not in ({values(allowed)})")


def future(table: str, source: str, column: str) -> str:
    return check(f"not_future:{column}", table, "error",
                 f"select count(*) from {source} where {column} > date '2000-06-01'")


def unreadable(table: str, column: str, value: str) -> str:
    return check(f"readable:{column}", table, "warn",
                 f"select count(*) from {table} where trim(coalesce({column}, '')) <> '' and ({value}) is null")


HALF = "try_cast(trim(split_part({0}, ',', {1})) as double)"
LOADED_AIR = "(select * from last_air where code_site is not null) t"
REPORT = " union all ".join([
    *missing("raw_air_quality", "raw_air_quality", "date_debut date_fin organisme code_site polluant _file_name _loaded_at"),
    *missing("raw_coordonnees", "raw_coordonnees", "code_site latitude longitude _file_name _loaded_at"),
    *missing("raw_trafic_velo", "raw_trafic_velo", "compteur_id sum_counts date _file_name _loaded_at"),
    *missing("raw_trafic_routier", "raw_trafic_routier", "iu_ac t_1h _file_name _loaded_at"),
    *missing("raw_stations_velib", "raw_stations_velib",
             "stationcode name coordonnees_geo_lat coordonnees_geo_lon _file_name _loaded_at"),
    *[check(f"not_null:{c}", "raw_arrondissements_paris", "error", "select 0") for c in ("raw_geojson", "_loaded_at")],
    *missing("stg_air_quality", LOADED_AIR, "code_site polluant date_debut _loaded_at"),
    *missing("stg_coordonnees", "coords", "code_site latitude longitude"),
    *missing("stg_trafic_velo", "stg_bike", "compteur_id date_jour"),
    *missing("stg_trafic_routier", "stg_road", "arc_id date_jour"),
    *missing("stg_stations_velib", "stations", "stationcode nom_station"),
    *missing("stg_arrondissements", "diamonds", "arrondissement_code code_insee nom_arrondissement"),
    check("not_null:geometry", "stg_arrondissements", "error", "select count(*) from diamonds where cx is null"),
    *missing("int_air_quality_idf", "air", "code_site polluant date_mesure latitude longitude"),
    *missing("int_velo_daily", "bikes", "compteur_id date_jour total_passages_jour"),
    *missing("int_trafic_daily", "roads", "arc_id date_jour nb_mesures"),
    *missing("int_air_quality_zoned", "air_z", "arrondissement_code date_jour"),
    *missing("int_trafic_zoned", "road_z", "arrondissement_code date_jour"),
    *missing("int_velo_zoned", "bike_z", "arrondissement_code date_jour"),
    repeated("raw_coordonnees", "raw_coordonnees", "code_site"),
    repeated("stg_coordonnees", "coords", "code_site"),
    repeated("stg_stations_velib", "stations", "stationcode"),
    repeated("stg_arrondissements", "diamonds", "arrondissement_code"),
    repeated("stg_arrondissements", "diamonds", "code_insee"),
    repeated("int_velo_daily", "bikes", "compteur_id|date_jour"),
    repeated("int_trafic_daily", "roads", "arc_id|date_jour"),
    unexpected("raw_air_quality", "raw_air_quality", "type_implantation", SITE_SETTINGS),
    unexpected("raw_air_quality", "raw_air_quality", "code_qualite", QUALITY_CODES),
    unexpected("raw_trafic_routier", "raw_trafic_routier", "etat_trafic", TRAFFIC_STATES),
    unexpected("stg_trafic_routier", "stg_road", "etat_trafic", TRAFFIC_STATES),
    unreadable("raw_coordonnees", "latitude", "try_cast(latitude as double)"),
    unreadable("raw_coordonnees", "longitude", "try_cast(longitude as double)"),
    unreadable("raw_trafic_velo", "coordonnees_geographiques",
               HALF.format("coordonnees_geographiques", 1) + " + " + HALF.format("coordonnees_geographiques", 2)),
    unreadable("raw_trafic_routier", "geo_point_2d",
               HALF.format("geo_point_2d", 1) + " + " + HALF.format("geo_point_2d", 2)),
    unreadable("raw_stations_velib", "coordonnees_geo_lat", "try_cast(coordonnees_geo_lat as double)"),
    unreadable("raw_stations_velib", "coordonnees_geo_lon", "try_cast(coordonnees_geo_lon as double)"),
    future("int_air_quality_idf", "air", "date_mesure"),
    future("int_velo_daily", "bikes", "date_jour"),
    future("int_trafic_daily", "roads", "date_jour"),
    check("at_most:" + "+".join(CLASSIFIED_HOURS), "int_trafic_daily", "error",
          f"select count(*) from roads where {CLASSIFIED} > 2"),
])


def reloaded(tables: list[str], raw: str, day: str, first_end: str) -> str:
    """Days whose newest load has come with the second batch, or has come again with it."""
    return " union all ".join(
        f"select '{t}' as table_name, {day} as day from {raw} where {day} is not null group by 2 "
        f"having max(case when _loaded_at >= timestamp '{first_end}' then _loaded_at end) "
        f">= coalesce(max(case when _loaded_at < timestamp '{first_end}' then _loaded_at end), timestamp '1900-01-01')"
        for t in tables)


CTES["stations"] = f"""select stationcode, "name" as nom_station, {WHOLE.format('capacity')} as capacite,
    try_cast(coordonnees_geo_lat as double) as latitude, try_cast(coordonnees_geo_lon as double) as longitude,
    nom_arrondissement_communes, code_insee_commune, _loaded_at from (select *, row_number() over (partition by stationcode
    order by _loaded_at desc nulls first, _file_name desc) as rn from raw_stations_velib where stationcode is not null) t
    where rn = 1"""

STATEMENTS: dict[str, str] = {
    "bronze_csv_scan": f"""select {RAW_AIR_TEXT}, true as has_file, true as has_load_time,
        timestamp '1998-01-31 08:00:00' as run_at from raw_air_quality""",
    "bronze_quarantine": """select case when o_orderkey % 13 = 0 then 'quarantined' else 'loaded' end as outcome,
        case when o_orderkey % 13 = 0 then concat(o_orderkey, ';', o_custkey)
        else concat(o_orderkey, ';', o_custkey, ';', o_orderstatus, ';', o_orderpriority) end as row_text,
        case when o_orderkey % 13 = 0 then 2 else 4 end as fields_present from orders""",
    "bronze_json_scan": """select cast(c_custkey as varchar) as stationcode, c_name as name, cast(c_custkey % 60 as varchar) as capacity,
        concat('Area ', c_custkey % 20) as nom_arrondissement_communes, cast(null as varchar) as code_insee_commune,
        case when c_custkey % 19 <> 0 then c_custkey % 90 + cast(0.25 as double) end as latitude,
        case when c_custkey % 19 <> 0 then c_custkey % 180 + cast(0.5 as double) end as longitude from customer""",
    "bronze_stream_ingest": 'select compteur_id, sum_counts, "date", date_installation from raw_trafic_velo',
    "stream_reload": """with runs as (
            select *, cast(substr("date", 1, 10) as date) as day, 7 as run from raw_trafic_velo union all
            select *, cast(substr("date", 1, 10) as date), 8 from raw_trafic_velo where hour(_loaded_at) = 8),
        newest as (select *, max(run) over (partition by day) as last from runs where "date" is not null)
        select compteur_id, compteur_nom, "name" as nom_site, day as date_jour, cast(sum(n) as bigint) as total_passages_jour,
            count(*) as nb_mesures_horaires, max(n) as pic_horaire, latitude, longitude
        from (select *, """ + WHOLE.format("sum_counts") + """ as n,
            try_cast(split_part(coordonnees_geographiques, ',', 1) as double) as latitude,
            try_cast(split_part(coordonnees_geographiques, ',', 2) as double) as longitude
            from newest where run = last and compteur_id is not null) t
        where n is not null group by compteur_id, compteur_nom, "name", site_id, day, latitude, longitude""",
    "day_slice": """select event_id, ts, user_id, value from events
        where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-11'""",
    "latest_available_day": """select event_id, ts, user_id from events where cast(ts as date) =
        (select max(cast(ts as date)) from events where cast(ts as date) between date '2024-01-30' and date '2024-02-01')""",
    "latest_load_per_day": f"""select cast({PARSE.format('date_debut')} as date) as load_day, max(_loaded_at) as newest_load
        from raw_air_quality group by 1""",
    "stg_air": """select date_debut, date_fin, organisme, code_site, nom_site, polluant, reglementaire, valeur, valeur_brute,
        unite_mesure, taux_saisie, code_qualite, validite, _file_name from stg_air""",
    "stg_coordinates": "select * from coords",
    "stg_bike": "select * from stg_bike",
    "stg_road": "select * from stg_road",
    "stg_stations": "select * from stations",
    "dedup_latest_row": """select user_id, event_id, ts, event_type, value from (select *, row_number() over
        (partition by user_id order by ts desc nulls first, event_id desc) as rn from events) t where rn = 1""",
    "latlon_split": """select c_custkey, case when c_custkey % 23 = 0 then cast(c_custkey % 90 as double)
        else c_custkey % 90 + cast(0.25 as double) end as latitude,
        case when c_custkey % 23 <> 0 then c_custkey % 180 + cast(0.5 as double) end as longitude from customer""",
    "region_filter": """select code_site, polluant, date_debut, valeur from stg_air
        where cast(substr(code_site, 5, 3) as int) < 24""",
    "air_region": """select date_debut, date_fin, code_site, nom_site, type_implantation, polluant, valeur, unite_mesure,
        reglementaire, taux_saisie, latitude, longitude, date_mesure from air""",
    "geojson_flatten": """select c_ar as arrondissement_code, c_arinsee as code_insee, l_aroff as nom_arrondissement,
        surface as surface_m2, cy as centroid_lat, cx as centroid_lon from customer_shapes""",
    "geometry_edges": """select c_ar as arrondissement_code, cx + half * x1 as x1, cy + half * y1 as y1,
        cx + half * x2 as x2, cy + half * y2 as y2 from customer_shapes,
        (values (0, -1, 1, 0), (1, 0, 0, 1), (0, 1, -1, 0), (-1, 0, 0, -1)) e(x1, y1, x2, y2)""",
    "spatial_join": """select c_custkey, arrondissement_code, nom_arrondissement from customer_points join diamonds
        on abs(longitude - cx) + abs(latitude - cy) < 0.5""",
    "zone_air": f"""select arrondissement_code, nom_arrondissement, date_jour, code_site, polluant,
        {mean('valeur_moyenne')} as valeur_moyenne, valeur_max from air_z""",
    "zone_road": f"""select arrondissement_code, nom_arrondissement, date_jour, arc_id, {mean('debit_moyen')} as debit_moyen,
        {mean('taux_occupation_moyen')} as taux_occupation_moyen, nb_heures_bloque from road_z""",
    "zone_bike": "select * from bike_z",
    "ref_zones_export": """select c_ar as arrondissement_code, c_arinsee as code_insee, l_aroff as nom_arrondissement,
        surface as surface_m2, cy as centroid_lat, cx as centroid_lon, 5 as vertices, cx + half as east, cy + half as north
        from customer_shapes order by 1""",
    "air_daily": f"select {AIR} from m_air",
    "pollution_alerts": f"select {ALERT} from m_alerts",
    "bike_daily": "select * from m_bike",
    "road_daily": f"select {ROAD} from roads",
    "pollutant_pivot": f"select date_jour, {PIVOT} from air_pivot",
    "stations_in_alert": """select d.date_jour, a.n as nb_stations_alerte from air_pivot d left join
        (select date_mesure, count(distinct code_site) as n from air where valeur > 100 group by 1) a
        on d.date_jour = a.date_mesure""",
    "road_city_daily": f"""select date_jour, {mean('debit_routier_moyen')} as debit_routier_moyen,
        {mean('taux_occupation_moyen')} as taux_occupation_moyen, total_heures_bloque, nb_arcs_surveilles from road_day""",
    "bike_city_daily": "select * from bike_day",
    "city_kpi_daily": f"select {CITY} from m_city",
    "zone_spine": "select * from spine",
    "zone_kpi_daily": f"select {ZONE} from m_zone",
    "green_ratio": f"""select arrondissement_code, date_jour, total_velos, {mean('debit_routier_moyen')} as debit_routier_moyen,
        {mean('ratio_mobilite_verte')} as ratio_mobilite_verte from m_zone""",
    "incremental_delta": "select * from m_bike where date_jour > date '1998-01-01'",
    "watermark_merge": """select 'dm_air_quality_daily' as dataset, max(date_mesure) as last_date from m_air
        union all select 'dm_velo_daily', max(date_jour) from m_bike
        union all select 'dm_trafic_routier_daily', max(date_jour) from roads
        union all select 'dm_zone_kpi_daily', min(date_jour) from m_bike""",
    "upsert_merge": """select coalesce(s.k, o_orderkey) as o_orderkey, coalesce(s.price, o_totalprice) as price,
        case when s.k is null then 'order' else 'lines' end as origin from orders full join
        (select l_orderkey * 2 as k, max(l_extendedprice) as price from lineitem group by 1) s on o_orderkey = s.k""",
    "upsert_partitions": """select compteur_id, date_jour, total_passages_jour + case when date_jour > date '1998-01-01'
        then 1000 else 0 end as total_passages_jour, pic_horaire from m_bike""",
    "gold_roundtrip": f"select {AIR} from m_air",
    "route_by_path": """select 'dm_velo_daily' as dataset, compteur_id as item, date_jour,
            case when date_jour > date '1998-01-01' then total_passages_jour else total_passages_jour + 1000 end as metric
        from m_bike union all
        select 'dm_zone_kpi_daily', cast(arrondissement_code as varchar), date_jour, total_velos from m_zone""",
    "run_report": " union all ".join([
        *[f"select '{d}' as dataset, count(*) as n, 0 as run_no from {c}" for d, c in COUNTS.items()],
        *[f"select '{d}', 0, 1" for d in COUNTS],
        *[f"select 'ref_arrondissements', count(*), {r} from diamonds" for r in (0, 1)]]),
    "serve_air": f"""select {AIR} from m_air where date_mesure between date '1998-01-05' and date '1998-01-20'
        and polluant = 'NO2' order by {AIR_ORDER} limit 200""",
    "serve_air_site": f"""select {AIR} from m_air where date_mesure >= date '1998-01-10' and code_site = 'FR04003'
        order by {AIR_ORDER} limit 1000""",
    "serve_alerts_page": f"""select {ALERT} from m_alerts where date_mesure <= date '1998-01-25' order by date_mesure desc,
        ratio_depassement desc, code_site, polluant, type_seuil, unite_mesure limit 150 offset 75""",
    "serve_all_alerts": f"""select {ALERT} from m_alerts where polluant = 'NO2' order by date_mesure desc,
        ratio_depassement desc, code_site, polluant, type_seuil, unite_mesure""",
    "serve_bike": """select * from m_bike where date_jour >= date '1997-01-01' and compteur_id = 'c17'
        order by date_jour desc, compteur_id""",
    "serve_road": f"""select {ROAD} from roads where date_jour <= date '1998-06-30' and arc_id = 'arc3'
        order by date_jour desc, arc_id limit 500""",
    "serve_road_daily_avg": f"""select date_jour, {mean('avg(debit_moyen)')} as debit_moyen from roads
        where date_jour >= date '1998-01-01' group by date_jour order by date_jour""",
    "serve_city_kpi": f"select {CITY} from m_city where date_jour <= date '1998-01-20' order by date_jour desc limit 10",
    "serve_zone_kpi": f"""select {ZONE} from m_zone where date_jour >= date '1998-01-01' and arrondissement_code = 14
        order by date_jour desc limit 50""",
    "distinct_values": "select distinct polluant from m_air order by 1",
    "pollutant_trend": f"""select date_mesure, {mean('avg(valeur_moyenne)')} as valeur_moyenne from m_air
        where polluant = 'NO2' group by 1""",
    "top_sites": """select nom_site, max(valeur_max) as valeur_max from m_air where polluant = 'PM10' group by 1
        order by 2 desc, 1 limit 10""",
    "custom_threshold": f"""select date_mesure, code_site, nom_site, unite_mesure, type_implantation, valeur_max,
        {mean('valeur_moyenne')} as valeur_moyenne, {ratio('valeur_max / cast(40 as double)')} as ratio from m_air
        where polluant = 'NO2' and valeur_max > 40""",
    "threshold_summary": f"""select count(*) as depassements, count(distinct code_site) as stations,
        max({ratio('valeur_max_journaliere / cast(60 as double)')}) as ratio_max from m_alerts
        where polluant = 'O3' and valeur_max_journaliere > 60""",
    "map_points": f"""select code_site, date_mesure, unite_mesure, type_implantation,
        {ratio('valeur_max / cast(50 as double)')} as ratio, latitude, longitude from m_air
        where polluant = 'PM10' and valeur_max > 50 and latitude is not null and longitude is not null""",
    "bike_trend": "select date_jour, cast(sum(total_passages_jour) as bigint) as total_passages_jour from m_bike group by 1",
    "latest_city_kpi": f"select {CITY} from m_city order by date_jour desc limit 1",
    "zone_latest_choropleth": f"""select arrondissement_code, nom_arrondissement, centroid_lat, centroid_lon, date_jour,
        {ZONE_MEANS}, {ZONE_REST} from zone_now""",
    "minmax_ramp": """select arrondissement_code, total_velos, coalesce(cast(trunc(40 + 200 * share) as int), 190) as r,
        coalesce(cast(trunc(200 - 160 * share) as int), 190) as g, case when share is null then 190 else 60 end as b,
        case when share is null then 160 else 180 end as a from ramped""",
    "feature_export": """select 'Feature' as kind, 'Polygon' as shape, nom_arrondissement, cast(total_velos as double) as metric,
        coalesce(cast(trunc(40 + 200 * share) as int), 190) as red,
        coalesce(cast(trunc(200 - 160 * share) as int), 190) as green from ramped""",
    "latest_state": "select * from states",
    "latest_state_stream": """select "stationId", "timestamp", num_docks_available, nom_arrondissement_communes from
        (select *, row_number() over (partition by "stationId" order by "timestamp" desc, num_bikes_available desc nulls last,
        num_docks_available desc) as rn from station_states
        where coalesce("stationId", '') <> '' and cast(position as bigint) % 53 <> 0) t where rn = 1""",
    "serve_velib": """select * from states where nom_arrondissement_communes = 'zone 7' order by "stationId" limit 1500""",
    "velib_lookup": """select * from states where "stationId" = '8'""",
    "velib_totals": """select count(*) as stations, cast(sum(coalesce(num_bikes_available, 0)) as bigint) as bikes,
        cast(sum(coalesce(num_docks_available, 0)) as bigint) as docks from states""",
    "velib_map": """select "stationId", latitude, longitude, num_bikes_available from states
        where latitude is not null and longitude is not null""",
    "dq_not_null": " union all ".join(
        f"select '{c}' as column_name, count(*) as failures from raw_air_quality where {c} is null"
        for c in ("code_site", "polluant", "type_implantation", "reglementaire", "code_qualite")),
    "dq_unique_key": """select compteur_id, "date", count(*) as n_records from raw_trafic_velo
        where compteur_id is not null group by 1, 2 having count(*) > 1""",
    "dq_accepted_values": f"""select type_implantation as value_field, count(*) as n_records from raw_air_quality
        where type_implantation not in ({values(SITE_SETTINGS)}) group by 1""",
    "dq_future_dates": """select 'int_air_quality_idf' as source_model, date_mesure as bad_date from air where date_mesure > date '2000-06-01'
        union all select 'int_velo_daily', date_jour from bikes where date_jour > date '2000-06-01'
        union all select 'int_trafic_daily', date_jour from roads where date_jour > date '2000-06-01'""",
    "dq_hours_within_day": f"""select arc_id, date_jour, {CLASSIFIED} as total_heures_classees from roads where {CLASSIFIED} > 2""",
    "dq_report": REPORT,
    "incremental_days": " union all ".join([
        reloaded(["stg_air_quality", "int_air_quality_idf"], "raw_air_quality", f"cast({PARSE.format('date_debut')} as date)",
                 "1998-01-25 08:30:00"),
        reloaded(["stg_trafic_velo", "int_velo_zoned"], "raw_trafic_velo", 'cast(substr("date", 1, 10) as date)',
                 "1998-01-25 07:30:00"),
        reloaded(["int_trafic_daily"], "raw_trafic_routier", "cast(substr(t_1h, 1, 10) as date)", "1998-01-25 07:30:00")]),
}
STATEMENTS["latest_state_store"] = STATEMENTS["latest_state_stream"]
STATEMENTS["serve_alert_pages"] = STATEMENTS["serve_all_alerts"]
STATEMENTS["incremental_silver"] = STATEMENTS["zone_kpi_daily"]
STATEMENTS["spatial_join_shuffled"] = STATEMENTS["spatial_join"]

ORACLES: dict[str, str] = {name: with_ctes(statement) for name, statement in STATEMENTS.items()}
