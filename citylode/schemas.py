"""Table schemas of the three layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, LongType, StringType, StructField, StructType,
)


def text_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Column names of the raw files, in file order. Every column is text.
AIR_COLUMNS = [
    "date_debut", "date_fin", "organisme", "code_zas", "zas", "code_site", "nom_site",
    "type_implantation", "polluant", "type_influence", "discriminant", "reglementaire",
    "type_evaluation", "procedure_mesure", "type_valeur", "valeur", "valeur_brute",
    "unite_mesure", "taux_saisie", "couverture_temporelle", "couverture_donnees",
    "code_qualite", "validite",
]
SITE_COLUMNS = ["code_site", "latitude", "longitude"]
BIKE_COLUMNS = [
    "compteur_id", "compteur_nom", "site_id", "name", "sum_counts", "date",
    "date_installation", "lien_photo_site", "coordonnees_geographiques", "counter", "photos",
    "test_lien_vers_photo", "id_photo_1", "url_sites", "type_image", "mois_annee_comptage",
]
ROAD_COLUMNS = [
    "iu_ac", "libelle", "t_1h", "k", "q", "etat_trafic", "iu_nd_amont", "libelle_nd_amont",
    "iu_nd_aval", "libelle_nd_aval", "etat_barre", "date_debut", "date_fin", "geo_point_2d",
    "geo_shape",
]
STATION_COLUMNS = [
    "stationcode", "name", "capacity", "coordonnees_geo_lat", "coordonnees_geo_lon",
    "nom_arrondissement_communes", "code_insee_commune",
]

# Station reference file: nested coordinates, scalars read as text.
STATION_RECORD = StructType([
    StructField("stationcode", StringType()),
    StructField("name", StringType()),
    StructField("capacity", StringType()),
    StructField("coordonnees_geo", text_schema(["lat", "lon"])),
    StructField("nom_arrondissement_communes", StringType()),
    StructField("code_insee_commune", StringType()),
])

# Live feed record as polled, and the message it is mapped to.
POLLED_STATION = StructType([
    StructField("stationcode", StringType()),
    StructField("numbikesavailable", LongType()),
    StructField("numdocksavailable", LongType()),
    StructField("mechanical", LongType()),
    StructField("ebike", LongType()),
    StructField("nom_arrondissement_communes", StringType()),
    StructField("coordonnees_geo", StructType([
        StructField("lat", DoubleType()), StructField("lon", DoubleType())])),
])
STATION_STATE = StructType([
    StructField("stationId", StringType()),
    StructField("timestamp", StringType()),
    StructField("num_bikes_available", LongType()),
    StructField("num_docks_available", LongType()),
    StructField("mechanical", LongType()),
    StructField("ebike", LongType()),
    StructField("nom_arrondissement_communes", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
])

# SQL types of the served tables. Rounding to scale happens here, never in the marts.
SERVED_TYPES = {
    "dm_air_quality_daily": {
        "code_site": "string", "nom_site": "string", "type_implantation": "string",
        "polluant": "string", "unite_mesure": "string", "date_mesure": "date",
        "latitude": "decimal(10,6)", "longitude": "decimal(10,6)",
        "valeur_moyenne": "decimal(10,4)", "valeur_max": "decimal(10,4)",
        "valeur_min": "decimal(10,4)", "nb_mesures": "int",
        "taux_saisie_moyen": "decimal(5,2)", "updated_at": "timestamp_ntz",
    },
    "dm_alertes_pollution": {
        "code_site": "string", "nom_site": "string", "polluant": "string",
        "date_mesure": "date", "valeur_max_journaliere": "decimal(10,4)",
        "valeur_moyenne": "decimal(10,4)", "unite_mesure": "string",
        "seuil_reglementaire": "decimal(10,4)", "type_seuil": "string",
        "ratio_depassement": "decimal(6,2)", "latitude": "decimal(10,6)",
        "longitude": "decimal(10,6)", "updated_at": "timestamp_ntz",
    },
    "dm_velo_daily": {
        "compteur_id": "string", "compteur_nom": "string", "nom_site": "string",
        "date_jour": "date", "total_passages_jour": "bigint", "nb_mesures_horaires": "int",
        "pic_horaire": "bigint", "latitude": "decimal(10,6)", "longitude": "decimal(10,6)",
        "updated_at": "timestamp_ntz",
    },
    "dm_trafic_routier_daily": {
        "arc_id": "string", "libelle_arc": "string", "date_jour": "date",
        "debit_moyen": "decimal(10,2)", "debit_max": "decimal(10,2)",
        "taux_occupation_moyen": "decimal(6,2)", "nb_heures_bloque": "int",
        "nb_heures_sature": "int", "nb_heures_dense": "int", "nb_heures_fluide": "int",
        "nb_mesures": "int", "latitude": "decimal(10,6)", "longitude": "decimal(10,6)",
        "updated_at": "timestamp_ntz",
    },
    "dm_smartcity_kpi_daily": {
        "date_jour": "date", "no2_moyen": "decimal(10,4)", "pm10_moyen": "decimal(10,4)",
        "pm25_moyen": "decimal(10,4)", "o3_moyen": "decimal(10,4)",
        "nb_stations_alerte": "int", "debit_routier_moyen": "decimal(10,2)",
        "taux_occupation_moyen": "decimal(6,2)", "total_heures_bloque": "bigint",
        "nb_arcs_surveilles": "int", "total_velos": "bigint", "nb_compteurs_actifs": "int",
        "updated_at": "timestamp_ntz",
    },
    "dm_zone_kpi_daily": {
        "arrondissement_code": "int", "nom_arrondissement": "string", "date_jour": "date",
        "no2_moyen": "decimal(10,4)", "pm10_moyen": "decimal(10,4)",
        "pm25_moyen": "decimal(10,4)", "pollution_indice_moyen": "decimal(10,4)",
        "debit_routier_moyen": "decimal(10,2)", "taux_occupation_moyen": "decimal(6,2)",
        "total_heures_bloque": "bigint", "total_velos": "bigint",
        "nb_compteurs_actifs": "int", "ratio_mobilite_verte": "decimal(6,4)",
        "updated_at": "timestamp_ntz",
    },
    "ref_arrondissements": {
        "arrondissement_code": "int", "code_insee": "string", "nom_arrondissement": "string",
        "surface_m2": "decimal(14,2)", "centroid_lat": "decimal(10,6)",
        "centroid_lon": "decimal(10,6)", "geometry": "string",
    },
}


def as_served(df: DataFrame, dataset: str) -> DataFrame:
    """Cast a mart to the column types of its served table."""
    types = SERVED_TYPES[dataset]
    return df.select([F.col(c).cast(types[c]).alias(c) for c in types if c in df.columns])
