"""Typed, deduplicated and zoned tables, each a lazy function of its inputs.

Applied to raw tables they compose into one plan, so a date predicate on a mart reaches the raw scan.
``materialise`` writes one as a table where many consumers share it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.functions import casts
from citylode.functions.numeric import hours_in_state
from citylode.operators.dedup import keep_last_load, keep_latest_row, newest_first
from citylode.operators.lookup import lookup
from citylode.operators.predicates import MONTH, with_month
from citylode.operators.spatial import ZoneIndex, spatial_join
from citylode.reference_values import CLASSIFIED_HOURS, REGION_SITES

ZONE = ["arrondissement_code", "nom_arrondissement"]


# ---------------------------------------------------------------- air quality

def air_day(strict: bool = True) -> Column:
    """The day of a raw measure."""
    return casts.stamp(F.col("date_debut"), strict).cast("date")


def bike_day() -> Column:
    """The day of a raw bicycle count."""
    return casts.iso_day(F.col("date"))


def road_day() -> Column:
    """The day of a raw road measure."""
    return casts.iso_day(F.col("t_1h"))


def air_measures(raw: DataFrame, strict: bool = True, newest: DataFrame | None = None) -> DataFrame:
    """Hourly measures of the last load of each day, typed.

    Which load is the last may be given by ``newest``, here and in the other tables, for rows that are only
    some of those of their days.
    """
    begun = raw.withColumn("date_debut", casts.stamp(F.col("date_debut"), strict))
    latest = keep_last_load(begun, F.col("date_debut").cast("date"), newest=newest).filter(
        F.col("code_site").isNotNull())
    return latest.withColumns({
        "date_fin": casts.stamp(F.col("date_fin"), strict),
        "reglementaire": casts.is_yes(F.col("reglementaire")),
        **{c: casts.number(F.col(c)) for c in ("valeur", "valeur_brute", "taux_saisie", "validite")},
    })


def site_coordinates(raw: DataFrame) -> DataFrame:
    """Coordinates of the measuring sites."""
    return raw.filter(F.col("code_site").isNotNull()).select(
        "code_site", casts.number(F.col("latitude")).alias("latitude"),
        casts.number(F.col("longitude")).alias("longitude"), "_loaded_at")


def in_region(measures: DataFrame, sites: Sequence[str] = REGION_SITES) -> DataFrame:
    """Measures of the listed sites."""
    return measures.filter(F.col("code_site").isin(list(sites)))


def air_region(
    measures: DataFrame, coordinates: DataFrame, sites: Sequence[str] = REGION_SITES,
) -> DataFrame:
    """Measures of the region's sites with their coordinates and day."""
    local = in_region(measures, sites).select(
        "date_debut", "date_fin", "code_site", "nom_site", "type_implantation", "polluant",
        "valeur", "valeur_brute", "unite_mesure", "reglementaire", "type_valeur", "taux_saisie",
        "code_qualite", "validite", F.col("date_debut").cast("date").alias("date_mesure"))
    places = in_region(coordinates, sites).select("code_site", "latitude", "longitude")
    return lookup(local, places, ["code_site"])


# ------------------------------------------------------------------- mobility

def bike_counts(raw: DataFrame, newest: DataFrame | None = None) -> DataFrame:
    """Hourly bicycle counts of the last load of each day, typed."""
    day = bike_day()
    latest = keep_last_load(raw, day, newest=newest).filter(
        F.col("compteur_id").isNotNull())
    place = F.col("coordonnees_geographiques")
    return latest.select(
        "compteur_id", "compteur_nom", "site_id", F.col("name").alias("nom_site"),
        casts.whole_number(F.col("sum_counts")).alias("nb_passages"),
        casts.iso_stamp(F.col("date")).alias("date_comptage"), day.alias("date_jour"),
        casts.day_in_format(F.col("date_installation")).alias("date_installation"),
        casts.latitude(place).alias("latitude"), casts.longitude(place).alias("longitude"),
        "mois_annee_comptage", "_loaded_at", "_file_name")


def road_counts(raw: DataFrame, newest: DataFrame | None = None) -> DataFrame:
    """Hourly road measures of the last load of each day, typed."""
    day = road_day()
    latest = keep_last_load(raw, day, newest=newest).filter(
        F.col("iu_ac").isNotNull())
    place = F.col("geo_point_2d")
    return latest.select(
        F.col("iu_ac").alias("arc_id"), F.col("libelle").alias("libelle_arc"),
        casts.iso_stamp(F.col("t_1h")).alias("comptage_datetime"), day.alias("date_jour"),
        casts.number(F.col("q")).alias("debit_horaire"),
        casts.number(F.col("k")).alias("taux_occupation"), "etat_trafic",
        F.col("iu_nd_amont").alias("noeud_amont_id"), "libelle_nd_amont",
        F.col("iu_nd_aval").alias("noeud_aval_id"), "libelle_nd_aval", "etat_barre",
        casts.latitude(place).alias("latitude"), casts.longitude(place).alias("longitude"),
        "_loaded_at", "_file_name")


def bike_stations(raw: DataFrame, tie_break: Sequence[str] = ("_file_name", "name", "capacity")) -> DataFrame:
    """The last loaded record of each bike-share station; equal load times are settled by values."""
    latest = keep_latest_row(
        raw.filter(F.col("stationcode").isNotNull()), ["stationcode"],
        [newest_first("_loaded_at"), *[F.col(c).desc_nulls_last() for c in tie_break]])
    return latest.select(
        "stationcode", F.col("name").alias("nom_station"),
        casts.whole_number(F.col("capacity")).alias("capacite"),
        casts.number(F.col("coordonnees_geo_lat")).alias("latitude"),
        casts.number(F.col("coordonnees_geo_lon")).alias("longitude"),
        "nom_arrondissement_communes", "code_insee_commune", "_loaded_at")


def bike_daily(counts: DataFrame) -> DataFrame:
    """Passages per counter and day. Descriptive columns are part of the grain."""
    return counts.filter(F.col("nb_passages").isNotNull()).groupBy(
        "compteur_id", "compteur_nom", "site_id", "nom_site", "date_jour", "latitude", "longitude",
    ).agg(
        F.sum("nb_passages").alias("total_passages_jour"),
        F.count(F.lit(1)).alias("nb_mesures_horaires"),
        F.max("nb_passages").alias("pic_horaire"))


def road_daily(counts: DataFrame) -> DataFrame:
    """Flow, occupancy and hours per traffic state, per road arc and day."""
    return counts.filter(F.col("comptage_datetime").isNotNull()).groupBy(
        "arc_id", "libelle_arc", "date_jour", "latitude", "longitude",
    ).agg(
        F.avg("debit_horaire").alias("debit_moyen"), F.max("debit_horaire").alias("debit_max"),
        F.avg("taux_occupation").alias("taux_occupation_moyen"),
        *[hours_in_state(F.col("etat_trafic"), s).alias(c) for c, s in CLASSIFIED_HOURS.items()],
        F.count(F.lit(1)).alias("nb_mesures"))


# ---------------------------------------------------------------------- zones

def zones(documents: DataFrame) -> DataFrame:
    """One row per feature of the GeoJSON documents; the geometry stays GeoJSON text."""
    features = documents.filter(F.col("raw_geojson").isNotNull()).select(
        F.variant_get("raw_geojson", "$.features", "variant").alias("features"))
    feature = features.lateralJoin(
        features.sparkSession.tvf.variant_explode(F.col("features").outer()))

    def at(path: str, kind: str) -> Column:
        return F.try_variant_get("value", path, kind)

    return feature.select(
        at("$.properties.c_ar", "int").alias("arrondissement_code"),
        at("$.properties.c_arinsee", "string").alias("code_insee"),
        at("$.properties.l_aroff", "string").alias("nom_arrondissement"),
        at("$.properties.surface", "double").alias("surface_m2"),
        at("$.properties.geom_x_y.lat", "double").alias("centroid_lat"),
        at("$.properties.geom_x_y.lon", "double").alias("centroid_lon"),
        F.to_json(at("$.geometry", "variant")).alias("geometry"))


def air_zoned(measures: DataFrame, zone_index: ZoneIndex) -> DataFrame:
    """Daily average and maximum per zone, site and pollutant.

    Hourly rows are first reduced to sums per site, day and pollutant, and only those are placed into
    zones: a zone depends on the coordinates alone, so the order does not matter to the result.
    """
    reduced = measures.filter(F.col("valeur").isNotNull()).groupBy(
        "code_site", "polluant", "date_mesure", "latitude", "longitude",
    ).agg(F.sum("valeur").alias("total"), F.count(F.lit(1)).alias("n"), F.max("valeur").alias("top"))
    return spatial_join(reduced, zone_index).groupBy(
        *ZONE, F.col("date_mesure").alias("date_jour"), "code_site", "polluant",
    ).agg(
        (F.sum("total") / F.sum("n")).alias("valeur_moyenne"), F.max("top").alias("valeur_max"))


def road_zoned(daily: DataFrame, zone_index: ZoneIndex) -> DataFrame:
    """Road days placed into zones."""
    return spatial_join(daily, zone_index).select(
        *ZONE, "date_jour", "arc_id", "debit_moyen", "taux_occupation_moyen", "nb_heures_bloque")


def bike_zoned(daily: DataFrame, zone_index: ZoneIndex) -> DataFrame:
    """Bicycle days placed into zones."""
    return spatial_join(daily, zone_index).select(
        *ZONE, "date_jour", "compteur_id", "total_passages_jour")


def materialise(
    spark: SparkSession, df: DataFrame, path: str, date_column: str | None = None,
) -> DataFrame:
    """Full refresh of a table, partitioned by month where it has a date; returns it as read back."""
    if date_column is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df = with_month(df, date_column)
        df.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
