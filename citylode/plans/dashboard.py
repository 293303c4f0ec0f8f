"""Dashboard roll-ups over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylode.functions.numeric import fixed, times_over
from citylode.functions.palette import ramp
from citylode.operators.predicates import MONTH, month_of


def pollutants(air: DataFrame) -> DataFrame:
    """Pollutants present, sorted."""
    return air.select("polluant").dropna().distinct().orderBy("polluant")


def pollutant_trend(air: DataFrame, pollutant: str) -> DataFrame:
    """Mean of the sites' daily means, per day."""
    return air.filter(F.col("polluant") == pollutant).groupBy("date_mesure").agg(
        F.avg("valeur_moyenne").alias("valeur_moyenne")).orderBy("date_mesure")


def most_exposed_sites(air: DataFrame, pollutant: str, count: int = 10) -> DataFrame:
    """Sites with the highest daily maximum."""
    return air.filter(F.col("polluant") == pollutant).groupBy("nom_site").agg(
        F.max("valeur_max").alias("valeur_max")
    ).orderBy(F.col("valeur_max").desc(), "nom_site").limit(count)


def exceedances(peaks: DataFrame, pollutant: str, threshold: float, value: str = "valeur_max") -> DataFrame:
    """Rows of one pollutant strictly above a threshold of the caller, with their ratio to it.

    Takes the air mart, so that no threshold is too low to be answered; on the alert table pass
    ``valeur_max_journaliere``.
    """
    chosen = peaks.filter((F.col("polluant") == pollutant) & (F.col(value) > F.lit(float(threshold))))
    return chosen.withColumn("ratio", times_over(F.col(value), F.lit(float(threshold))))


def ranked(rows: DataFrame, column: str, *ties: str) -> DataFrame:
    """Display order: greatest first, missing last."""
    return rows.orderBy(F.col(column).desc_nulls_last(), *ties)


def exceedance_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("depassements"), F.count_distinct("code_site").alias("stations"),
        F.max("ratio").alias("ratio_max"))


def with_coordinates(rows: DataFrame) -> DataFrame:
    """Rows that can be put on a map."""
    return rows.dropna(subset=["latitude", "longitude"])


def bike_trend(bikes: DataFrame) -> DataFrame:
    return bikes.groupBy("date_jour").agg(
        F.sum("total_passages_jour").alias("total_passages_jour")).orderBy("date_jour")


def latest_city_day(kpi: DataFrame) -> DataFrame:
    """The newest day's indicators."""
    return kpi.drop(MONTH).orderBy(F.col("date_jour").desc()).limit(1)


def fleet_totals(states: DataFrame) -> DataFrame:
    """Stations, bikes and free docks over the current states."""
    return states.agg(
        F.count(F.lit(1)).alias("stations"),
        F.coalesce(F.sum(F.coalesce("num_bikes_available", F.lit(0))), F.lit(0)).alias("bikes"),
        F.coalesce(F.sum(F.coalesce("num_docks_available", F.lit(0))), F.lit(0)).alias("docks"))


def zone_snapshot(reference: DataFrame, kpi: DataFrame) -> DataFrame:
    """Every zone with its indicators of the newest day of the table, if it has any.

    The newest day is a scalar subquery; on a stored table it prunes the months as well.
    """
    newest = kpi.agg(F.max("date_jour").alias("newest")).scalar()
    current = kpi.filter(F.col("date_jour") == newest)
    if MONTH in kpi.columns:
        current = current.filter(F.col(MONTH) == month_of(newest))
    current = current.drop("nom_arrondissement", MONTH)
    return reference.join(current, "arrondissement_code", "left")


def zone_colours(snapshot: DataFrame, metric: str) -> DataFrame:
    """Zones with a colour placing the metric between its least and greatest value.

    Both bounds are one scalar subquery, kept as a column so that it is planned once.
    """
    value = F.col(metric).cast("double")
    bounds = snapshot.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("bounds")).scalar()
    ramped = ramp(value, F.col("bounds_.low"), F.col("bounds_.high"))
    return snapshot.withColumn("bounds_", bounds).withColumn("fill_color", ramped).drop("bounds_")


def zone_features(coloured: DataFrame, metric: str) -> DataFrame:
    """One GeoJSON feature per zone as text; zones without geometry are left out.

    Writing the result as text gives newline-delimited features, without gathering them anywhere.
    """
    colour = F.col("fill_color")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.parse_json("geometry").alias("geometry"),
        F.struct(
            F.col("nom_arrondissement"),
            fixed(F.col(metric), 2).alias("value"),
            F.array(colour["r"], colour["g"], colour["b"], colour["a"]).alias("fill_color"),
        ).alias("properties"))
    return coloured.filter(F.coalesce(F.col("geometry"), F.lit("")) != "").select(
        "arrondissement_code", F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))
