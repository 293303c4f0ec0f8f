"""Parameterised read queries over the served tables.

Without a limit all rows come back. Every ordering ends with the table's key, so a limited result is the same
on every run. An ordered limit is planned as a top-k: each task keeps ``limit`` rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylode.operators.keyset import By, page
from citylode.operators.predicates import MONTH, all_of, equals, in_days

MAX_LIMIT = 1000
MAX_STATIONS = 1500
Day = dt.date | None


def limited(df: DataFrame, limit: int | None, top: int = MAX_LIMIT) -> DataFrame:
    """The first rows; all of them without a limit."""
    if limit is None:
        return df
    if not 1 <= limit <= top:
        raise ValueError(f"limit must be between 1 and {top}")
    return df.limit(limit)


def newest(
    df: DataFrame, date_column: str, key: list[str], start: Day, end: Day, limit: int | None, *where: Column | None,
) -> DataFrame:
    chosen = in_days(df, date_column, start, end).filter(all_of(*where)).drop(MONTH)
    return limited(chosen.orderBy(F.col(date_column).desc(), *key), limit)


def city_indicators(kpi: DataFrame, start: Day = None, end: Day = None, limit: int | None = None) -> DataFrame:
    return newest(kpi, "date_jour", [], start, end, limit)


def air_quality(
    air: DataFrame, start: Day = None, end: Day = None, pollutant: str | None = None,
    site: str | None = None, limit: int | None = None,
) -> DataFrame:
    return newest(
        air, "date_mesure", ["code_site", "polluant", *order_rest(air)], start, end, limit,
        equals("polluant", pollutant), equals("code_site", site))


def order_rest(df: DataFrame) -> list[str]:
    """Descriptive grain columns that settle rows sharing a key."""
    return [c for c in ("nom_site", "type_implantation", "unite_mesure", "compteur_nom", "libelle_arc",
                        "latitude", "longitude") if c in df.columns]


def alerts(
    table: DataFrame, start: Day = None, end: Day = None, pollutant: str | None = None,
    limit: int | None = None, offset: int = 0,
) -> DataFrame:
    """A page of alerts: newest first, then by how far the threshold is exceeded."""
    if offset < 0:
        raise ValueError("offset must not be negative")
    chosen = in_days(table, "date_mesure", start, end).filter(all_of(equals("polluant", pollutant))).drop(MONTH)
    return limited(ranked_alerts(chosen).offset(offset), limit)


ALERT_ORDER = [
    By("date_mesure", descending=True), By("ratio_depassement", descending=True), By("code_site"), By("polluant"),
    By("type_seuil"), By("unite_mesure"), By("nom_site"), By("latitude"), By("longitude")]


def ranked_alerts(table: DataFrame) -> DataFrame:
    return table.orderBy(*[by.ordering() for by in ALERT_ORDER])


def alerts_after(
    table: DataFrame, last: dict | None = None, start: Day = None, end: Day = None, pollutant: str | None = None,
    limit: int = MAX_LIMIT,
) -> DataFrame:
    """The page of alerts that follows a row, the last one of the page before; the first page without one.

    Unlike an offset it costs the same on every page, months that lie wholly before the row are not read, and
    rows added meanwhile neither repeat nor hide any.
    """
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if last is not None and last["date_mesure"] is not None:
        end = last["date_mesure"] if end is None else min(end, last["date_mesure"])
    chosen = in_days(table, "date_mesure", start, end).filter(all_of(equals("polluant", pollutant))).drop(MONTH)
    return page(chosen, ALERT_ORDER, limit, last)


def all_alerts(table: DataFrame, start: Day = None, end: Day = None, pollutant: str | None = None) -> DataFrame:
    """What a client gets by paging to the end, in one query."""
    chosen = in_days(table, "date_mesure", start, end).filter(all_of(equals("polluant", pollutant))).drop(MONTH)
    return ranked_alerts(chosen)


def bike_days(
    bikes: DataFrame, start: Day = None, end: Day = None, counter: str | None = None, limit: int | None = None,
) -> DataFrame:
    return newest(
        bikes, "date_jour", ["compteur_id", *order_rest(bikes)], start, end, limit,
        equals("compteur_id", counter))


def road_days(
    roads: DataFrame, start: Day = None, end: Day = None, arc: str | None = None, limit: int | None = None,
) -> DataFrame:
    return newest(
        roads, "date_jour", ["arc_id", *order_rest(roads)], start, end, limit,
        equals("arc_id", arc))


def road_daily_average(roads: DataFrame, start: Day = None, end: Day = None, limit: int | None = None) -> DataFrame:
    """Average flow over all arcs per day, oldest first."""
    return limited(in_days(roads, "date_jour", start, end).groupBy("date_jour").agg(
        F.avg("debit_moyen").alias("debit_moyen")).orderBy("date_jour"), limit)


def zone_indicators(
    kpi: DataFrame, start: Day = None, end: Day = None, zone: int | None = None, limit: int | None = None,
) -> DataFrame:
    return newest(
        kpi, "date_jour", ["arrondissement_code"], start, end, limit,
        equals("arrondissement_code", zone))


def zone_list(reference: DataFrame) -> DataFrame:
    return reference.orderBy("arrondissement_code")


def stations(states: DataFrame, area: str | None = None, limit: int | None = None) -> DataFrame:
    """Current station states, optionally of one area."""
    return limited(states.filter(all_of(equals("nom_arrondissement_communes", area))).orderBy(
        "stationId"), limit, MAX_STATIONS)


def station(states: DataFrame, station_id: str) -> DataFrame:
    """One station's state; no row when it is unknown."""
    return states.filter(F.col("stationId") == station_id)
