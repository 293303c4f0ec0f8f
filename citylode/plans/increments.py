"""Silver tables brought up to date by the days that new loads have changed.

Every table keeps, beside its rows and published with them, one row for each of its days: the newest load, and
the version in which the day last changed. A table derived from another notes the version it was made from, so
the days it must make anew are those that have changed since. A run that is lost half way leaves each table in
its last whole version, and the next one goes on from there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.operators.dedup import in_calendar
from citylode.operators.lookup import is_small
from citylode.operators.predicates import MONTH, month_of
from citylode.operators.spatial import index_zones
from citylode.operators.storage import remove
from citylode.operators.versions import VersionedTable
from citylode.plans import silver
from citylode.plans.nightly import Check, Raw, raw_tables, side_by_side, silver_table
from citylode.reference_values import REGION_SITES
from citylode.session import scratch_path

BATCH = "batch"  # the load batch of a raw row, a number that only grows
DAYS = "days"
MAX_DAYS = 4_000_000  # every day of the years 1 to 9999


@dataclass(frozen=True)
class Measured:
    """A raw table that grows by loads of days, and the typed table made of it."""
    raw: str
    staged: str
    raw_day: Callable[[], Column]
    typed: Callable[..., DataFrame]
    day: str


MEASURED = [
    Measured("raw_air_quality", "stg_air_quality", silver.air_day, silver.air_measures, "date_debut"),
    Measured("raw_trafic_velo", "stg_trafic_velo", silver.bike_day, silver.bike_counts, "date_jour"),
    Measured("raw_trafic_routier", "stg_trafic_routier", silver.road_day, silver.road_counts, "date_jour"),
]


@dataclass
class Update:
    """The rows of some days of a table, staged, and what is needed to publish them."""
    table: VersionedTable
    rows: DataFrame
    replaced: DataFrame | None  # the days whose earlier rows go; None for the whole table
    changed: DataFrame  # the days that change
    day: str
    notes: dict

    def publish(self) -> DataFrame:
        """Replace the days in the months they lie in; the other months keep their folders."""
        version = self.table.next_version()
        known = self.table.side(DAYS)
        marked = self.changed.withColumn("changed_in", F.lit(version).cast("long"))
        if self.replaced is None or known is None:
            return self.table.commit(self.rows, notes=self.notes, sides={DAYS: marked})
        sides = {DAYS: known.join(self.changed.select("day"), "day", "left_anti").unionByName(marked)}
        months = [r[0] for r in self.changed.select(month_of(F.col("day"))).distinct().collect()]
        if not months:
            self.table.annotate(self.notes)
            return self.table.read()
        kept = not_on(self.table.read(months), self.replaced, F.col(self.day).cast("date"))
        return self.table.commit(kept.drop(MONTH).unionByName(self.rows), months, self.notes, sides)


class Staging:
    """Tables in scratch folders that go with the run: changed days, and rows that are checked before they are
    published. Rows that nothing checks are not written twice."""

    def __init__(self, spark: SparkSession, checked: bool):
        self.spark, self.checked, self.paths = spark, checked, []

    def rows(self, df: DataFrame, name: str) -> DataFrame:
        return self.put(df, name) if self.checked else df

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"increment-{name}")
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            remove(self.spark, path)


def days_side(days: DataFrame) -> DataFrame:
    """A table of days, broadcast where a calendar's worth at most; dates beyond it can be more."""
    return F.broadcast(days) if is_small(days, MAX_DAYS) else days


def on_days(rows: DataFrame, days: DataFrame, day: Column) -> DataFrame:
    return rows.join(days_side(days.select(F.col("day").alias("day_"))), day == F.col("day_"), "left_semi")


def not_on(rows: DataFrame, days: DataFrame, day: Column) -> DataFrame:
    return rows.join(days_side(days.select(F.col("day").alias("day_"))), day == F.col("day_"), "left_anti")


def fingerprint(df: DataFrame) -> str:
    """Tells whether a small table has changed; the order of its rows does not matter."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return "|".join(str(x) for x in df.agg(
        F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())


def new_rows(table: VersionedTable, raw: DataFrame) -> DataFrame:
    """Raw rows of the batches that a table has not taken yet, with their batch."""
    return raw.filter(F.col(BATCH) > int(table.manifest().notes.get(BATCH, 0)))


def stage_measured(spark: SparkSession, staging: Staging, source: Measured, raw: DataFrame, root: str) -> Update | None:
    """What new loads change in a typed table.

    A day of a newer load replaces all rows of that day, one of the same load adds to them, and one of an
    older load changes nothing. Days that lie outside the calendar are never replaced: rows are added.
    """
    table = silver_table(spark, root, source.staged)
    new = new_rows(table, raw)
    # One pass tells the last batch and the loads; rows without a day have a batch as well.
    found = staging.put(new.groupBy(source.raw_day().alias("day")).agg(
        F.max("_loaded_at").alias("newest_load"), F.max(BATCH).alias(BATCH)), f"{source.staged}-loads")
    last = found.agg(F.max(BATCH)).first()[0]
    if table.version() and last is None:
        return None
    known = table.side(DAYS)
    loads = found.drop(BATCH).filter("day is not null and newest_load is not null")
    before = F.col("known_load")
    if known is None:
        loads = loads.withColumn("known_load", F.lit(None).cast("timestamp_ntz"))
    else:
        loads = loads.join(known.select("day", F.col("newest_load").alias("known_load")), "day", "left")
    usual = in_calendar(F.col("day"))
    changed = staging.put(loads.filter(~usual | before.isNull() | (F.col("newest_load") >= before)).select(
        "day", "newest_load", (usual & (before.isNull() | (F.col("newest_load") > before))).alias("replaces")), source.staged)
    newest = changed.filter(in_calendar(F.col("day"))).select(F.col("day").alias("load_day"), "newest_load")
    rows = staging.rows(source.typed(new.drop(BATCH), newest=newest), source.staged)
    return Update(table, rows, changed.filter("replaces").select("day"), changed.select("day", "newest_load"),
                  source.day, {BATCH: int(last or 0)})


def stage_derived(
    staging: Staging, table: VersionedTable, source: VersionedTable, source_day: str, day: str,
    build: Callable[[DataFrame], DataFrame], depends_on: str = "",
) -> Update | None:
    """The days of a table that its source has changed since; all, if what it also depends on has changed."""
    made_from, of = table.manifest(), source.manifest()
    everything = not made_from.version or made_from.notes.get("depends_on") != depends_on
    since = -1 if everything else int(made_from.notes.get("source", -1))
    if since == of.version:
        return None
    changed = staging.put(source.side(DAYS).filter(F.col("changed_in") > since).select("day"), "changed")
    months = [r[0] for r in changed.select(month_of(F.col("day"))).distinct().collect()]
    rows = source.read() if everything else on_days(source.read(months), changed, F.col(source_day).cast("date"))
    return Update(table, staging.rows(build(rows), "rows"), None if everything else changed, changed, day,
                  {"source": of.version, "depends_on": depends_on})


def refresh_silver(
    spark: SparkSession, raw: Raw, root: str, sites=REGION_SITES, check: Check | None = None,
) -> dict[str, DataFrame]:
    """Bring all silver tables up to date; the same as a full refresh, but only changed days are read and made.

    Raw tables of measures carry their load ``batch``; rows of batches that have been taken are not read
    again. Sites, zones and stations are small and taken whole; if sites or zones change, the tables that
    depend on them are made anew. New rows are checked before they are published, and derived ones too: a
    failed check leaves the tables as they were, and the next run finds the same changes again.
    """
    staging = Staging(spark, check is not None)
    try:
        return refreshed(spark, staging, raw, root, sites, check)
    finally:
        staging.clear()


def refreshed(
    spark: SparkSession, staging: Staging, raw: Raw, root: str, sites, check: Check | None,
) -> dict[str, DataFrame]:
    tables = {name: silver_table(spark, root, name) for name in (
        "stg_air_quality", "stg_trafic_velo", "stg_trafic_routier", "int_air_quality_idf", "int_velo_daily", "int_trafic_daily",
        "int_air_quality_zoned", "int_trafic_zoned", "int_velo_zoned", "stg_arrondissements", "stg_coordonnees",
        "stg_stations_velib")}
    sources = raw_tables(raw)
    updates = side_by_side({
        m.staged: lambda m=m: stage_measured(spark, staging, m, sources[m.raw], root) for m in MEASURED})
    whole = {
        "stg_arrondissements": silver.zones(raw.zone_documents), "stg_coordonnees": silver.site_coordinates(raw.sites)}
    if raw.stations is not None:
        whole["stg_stations_velib"] = silver.bike_stations(raw.stations)
    whole = {name: staging.put(df, name) for name, df in whole.items()}
    if check is not None:
        fresh = {m.raw: new_rows(tables[m.staged], sources[m.raw]).drop(BATCH) for m in MEASURED}
        check("staging", sources | fresh | whole | {n: u.rows for n, u in updates.items() if u is not None})
    side_by_side({n: u.publish for n, u in updates.items() if u is not None})
    for name, df in whole.items():
        seen = fingerprint(df)
        if tables[name].manifest().notes.get("seen") != seen:
            tables[name].commit(df, notes={"seen": seen})

    places, zones = tables["stg_coordonnees"], tables["stg_arrondissements"]
    site_print = f"{places.manifest().notes['seen']} {sorted(sites)}"
    daily = {
        "int_air_quality_idf": lambda: stage_derived(
            staging, tables["int_air_quality_idf"], tables["stg_air_quality"], "date_debut", "date_mesure",
            lambda rows: silver.air_region(rows, places.read(), sites), site_print),
        "int_velo_daily": lambda: stage_derived(
            staging, tables["int_velo_daily"], tables["stg_trafic_velo"], "date_jour", "date_jour", silver.bike_daily),
        "int_trafic_daily": lambda: stage_derived(
            staging, tables["int_trafic_daily"], tables["stg_trafic_routier"], "date_jour", "date_jour", silver.road_daily),
    }
    publish_checked(side_by_side(daily), check, "daily")
    index = index_zones(zones.read())
    zone_print = str(zones.manifest().notes["seen"])
    placed = {
        name: lambda name=name, of=of, day=day, build=build: stage_derived(
            staging, tables[name], tables[of], day, "date_jour", lambda rows: build(rows, index), zone_print)
        for name, of, day, build in (
            ("int_air_quality_zoned", "int_air_quality_idf", "date_mesure", silver.air_zoned),
            ("int_trafic_zoned", "int_trafic_daily", "date_jour", silver.road_zoned),
            ("int_velo_zoned", "int_velo_daily", "date_jour", silver.bike_zoned))}
    publish_checked(side_by_side(placed), check, "zoned")
    return {name: df for name, table in tables.items() if (df := table.read()) is not None}


def publish_checked(updates: dict[str, Update | None], check: Check | None, stage: str) -> None:
    """Check the rows that are to be published, then publish them."""
    there = {name: update for name, update in updates.items() if update is not None}
    if there and check is not None:
        check(stage, {name: update.rows for name, update in there.items()})
    side_by_side({name: update.publish for name, update in there.items()})
