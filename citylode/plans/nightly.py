"""The daily run: raw tables to checked silver tables, delta marts, and served tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.operators.ledger import ENTRY, Ledger
from citylode.operators.merge import upsert_table
from citylode.operators.quality import gate, run_checks
from citylode.operators.spatial import index_zones
from citylode.operators.storage import children, remove
from citylode.operators.versions import VersionedTable
from citylode.operators.watermark import Watermarks, delta_start
from citylode.plans import gold, silver
from citylode.plans.checks import silver_checks
from citylode.reference_values import DATE_COLUMNS, MERGE_KEYS, REGION_SITES
from citylode.schemas import as_served
from citylode.session import scratch_path
from citylode.sinks.export import export_counted, snapshot_path
from citylode.sources.files import read_lowered
from citylode.sources.landing import exported_files


@dataclass(frozen=True)
class Raw:
    """Raw tables of one run."""
    air: DataFrame
    sites: DataFrame
    bikes: DataFrame
    roads: DataFrame
    zone_documents: DataFrame
    stations: DataFrame | None = None


# name -> date column, whose month partitions the table
SILVER_LAYOUT = {
    "stg_air_quality": "date_debut",
    "stg_coordonnees": None,
    "stg_trafic_velo": "date_jour",
    "stg_trafic_routier": "date_jour",
    "stg_stations_velib": None,
    "stg_arrondissements": None,
    "int_air_quality_idf": "date_mesure",
    "int_velo_daily": "date_jour",
    "int_trafic_daily": "date_jour",
    "int_air_quality_zoned": "date_jour",
    "int_trafic_zoned": "date_jour",
    "int_velo_zoned": "date_jour",
}

# Checks the tables of a stage; raises if they must not be built upon.
Check = Callable[[str, dict[str, DataFrame]], None]


def side_by_side(work: dict[str, Callable[[], object]], threads: int = 4) -> dict[str, object]:
    """Submit independent jobs together, so that one's last tasks do not leave the cluster idle.

    All of them are awaited; the first failure is then raised.
    """
    with ThreadPoolExecutor(threads) as pool:
        futures = {name: pool.submit(job) for name, job in work.items()}
    return {name: future.result() for name, future in futures.items()}


def silver_table(spark: SparkSession, root: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{root}/silver/{name}", SILVER_LAYOUT[name])


def raw_tables(raw: Raw) -> dict[str, DataFrame]:
    """The raw tables that are there, by name."""
    named = {
        "raw_air_quality": raw.air, "raw_coordonnees": raw.sites, "raw_trafic_velo": raw.bikes,
        "raw_trafic_routier": raw.roads, "raw_stations_velib": raw.stations,
        "raw_arrondissements_paris": raw.zone_documents}
    return {name: df for name, df in named.items() if df is not None}


def build_silver(
    spark: SparkSession, raw: Raw, root: str, sites=REGION_SITES, check: Check | None = None,
) -> dict[str, DataFrame]:
    """Full refresh: typed tables first, from them the daily ones, then those placed into zones.

    ``check`` sees the raw and typed tables before anything is looked up in or derived from them, and the
    daily and zoned ones at the end.
    """
    def put(builders: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        return side_by_side({
            name: lambda name=name, build=build: silver_table(spark, root, name).commit(build())
            for name, build in builders.items()})

    typed = {
        "stg_arrondissements": lambda: silver.zones(raw.zone_documents),
        "stg_air_quality": lambda: silver.air_measures(raw.air),
        "stg_coordonnees": lambda: silver.site_coordinates(raw.sites),
        "stg_trafic_velo": lambda: silver.bike_counts(raw.bikes),
        "stg_trafic_routier": lambda: silver.road_counts(raw.roads),
    }
    if raw.stations is not None:
        typed["stg_stations_velib"] = lambda: silver.bike_stations(raw.stations)
    staged = put(typed)
    if check is not None:
        check("staging", raw_tables(raw) | staged)
    daily = put({
        "int_air_quality_idf": lambda: silver.air_region(
            staged["stg_air_quality"], staged["stg_coordonnees"], sites),
        "int_velo_daily": lambda: silver.bike_daily(staged["stg_trafic_velo"]),
        "int_trafic_daily": lambda: silver.road_daily(staged["stg_trafic_routier"]),
    })
    index = index_zones(staged["stg_arrondissements"])
    daily |= put({
        "int_air_quality_zoned": lambda: silver.air_zoned(daily["int_air_quality_idf"], index),
        "int_trafic_zoned": lambda: silver.road_zoned(daily["int_trafic_daily"], index),
        "int_velo_zoned": lambda: silver.bike_zoned(daily["int_velo_daily"], index),
    })
    if check is not None:
        check("silver", daily)
    return staged | daily


def marts(tables: dict[str, DataFrame]) -> dict[str, Callable[[dt.date | None], DataFrame]]:
    """Mart builders by dataset, each taking its high-water mark."""
    air, bikes, roads = (tables[n] for n in ("int_air_quality_idf", "int_velo_daily", "int_trafic_daily"))
    zoned = [tables[n] for n in ("int_air_quality_zoned", "int_trafic_zoned", "int_velo_zoned")]
    zones = tables["stg_arrondissements"]
    return {
        "dm_air_quality_daily": lambda since: gold.stamped(gold.air_daily(air, since)),
        "dm_alertes_pollution": lambda since: gold.stamped(gold.pollution_alerts(air, since)),
        "dm_velo_daily": lambda since: gold.stamped(gold.bike_mart(bikes, since)),
        "dm_trafic_routier_daily": lambda since: gold.stamped(gold.road_mart(roads, since)),
        "dm_smartcity_kpi_daily": lambda since: gold.stamped(gold.city_kpi(air, roads, bikes, since)),
        "dm_zone_kpi_daily": lambda since: gold.stamped(gold.zone_kpi(*zoned, zones, since)),
        "ref_arrondissements": lambda since: gold.reference_zones(zones),
    }


@dataclass(frozen=True)
class Exported:
    rows: int
    last_date: dt.date | None
    path: str


def export_marts(
    builders: dict[str, Callable[[dt.date | None], DataFrame]], root: str, marks: Watermarks,
    run: dt.datetime, lookback_days: int = 0, advance: bool = True,
) -> dict[str, Exported]:
    """Compute and write every mart's delta once, then advance its own mark.

    Each run writes its own folder below the run date, so an empty delta never replaces an earlier
    export of that day. A mark moves only after the mart's write has finished, only if it had rows,
    and also when another mart failed; the reference table has no mark and is exported in full. Without
    ``advance`` marks stay, for a caller that moves them when the rows are served.
    """
    before, done = marks.all(), {}

    def export(dataset: str) -> None:
        date_column = DATE_COLUMNS.get(dataset)
        since = delta_start(before.get(dataset), lookback_days) if date_column else None
        path = f"{snapshot_path(root, dataset, run.date())}/run={run:%H%M%S%f}"
        done[dataset] = Exported(*export_counted(builders[dataset](since), path, date_column), path)

    try:
        side_by_side({dataset: lambda dataset=dataset: export(dataset) for dataset in builders})
    finally:
        if advance:
            advance_marks(marks, done)
    return {dataset: done[dataset] for dataset in builders}


def advance_marks(marks: Watermarks, done: dict[str, Exported]) -> None:
    marks.advance({d: e.last_date for d, e in done.items() if e.rows and d in DATE_COLUMNS})


def unserved(spark: SparkSession, root: str) -> DataFrame:
    """Exported files that have not been served yet, whichever run exported them."""
    return Ledger(spark, f"{root}/serving/exports").unknown(exported_files(spark, root))


def load_serving(spark: SparkSession, exported: dict[str, Exported], root: str, marks: Watermarks | None = None) -> None:
    """Serve what lies exported: files are found and routed by their paths, those of earlier runs first.

    Of each dataset, the runs with files that have not been served are upserted one after the other, oldest
    first, so the last export of a row wins whatever was lost before. Files are noted as served after their
    rows are; a run that is lost in between serves them again, which changes nothing. The mark of a dataset
    moves once its rows are served; after a failed upsert the next run finds the same files, and exports the
    same rows again.
    """
    if not children(spark, f"{root}/gold_export"):
        return
    staged = scratch_path(spark, "exports")
    unserved(spark, root).coalesce(1).write.parquet(staged)
    queue = spark.read.parquet(staged)
    runs: dict[str, list[str]] = {}  # a run has one folder a dataset
    for row in queue.select("dataset", "run").distinct().orderBy("dataset", "run").collect():
        runs.setdefault(row["dataset"], []).append(row["run"])
    served: dict[str, list[str]] = {}

    def load(dataset: str) -> None:
        for folder in runs[dataset]:
            rows = as_served(read_lowered(spark, folder), dataset)
            upsert_table(
                spark, f"{root}/serving/{dataset}", rows, MERGE_KEYS[dataset], DATE_COLUMNS.get(dataset))
            served.setdefault(dataset, []).append(folder)

    try:
        side_by_side({dataset: lambda dataset=dataset: load(dataset) for dataset in runs})
    finally:
        done = [folder for folders in served.values() for folder in folders]
        if done:
            ledger = Ledger(spark, f"{root}/serving/exports")
            ledger.add(queue.filter(F.col("run").isin(done)).select(*ENTRY), ledger.last() + 1)
        remove(spark, staged)
        if marks is not None:
            # An empty export of a dataset has nothing to serve and moves no mark.
            advance_marks(marks, {d: e for d, e in exported.items() if served.get(d) == runs.get(d, [])})


def report(spark: SparkSession, exported: dict[str, Exported]) -> DataFrame:
    """Rows exported per dataset."""
    return spark.createDataFrame([(d, e.rows) for d, e in exported.items()], "dataset string, n bigint")


def stored_gate(root: str, run: dt.datetime) -> Check:
    """Checks a stage's tables, stores the report with the run, warnings included, and stops on errors."""
    def check(stage: str, tables: dict[str, DataFrame]) -> None:
        path = f"{root}/checks/run={run:%Y%m%d%H%M%S%f}/stage={stage}"
        run_checks(tables, silver_checks(tables)).write.mode("overwrite").parquet(path)
        gate(next(iter(tables.values())).sparkSession.read.parquet(path))

    return check


def run_day(
    spark: SparkSession, raw: Raw, root: str, run: dt.datetime | None = None, lookback_days: int = 0,
    sites=REGION_SITES, refresh: Callable[..., dict[str, DataFrame]] = build_silver,
) -> dict[str, Exported]:
    """The whole daily run. A failed check of severity error stops it: on raw and typed tables before anything
    is derived from them, on the others before the marts.

    ``refresh`` is ``build_silver``, or ``increments.refresh_silver`` where raw tables tell their load batches.
    """
    run = run or dt.datetime.now(dt.timezone.utc)
    tables = refresh(spark, raw, root, sites, stored_gate(root, run))
    marks = Watermarks(spark, f"{root}/watermark")
    exported = export_marts(marts(tables), root, marks, run, lookback_days, advance=False)
    load_serving(spark, exported, root, marks)
    return exported
