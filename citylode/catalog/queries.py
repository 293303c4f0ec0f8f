"""Named queries over the given test tables, one per operator of the inventory.

Averages pass through ``steady`` and times are rendered as they are, so that results compare equal
with any engine that computes the same thing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.catalog.analogs import ANALOGS, DISTINCT, analog, geojson_documents, table
from citylode.functions import casts
from citylode.functions import geometry as geo
from citylode.functions.numeric import steady
from citylode.operators import quality
from citylode.operators.dedup import keep_latest_row, newest_first, newest_load_per_day
from citylode.operators.merge import merge_rows, upsert_table
from citylode.operators.predicates import MONTH, after, day_slice, latest_available_day
from citylode.operators.spatial import ZoneIndex, index_zones, spatial_join
from citylode.operators.versions import read_table
from citylode.operators.watermark import Watermarks, delta_start, marks_from, merge_marks
from citylode.plans import checks, dashboard, gold, increments, nightly, serving, silver
from citylode.reference_values import CLASSIFIED_HOURS, DATE_COLUMNS, MERGE_KEYS, SITE_SETTINGS
from citylode.schemas import AIR_COLUMNS, BIKE_COLUMNS, STATION_STATE
from citylode.session import scratch_path
from citylode.sinks.export import export_counted, export_snapshot, snapshot_path
from citylode.sources import files, landing
from citylode.sources.topic import decode, read_message_files
from citylode.streaming import ingest, station_state

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# The test tables number their sites 0 to 29; the first 24 form the region.
SITES = [f"FR04{n:03d}" for n in range(24)]
AIR_DAY = dt.date(1998, 1, 10)
AS_OF = dt.date(2001, 1, 1)
MARK = dt.date(1998, 1, 1)


def query(function: Query) -> Query:
    """Register a query under its function's name, less a trailing underscore."""
    REGISTRY[function.__name__.rstrip("_")] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: steady(F.col(c)) for c in columns})


STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
    date_column: str | None = None,
) -> DataFrame:
    """A table written to the shared scratch folder on first use in a session, then read from there.

    Zone, silver and served tables are stored tables, not views: what is measured and planned on top of
    them should not include deriving them from the test tables again.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in STORED:
        STORED[key] = silver.materialise(spark, build(), scratch_path(spark, name), date_column)
    return STORED[key]


def spread(source: DataFrame) -> DataFrame:
    """A table's rows spread over the cores when it gives fewer splits than there are cores."""
    cores = source.sparkSession.sparkContext.defaultParallelism
    return source.repartition(cores) if source.rdd.getNumPartitions() < cores else source


PROJECTED: dict[tuple[str, str, str], DataFrame] = {}


def projected(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw table as a projection of its test table: each reader derives the columns that it uses, no others."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in PROJECTED:
        PROJECTED[key] = analog(spark, sf_dir, name, spread(table(spark, sf_dir, ANALOGS[name][0])))
    return PROJECTED[key]


class City:
    """The layers over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        """A raw table. Only one without repeated rows is stored; writing the others costs more than all reads do."""
        def build() -> DataFrame:
            return projected(self.spark, self.sf_dir, name)
        return stored(self.spark, self.sf_dir, name, build) if name in DISTINCT else build()

    def served(self, name: str) -> DataFrame:
        """A stored mart, partitioned by month like a served table."""
        return stored(
            self.spark, self.sf_dir, name, lambda: MARTS[name](self), DATE_COLUMNS[name])

    def silver(self, name: str) -> DataFrame:
        """A stored typed, daily or zoned table."""
        return stored(self.spark, self.sf_dir, name, lambda: SILVER[name](self))

    def document_files(self) -> DataFrame:
        """Zone documents as they are scanned from files."""
        return stored(self.spark, self.sf_dir, "raw_arrondissements_paris", lambda: files.read_documents(
            self.spark, written_documents(geojson_documents(self.spark, self.sf_dir), "zone-files") + "/*"))

    def batched(self) -> nightly.Raw:
        """Raw tables with load batches: what a first run finds is batch 1, what has come since is batch 2.

        The second batch loads the last days, and one day again of which the first batch holds an earlier load.
        """
        def split(name: str, first_end: dt.datetime) -> DataFrame:
            return self.raw(name).withColumn(increments.BATCH, F.when(F.col("_loaded_at") < F.lit(first_end), 1).otherwise(2))

        return nightly.Raw(
            split("raw_air_quality", dt.datetime(1998, 1, 25, 8, 30)), self.raw("raw_coordonnees"),
            split("raw_trafic_velo", dt.datetime(1998, 1, 25, 7, 30)),
            split("raw_trafic_routier", dt.datetime(1998, 1, 25, 7, 30)), self.documents())

    def air_measures(self) -> DataFrame:
        return silver.air_measures(self.raw("raw_air_quality"))

    def air(self) -> DataFrame:
        return silver.air_region(
            self.air_measures(), silver.site_coordinates(self.raw("raw_coordonnees")), SITES)

    def bike_counts(self) -> DataFrame:
        return silver.bike_counts(self.raw("raw_trafic_velo"))

    def road_counts(self) -> DataFrame:
        return silver.road_counts(self.raw("raw_trafic_routier"))

    def bikes(self) -> DataFrame:
        return silver.bike_daily(self.bike_counts())

    def roads(self) -> DataFrame:
        return silver.road_daily(self.road_counts())

    def documents(self, shapes: str = "zone_shapes") -> DataFrame:
        return geojson_documents(self.spark, self.sf_dir, shapes).select(
            F.parse_json("value").alias("raw_geojson"))

    def zones(self) -> DataFrame:
        return stored(self.spark, self.sf_dir, "zones", lambda: silver.zones(self.documents()))

    @cached_property
    def index(self) -> ZoneIndex:
        return index_zones(self.zones())

    def air_zoned(self) -> DataFrame:
        return silver.air_zoned(self.air(), self.index)

    def road_zoned(self) -> DataFrame:
        return silver.road_zoned(self.roads(), self.index)

    def bike_zoned(self) -> DataFrame:
        return silver.bike_zoned(self.bikes(), self.index)

    def zone_kpi(self, since: dt.date | None = None) -> DataFrame:
        return gold.zone_kpi(
            self.air_zoned(), self.road_zoned(), self.bike_zoned(), self.zones(), since)

    def city_kpi(self, since: dt.date | None = None) -> DataFrame:
        return gold.city_kpi(self.air(), self.roads(), self.bikes(), since)

    def states(self) -> DataFrame:
        return station_state.latest_states(self.raw("station_states"))


MARTS: dict[str, Callable[[City], DataFrame]] = {
    "dm_air_quality_daily": lambda city: gold.air_daily(city.air()),
    "dm_alertes_pollution": lambda city: gold.pollution_alerts(city.air()),
    "dm_velo_daily": lambda city: gold.bike_mart(city.bikes()),
    "dm_trafic_routier_daily": lambda city: gold.road_mart(city.roads()),
    "dm_smartcity_kpi_daily": lambda city: city.city_kpi(),
    "dm_zone_kpi_daily": lambda city: city.zone_kpi(),
}

SILVER: dict[str, Callable[[City], DataFrame]] = {
    "stg_air_quality": lambda city: city.air_measures(),
    "stg_coordonnees": lambda city: silver.site_coordinates(city.raw("raw_coordonnees")),
    "stg_trafic_velo": lambda city: city.bike_counts(),
    "stg_trafic_routier": lambda city: city.road_counts(),
    "stg_stations_velib": lambda city: silver.bike_stations(city.raw("raw_stations_velib")),
    "stg_arrondissements": lambda city: city.zones(),
    "int_air_quality_idf": lambda city: silver.air_region(
        city.silver("stg_air_quality"), city.silver("stg_coordonnees"), SITES),
    "int_velo_daily": lambda city: silver.bike_daily(city.silver("stg_trafic_velo")),
    "int_trafic_daily": lambda city: silver.road_daily(city.silver("stg_trafic_routier")),
    "int_air_quality_zoned": lambda city: silver.air_zoned(city.silver("int_air_quality_idf"), city.index),
    "int_trafic_zoned": lambda city: silver.road_zoned(city.silver("int_trafic_daily"), city.index),
    "int_velo_zoned": lambda city: silver.bike_zoned(city.silver("int_velo_daily"), city.index),
}

AIR_AVERAGES = ("valeur_moyenne", "taux_saisie_moyen")
CITY_AVERAGES = (
    "no2_moyen", "pm10_moyen", "pm25_moyen", "o3_moyen", "debit_routier_moyen", "taux_occupation_moyen")
ZONE_AVERAGES = (
    "no2_moyen", "pm10_moyen", "pm25_moyen", "pollution_indice_moyen", "debit_routier_moyen",
    "taux_occupation_moyen", "ratio_mobilite_verte")
ROAD_AVERAGES = ("debit_moyen", "taux_occupation_moyen")


# ------------------------------------------------------------------ raw scans

def written_csv(city: City, name: str, columns: list[str], folder: str) -> str:
    """Write an analog as the semicolon files its source would deliver."""
    path = f"{scratch_path(city.spark, folder)}/1998/01/31/08/00"
    write_csv(city.raw(name), columns, path)
    return path


def write_csv(raw: DataFrame, columns: list[str], path: str) -> None:
    texts = [(F.col(c) if c in raw.columns else F.lit(None).cast("string")).alias(c) for c in columns]
    raw.select(*texts).write.options(
        sep=";", header=True, nullValue="", emptyValue='""', escape='"').csv(path)


@query
def bronze_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited scan with lineage: what was written comes back as text, with file and load time."""
    path = written_csv(City(spark, sf_dir), "raw_air_quality", AIR_COLUMNS, "csv-scan")
    good, _ = files.split_corrupt(files.read_delimited(spark, path, AIR_COLUMNS))
    return good.select(
        *[c for c in AIR_COLUMNS],
        F.col("_file_name").contains("/1998/01/31/08/00/").alias("has_file"),
        F.col("_loaded_at").isNotNull().alias("has_load_time"),
        landing.run_stamp(F.col("_file_name")).alias("run_at"))


@query
def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed rows are set aside with their text, all others load."""
    fields = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    lines = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 13 == 0, F.concat_ws(";", *fields[:2]))
        .otherwise(F.concat_ws(";", *fields)).alias("value"))
    path = scratch_path(spark, "quarantine")
    lines.write.text(path)
    scan = spark.read.schema(files.corruptible(fields)).options(
        **{**files.delimited_options(), "header": "false"}).csv(path)
    good, bad = files.split_corrupt(files.with_lineage(scan))
    return good.select(
        F.lit("loaded").alias("outcome"), F.concat_ws(";", *fields).alias("row_text"),
        F.lit(len(fields)).alias("fields_present"),
    ).unionByName(bad.select(
        F.lit("quarantined").alias("outcome"), F.col(files.CORRUPT).alias("row_text"), "fields_present"))


def written_documents(docs: DataFrame, folder: str) -> str:
    """One file per document."""
    path = scratch_path(docs.sparkSession, folder)
    docs.repartition("doc").write.partitionBy("doc").text(path)
    return path


@query
def bronze_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files holding a JSON array each: one row per element, nested coordinates projected."""
    k = F.col("c_custkey")
    record = F.struct(
        k.cast("string").alias("stationcode"), F.col("c_name").alias("name"),
        (k % 60).alias("capacity"),
        F.when(k % 19 != 0, F.struct(
            (k % 90 + 0.25).alias("lat"), (k % 180 + 0.5).alias("lon"))).alias("coordonnees_geo"),
        F.concat(F.lit("Area "), k % 20).alias("nom_arrondissement_communes"))
    docs = table(spark, sf_dir, "customer").groupBy(F.floor(k / 500).alias("doc")).agg(
        F.to_json(F.collect_list(record)).alias("value"))
    scan = files.read_stations(spark, written_documents(docs, "stations") + "/*")
    return scan.select(
        "stationcode", "name", "capacity", "nom_arrondissement_communes", "code_insee_commune",
        casts.number(F.col("coordonnees_geo_lat")).alias("latitude"),
        casts.number(F.col("coordonnees_geo_lon")).alias("longitude"))


@query
def bronze_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files taken by a stream that stops when it has caught up; a second run adds nothing."""
    path = written_csv(City(spark, sf_dir), "raw_trafic_velo", BIKE_COLUMNS, "landing")
    work = scratch_path(spark, "ingest")
    for _ in range(2):
        ingest.load_new_files(
            ingest.stream_delimited(spark, path, BIKE_COLUMNS),
            f"{work}/raw", f"{work}/quarantine", f"{work}/checkpoint")
    return ingest.loaded(spark, f"{work}/raw").select("compteur_id", "sum_counts", "date", "date_installation")


@query
def stream_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bicycle mart of two landed runs, streamed under a new checkpoint each time: no file twice, none lost.

    The second run holds two thirds of the rows again; of a day that it loads, the first run's rows go.
    """
    city, root, work = City(spark, sf_dir), scratch_path(spark, "landed"), scratch_path(spark, "reload")
    raw = city.raw("raw_trafic_velo")
    late = F.hour("_loaded_at") == 8
    for run, rows in (("1998/12/31/07/00", raw), ("1998/12/31/08/00", raw.filter(late))):
        write_csv(rows, BIKE_COLUMNS, f"{root}/{run}")
        for _ in range(2):
            ingest.load_new_files(
                ingest.stream_delimited(spark, root, BIKE_COLUMNS, files_per_batch=8), f"{work}/raw", f"{work}/bad",
                scratch_path(spark, "checkpoint"))
    return gold.bike_mart(silver.bike_daily(silver.bike_counts(ingest.loaded(spark, f"{work}/raw"))))


@query
def day_slice_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_slice(table(spark, sf_dir, "events"), "ts", dt.date(2024, 1, 10)).select(
        "event_id", "ts", "user_id", "value")


@query
def latest_available_day_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asked for 1 February, the newest day within three days is 30 January."""
    return latest_available_day(
        table(spark, sf_dir, "events"), "ts", dt.date(2024, 2, 1)).select("event_id", "ts", "user_id")


# --------------------------------------------------------------------- silver

@query
def latest_load_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_load_per_day(
        City(spark, sf_dir).raw("raw_air_quality"), casts.stamp(F.col("date_debut")).cast("date"))


@query
def stg_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return City(spark, sf_dir).air_measures().select(
        "date_debut", "date_fin", "organisme", "code_site", "nom_site", "polluant", "reglementaire",
        "valeur", "valeur_brute", "unite_mesure", "taux_saisie", "code_qualite", "validite", "_file_name")


@query
def stg_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.site_coordinates(City(spark, sf_dir).raw("raw_coordonnees")).drop("_loaded_at")


@query
def stg_bike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return City(spark, sf_dir).bike_counts().drop("_loaded_at")


@query
def stg_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    return City(spark, sf_dir).road_counts().drop("_loaded_at")


@query
def stg_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.bike_stations(City(spark, sf_dir).raw("raw_stations_velib"))


@query
def dedup_latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest_row(
        table(spark, sf_dir, "events"), ["user_id"], [newest_first("ts"), newest_first("event_id")],
    ).select("user_id", "event_id", "ts", "event_type", "value")


@query
def latlon_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    pair = F.when(k % 23 == 0, (k % 90).cast("string")).otherwise(
        F.concat((k % 90 + 0.25).cast("string"), F.lit(", "), (k % 180 + 0.5).cast("string")))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", casts.latitude(pair).alias("latitude"), casts.longitude(pair).alias("longitude"))


@query
def region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.in_region(City(spark, sf_dir).air_measures(), SITES).select(
        "code_site", "polluant", "date_debut", "valeur")


@query
def air_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return City(spark, sf_dir).air().select(
        "date_debut", "date_fin", "code_site", "nom_site", "type_implantation", "polluant", "valeur",
        "unite_mesure", "reglementaire", "taux_saisie", "latitude", "longitude", "date_mesure")


# ------------------------------------------------------------------ geography

@query
def geojson_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-document scan of GeoJSON files, one row per feature."""
    docs = written_documents(geojson_documents(spark, sf_dir, "customer_shapes"), "geojson")
    return silver.zones(files.read_documents(spark, docs + "/*")).drop("geometry")


@query
def geometry_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of every polygon, one row each."""
    shapes = silver.zones(City(spark, sf_dir).documents("customer_shapes"))
    return shapes.select("arrondissement_code", F.inline(geo.edges(F.col("geometry"))))


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", (k * 7919 % 5003 * 5 / F.lit(5003.0)).alias("longitude"),
        (k * 104729 % 4999 * 5 / F.lit(4999.0)).alias("latitude"))


@query
def spatial_join_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial_join(customer_points(spark, sf_dir), City(spark, sf_dir).index).select(
        "c_custkey", "arrondissement_code", "nom_arrondissement")


@query
def spatial_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join on the path for many zones: salted shuffle on the cell."""
    index = index_zones(City(spark, sf_dir).zones(), strategy="shuffle")
    return spatial_join(customer_points(spark, sf_dir), index).select("c_custkey", "arrondissement_code", "nom_arrondissement")


@query
def zone_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(City(spark, sf_dir).air_zoned(), "valeur_moyenne")


@query
def zone_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(City(spark, sf_dir).road_zoned(), *ROAD_AVERAGES)


@query
def zone_bike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return City(spark, sf_dir).bike_zoned()


@query
def ref_zones_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full export of the zone reference, read back in key order; geometry as its outline's numbers."""
    shapes = silver.zones(City(spark, sf_dir).documents("customer_shapes"))
    path = export_snapshot(
        gold.reference_zones(shapes), scratch_path(spark, "ref"), "ref_arrondissements", AS_OF)
    back = serving.zone_list(files.read_lowered(spark, path))
    outline = F.from_json(F.get_json_object("geometry", "$.coordinates"), geo.POLYGON)[0]
    return back.select(
        "arrondissement_code", "code_insee", "nom_arrondissement", "surface_m2", "centroid_lat",
        "centroid_lon", F.size(outline).alias("vertices"), outline[1][0].alias("east"),
        outline[2][1].alias("north"))


# ---------------------------------------------------------------------- marts

@query
def air_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.air_daily(City(spark, sf_dir).air()), *AIR_AVERAGES)


@query
def pollution_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.pollution_alerts(City(spark, sf_dir).air()), "valeur_moyenne")


@query
def bike_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.bike_mart(City(spark, sf_dir).bikes())


@query
def road_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.road_mart(City(spark, sf_dir).roads()), *ROAD_AVERAGES)


@query
def pollutant_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        gold.air_city(City(spark, sf_dir).air()).drop("nb_stations_alerte"), *CITY_AVERAGES[:4])


@query
def stations_in_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.air_city(City(spark, sf_dir).air(), level=100.0).select("date_jour", "nb_stations_alerte")


@query
def road_city_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.road_city(City(spark, sf_dir).roads()), *CITY_AVERAGES[4:])


@query
def bike_city_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.bike_city(City(spark, sf_dir).bikes())


@query
def city_kpi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(City(spark, sf_dir).city_kpi(), *CITY_AVERAGES)


@query
def zone_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    city = City(spark, sf_dir)
    return gold.zone_spine(city.air_zoned(), city.road_zoned(), city.bike_zoned())


@query
def zone_kpi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(City(spark, sf_dir).zone_kpi(), *ZONE_AVERAGES)


@query
def green_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        City(spark, sf_dir).zone_kpi().select(
            "arrondissement_code", "date_jour", "total_velos", "debit_routier_moyen", "ratio_mobilite_verte"),
        "debit_routier_moyen", "ratio_mobilite_verte")


# ------------------------------------------------- incremental runs and sinks

@query
def incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart after the mark stored for it."""
    marks = Watermarks(spark, scratch_path(spark, "marks"))
    marks.advance({"dm_velo_daily": MARK})
    return gold.bike_mart(City(spark, sf_dir).bikes(), delta_start(marks.get("dm_velo_daily")))


def mart_marks(city: City) -> DataFrame:
    return marks_from({
        "dm_air_quality_daily": (gold.air_daily(city.air()), "date_mesure"),
        "dm_velo_daily": (gold.bike_mart(city.bikes()), "date_jour"),
        "dm_trafic_routier_daily": (gold.road_mart(city.roads()), "date_jour"),
    })


@query
def watermark_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks set from the outputs' greatest dates; a mark of another dataset stays."""
    city = City(spark, sf_dir)
    first = F.min("date_jour").alias("last_date")
    current = gold.bike_mart(city.bikes()).agg(first).select(
        F.explode(F.array(F.lit("dm_velo_daily"), F.lit("dm_zone_kpi_daily"))).alias("dataset"), "last_date")
    return merge_marks(current, mart_marks(city))


@query
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals from the line items, under doubled keys, merged into the orders."""
    target = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.lit("order").alias("origin"))
    source = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") * 2).alias("o_orderkey")).agg(
        F.max("l_extendedprice").alias("price")).withColumn("origin", F.lit("lines"))
    return merge_rows(target, source, ["o_orderkey"])


@query
def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A served table loaded with bicycle days, then corrected from a mark on, twice."""
    path = scratch_path(spark, "served")
    mart = gold.bike_mart(City(spark, sf_dir).bikes())
    keys = MERGE_KEYS["dm_velo_daily"]
    upsert_table(spark, path, mart, keys, "date_jour")
    corrected = after(mart, "date_jour", MARK).withColumn(
        "total_passages_jour", F.col("total_passages_jour") + 1000)
    for _ in range(2):
        upsert_table(spark, path, corrected, keys, "date_jour")
    return read_table(spark, path).select("compteur_id", "date_jour", "total_passages_jour", "pic_horaire")


@query
def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot exported under upper-case names and read back in lower case."""
    mart = gold.air_daily(City(spark, sf_dir).air())
    path = export_snapshot(
        mart.toDF(*[c.upper() for c in mart.columns]), scratch_path(spark, "export"),
        "dm_air_quality_daily", AS_OF)
    return rounded(files.read_lowered(spark, path), *AIR_AVERAGES)


@query
def route_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts exported by two runs, then served from the files that are found, routed by their paths.

    The first run's bicycle days are too high by 1000, the second corrects those after a mark. A dataset that
    is not served lies there as well.
    """
    city, root = City(spark, sf_dir), scratch_path(spark, "exports")
    bikes, zones = city.served("dm_velo_daily"), city.served("dm_zone_kpi_daily")
    raised = bikes.withColumn("total_passages_jour", F.col("total_passages_jour") + 1000)
    for hour, dataset, df in (
            (6, "dm_velo_daily", raised), (6, "dm_zone_kpi_daily", zones), (6, "dm_unknown", zones),
            (7, "dm_velo_daily", after(bikes, "date_jour", MARK))):
        export_counted(df.drop(MONTH), f"{snapshot_path(root, dataset, AS_OF)}/run={hour:02d}", None)
    for _ in range(2):  # the second time there is nothing left to serve
        nightly.load_serving(spark, {}, root)
    parts = [
        read_table(spark, f"{root}/serving/{dataset}").select(
            F.lit(dataset).alias("dataset"), F.col(key).cast("string").alias("item"), "date_jour",
            F.col(value).cast("long").alias("metric"))
        for dataset, key, value in (
            ("dm_velo_daily", "compteur_id", "total_passages_jour"), ("dm_zone_kpi_daily", "arrondissement_code", "total_velos"))]
    left = nightly.unserved(spark, root).select(
        "dataset", F.lit("unserved").alias("item"), F.lit(None).cast("date").alias("date_jour"), F.lit(0).cast("long").alias("metric"))
    return parts[0].unionByName(parts[1]).unionByName(left)


@query
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows exported per mart by a first run, then by a second one that finds nothing new."""
    city, work = City(spark, sf_dir), scratch_path(spark, "run")
    raw = nightly.Raw(
        city.raw("raw_air_quality"), city.raw("raw_coordonnees"), city.raw("raw_trafic_velo"),
        city.raw("raw_trafic_routier"), city.documents())
    builders = nightly.marts(nightly.build_silver(spark, raw, work, SITES))
    marks = Watermarks(spark, f"{work}/watermark")
    start = dt.datetime(2001, 1, 1, 6, 0)
    runs = [
        nightly.report(spark, nightly.export_marts(builders, work, marks, start + dt.timedelta(hours=h)))
        .withColumn("run_no", F.lit(h)) for h in range(2)]
    return runs[0].unionByName(runs[1])


def first_batch(raw: nightly.Raw) -> nightly.Raw:
    """Raw tables as a first run finds them."""
    return nightly.Raw(
        *[df.filter(F.col(increments.BATCH) == 1) if increments.BATCH in df.columns else df
          for df in (raw.air, raw.sites, raw.bikes, raw.roads)], raw.zone_documents)


def two_increments(city: City) -> tuple[dict[str, DataFrame], str]:
    """Silver tables after a run that finds the first batch and one that finds the second, and where they are."""
    work, raw = scratch_path(city.spark, "increments"), city.batched()
    increments.refresh_silver(city.spark, first_batch(raw), work, SITES)
    return increments.refresh_silver(city.spark, raw, work, SITES), work


@query
def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone indicators from silver tables that two runs have built, each from its new loads."""
    tables, _ = two_increments(City(spark, sf_dir))
    return rounded(gold.zone_kpi(
        tables["int_air_quality_zoned"], tables["int_trafic_zoned"], tables["int_velo_zoned"],
        tables["stg_arrondissements"]), *ZONE_AVERAGES)


@query
def incremental_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that the second run has made anew, by table."""
    _, work = two_increments(City(spark, sf_dir))
    found = [
        nightly.silver_table(spark, work, name).side(increments.DAYS).filter("changed_in = 2").select(
            F.lit(name).alias("table_name"), "day")
        for name in ("stg_air_quality", "int_air_quality_idf", "stg_trafic_velo", "int_velo_zoned", "int_trafic_daily")]
    return reduce(DataFrame.unionByName, found)


# -------------------------------------------------------------------- serving

@query
def serve_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = rounded(City(spark, sf_dir).served("dm_air_quality_daily"), *AIR_AVERAGES)
    return serving.air_quality(
        mart, dt.date(1998, 1, 5), dt.date(1998, 1, 20), pollutant="NO2", limit=200)


@query
def serve_air_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = rounded(City(spark, sf_dir).served("dm_air_quality_daily"), *AIR_AVERAGES)
    return serving.air_quality(mart, start=AIR_DAY, site="FR04003", limit=1000)


@query
def serve_alerts_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = rounded(City(spark, sf_dir).served("dm_alertes_pollution"), "valeur_moyenne")
    return serving.alerts(mart, end=dt.date(1998, 1, 25), limit=150, offset=75)


@query
def serve_all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = rounded(City(spark, sf_dir).served("dm_alertes_pollution"), "valeur_moyenne")
    return serving.all_alerts(mart, pollutant="NO2")


@query
def serve_alert_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All alerts of a pollutant, page after page to the end; each page is found from the last row before it."""
    mart = rounded(City(spark, sf_dir).served("dm_alertes_pollution"), "valeur_moyenne")
    path, last, number = scratch_path(spark, "pages"), None, 0
    while True:
        serving.alerts_after(mart, last, pollutant="NO2", limit=1000).write.parquet(f"{path}/page={number}")
        page = spark.read.schema(mart.drop(MONTH).schema).parquet(f"{path}/page={number}")
        if page.count() < 1000:
            return spark.read.schema(mart.drop(MONTH).schema).parquet(f"{path}/*")
        last = page.orderBy(*[by.backward() for by in serving.ALERT_ORDER]).first().asDict()
        number += 1


@query
def serve_bike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.bike_days(
        City(spark, sf_dir).served("dm_velo_daily"), start=dt.date(1997, 1, 1), counter="c17")


@query
def serve_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.road_days(
        rounded(City(spark, sf_dir).served("dm_trafic_routier_daily"), *ROAD_AVERAGES),
        end=dt.date(1998, 6, 30), arc="arc3", limit=500)


@query
def serve_road_daily_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.road_daily_average(
        City(spark, sf_dir).served("dm_trafic_routier_daily"), start=dt.date(1998, 1, 1)), "debit_moyen")


@query
def serve_city_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.city_indicators(
        City(spark, sf_dir).served("dm_smartcity_kpi_daily"), end=dt.date(1998, 1, 20), limit=10), *CITY_AVERAGES)


@query
def serve_zone_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.zone_indicators(
        City(spark, sf_dir).served("dm_zone_kpi_daily"), start=dt.date(1998, 1, 1), zone=14, limit=50), *ZONE_AVERAGES)


# ------------------------------------------------------------------ dashboard

@query
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.pollutants(City(spark, sf_dir).served("dm_air_quality_daily"))


@query
def pollutant_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        dashboard.pollutant_trend(City(spark, sf_dir).served("dm_air_quality_daily"), "NO2"), "valeur_moyenne")


@query
def top_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.most_exposed_sites(City(spark, sf_dir).served("dm_air_quality_daily"), "PM10")


@query
def custom_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dashboard.exceedances(City(spark, sf_dir).served("dm_air_quality_daily"), "NO2", 40)
    return dashboard.ranked(
        rounded(rows.select("date_mesure", "code_site", "nom_site", "unite_mesure", "type_implantation",
                            "valeur_max", "valeur_moyenne", "ratio"), "valeur_moyenne"),
        "ratio", "date_mesure", "code_site")


@query
def threshold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = City(spark, sf_dir).served("dm_alertes_pollution")
    return dashboard.exceedance_summary(
        dashboard.exceedances(alerts, "O3", 60, value="valeur_max_journaliere"))


@query
def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dashboard.exceedances(City(spark, sf_dir).served("dm_air_quality_daily"), "PM10", 50)
    return dashboard.with_coordinates(rows).select(
        "code_site", "date_mesure", "unite_mesure", "type_implantation", "ratio", "latitude", "longitude")


@query
def bike_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.bike_trend(City(spark, sf_dir).served("dm_velo_daily"))


@query
def latest_city_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(dashboard.latest_city_day(City(spark, sf_dir).served("dm_smartcity_kpi_daily")), *CITY_AVERAGES)


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones with the indicators of the newest day."""
    city = City(spark, sf_dir)
    return dashboard.zone_snapshot(gold.reference_zones(city.zones()), city.served("dm_zone_kpi_daily"))


@query
def zone_latest_choropleth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(snapshot(spark, sf_dir).drop("geometry", "code_insee", "surface_m2"), *ZONE_AVERAGES)


@query
def minmax_ramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.zone_colours(snapshot(spark, sf_dir), "total_velos").select(
        "arrondissement_code", "total_velos", "fill_color.*")


@query
def feature_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone features written as text lines, read back and taken apart."""
    path = scratch_path(spark, "features")
    coloured = dashboard.zone_colours(snapshot(spark, sf_dir), "total_velos")
    dashboard.zone_features(coloured, "total_velos").select("feature").write.text(path)
    text = F.col("value")

    def at(where: str, kind: str) -> Column:
        return F.get_json_object(text, where).cast(kind)

    return spark.read.text(path).select(
        at("$.type", "string").alias("kind"), at("$.geometry.type", "string").alias("shape"),
        at("$.properties.nom_arrondissement", "string").alias("nom_arrondissement"),
        at("$.properties.value", "double").alias("metric"),
        at("$.properties.fill_color[0]", "int").alias("red"),
        at("$.properties.fill_color[1]", "int").alias("green"))


# ----------------------------------------------------------------- live state

@query
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return City(spark, sf_dir).states()


@query
def latest_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same states sent as messages through a stream into the state table, with some bad text."""
    states = City(spark, sf_dir).raw("station_states")
    names = STATION_STATE.fieldNames()
    work = scratch_path(spark, "live")
    text = F.when(F.col("position") % 53 == 0, F.lit("not json")).otherwise(
        F.to_json(F.struct(*names)))
    states.select(text.alias("value")).write.text(f"{work}/topic")
    live = station_state.StateTable(spark, f"{work}/state")
    station_state.follow(
        decode(read_message_files(spark, f"{work}/topic")), live, f"{work}/bad", f"{work}/checkpoint")
    return live.read().select("stationId", "timestamp", "num_docks_available", "nom_arrondissement_communes")


@query
def latest_state_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same states by an aggregate in the state store: each batch writes the stations it changed.

    Two streams share the messages' folder one after the other; the second knows nothing of the first.
    """
    states = City(spark, sf_dir).raw("station_states")
    work = scratch_path(spark, "live")
    text = F.when(F.col("position") % 53 == 0, F.lit("not json")).otherwise(F.to_json(F.struct(*STATION_STATE.fieldNames())))
    states.select(text.alias("value")).write.text(f"{work}/topic")
    live = station_state.ChangeTable(spark, f"{work}/state", merge_after=3)
    for checkpoint in ("first", "second"):
        station_state.follow_changes(
            decode(read_message_files(spark, f"{work}/topic", files_per_batch=4)), live, f"{work}/{checkpoint}")
    return live.read().select("stationId", "timestamp", "num_docks_available", "nom_arrondissement_communes")


@query
def serve_velib(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.stations(City(spark, sf_dir).states(), area="zone 7", limit=1500)


@query
def velib_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.station(City(spark, sf_dir).states(), "8")


@query
def velib_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.fleet_totals(City(spark, sf_dir).states())


@query
def velib_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.with_coordinates(City(spark, sf_dir).states()).select(
        "stationId", "latitude", "longitude", "num_bikes_available")


# -------------------------------------------------------------------- quality

@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(
        City(spark, sf_dir).raw("raw_air_quality"), ["code_site", "polluant", "type_implantation",
                                                     "reglementaire", "code_qualite"])


@query
def dq_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_keys(
        City(spark, sf_dir).raw("raw_trafic_velo"), ["compteur_id", "date"])


@query
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unexpected_values(
        City(spark, sf_dir).raw("raw_air_quality"), "type_implantation", SITE_SETTINGS)


@query
def dq_future_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    city = City(spark, sf_dir)
    return quality.future_dates({
        "int_air_quality_idf": (city.air(), "date_mesure"),
        "int_velo_daily": (city.bikes(), "date_jour"),
        "int_trafic_daily": (city.roads(), "date_jour"),
    }, as_of=dt.date(2000, 6, 1))


@query
def dq_hours_within_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a limit of 2 hours instead of 24, which these tables do exceed."""
    return quality.hours_over(
        City(spark, sf_dir).roads(), list(CLASSIFIED_HOURS), ["arc_id", "date_jour"], limit=2)


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks of all raw, typed, daily and zoned tables, one row each."""
    city = City(spark, sf_dir)
    tables = {name: city.raw(name) for name in ANALOGS if name.startswith("raw_")} | {
        "raw_arrondissements_paris": city.document_files()} | {name: city.silver(name) for name in SILVER}
    return quality.run_checks(tables, checks.silver_checks(tables, as_of=dt.date(2000, 6, 1), hours=2))
