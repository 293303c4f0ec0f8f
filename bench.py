"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_REPEAT (timed runs each).
Zones, sites and marts are stored first and timed on their own (other raw tables are not written); every query is then run to completion
into a sink that discards the rows, and its fastest run is reported. Serving and dashboard queries
read the stored marts, all others start from the raw tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

from citylode.catalog.analogs import ANALOGS
from citylode.catalog.queries import MARTS, REGISTRY, SITES, City, first_batch
from citylode.plans.increments import refresh_silver
from citylode.session import build_session, scratch_path

HEADLINE = [
    "stg_air", "stg_bike", "stg_road", "stg_stations", "air_region", "air_daily", "pollution_alerts",
    "bike_daily", "road_daily", "city_kpi_daily", "spatial_join", "spatial_join_shuffled", "zone_air",
    "zone_road", "zone_bike", "zone_spine", "zone_kpi_daily", "incremental_delta", "upsert_merge",
    "serve_air", "serve_bike", "serve_road", "serve_road_daily_avg", "serve_alerts_page",
    "serve_city_kpi", "serve_zone_kpi", "top_sites", "pollutant_trend", "bike_trend",
    "zone_latest_choropleth", "minmax_ramp", "latest_state", "serve_velib",
    "dq_not_null", "dq_unique_key", "dq_report", "run_report",
]
WRITES = {"run_report"}  # evaluated while it is built; one run is enough


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    start = time.perf_counter()
    city = City(spark, sf_dir)
    for name in ANALOGS:
        if name.startswith("raw_"):
            city.raw(name)
    city.zones()
    times["store_raw_tables"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    for name in MARTS:
        city.served(name)
    times["store_marts"] = round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        best = None
        for _ in range(1 if name in WRITES else repeat):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    # All history, then the last days and one that was loaded again.
    work, raw = scratch_path(spark, "increments"), city.batched()
    for name, found in (("first_increment", first_batch(raw)), ("second_increment", raw)):
        start = time.perf_counter()
        refresh_silver(spark, found, work, SITES)
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
