"""Increments against a full refresh."""

import dataclasses
import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_nightly import bike, measure, raw, raw_table, road

from citylode.operators.quality import QualityError
from citylode.plans import increments, nightly
from citylode.plans.increments import refresh_silver
from citylode.schemas import AIR_COLUMNS, BIKE_COLUMNS, ROAD_COLUMNS

SITES = ["S1", "S2"]
MADE = [n for n in nightly.SILVER_LAYOUT if n != "stg_stations_velib"]


def batch_of(spark, number, loaded, air=(), bikes=(), roads=()):
    """One load batch of each raw table."""
    tables = raw(spark, [], [], [])
    return dataclasses.replace(
        tables, **{name: raw_table(spark, columns, records, loaded).withColumn("batch", F.lit(number)) for name, columns, records in (
            ("air", AIR_COLUMNS, air), ("bikes", BIKE_COLUMNS, bikes), ("roads", ROAD_COLUMNS, roads))},
        sites=raw_table(spark, ["code_site", "latitude", "longitude"], [
            {"code_site": s, "latitude": "0.5", "longitude": x} for s, x in (("S1", "0.5"), ("S2", "0.25"))]))


def together(batches):
    first, *others = batches
    for other in others:
        first = dataclasses.replace(
            first, **{n: getattr(first, n).unionByName(getattr(other, n)) for n in ("air", "bikes", "roads")})
    return first


def as_text(tables):
    return {
        name: sorted(str(tuple(r)) for r in tables[name].select(sorted(set(tables[name].columns) - {"batch", "month"})).collect())
        for name in MADE}


def full(spark, batches, root):
    return as_text(nightly.build_silver(spark, together(batches), root, SITES))


def test_increments_equal_a_full_refresh(spark, tmp_path):
    """Random loads: newer, older and equal ones of the same days, partial reloads, days that empty."""
    rng = random.Random(9)
    days, batches = [f"2026-0{m}-0{d}" for m in (5, 6) for d in range(1, 4)], []
    for number in range(1, 4):
        loaded = dt.datetime(2026, 7, 1, rng.choice([1, 2, 3]))
        some = rng.sample(days, 3)
        batches.append(batch_of(
            spark, number, loaded,
            [measure(rng.choice(SITES), d.replace("-", "/"), rng.randrange(24), str(rng.randrange(99))) for d in some for _ in range(3)]
            + [measure(None, some[0].replace("-", "/"))],
            [bike(d, str(rng.randrange(50))) for d in some] + [bike(some[1]) | {"compteur_id": None}],
            [road(d, rng.randrange(9), rng.choice(["Dense", "Fluide"])) for d in some for _ in range(2)]))
        got = refresh_silver(spark, together(batches), str(tmp_path / "increments"), SITES)
    got, want = as_text(got), full(spark, batches, str(tmp_path / "full"))
    for name in MADE:
        assert got[name] == want[name], name


def changed(spark, root, name):
    return rows(nightly.silver_table(spark, root, name).side(increments.DAYS).select("day", "changed_in"))


def test_only_changed_days_are_made_anew(spark, tmp_path):
    root = str(tmp_path)
    at = [dt.datetime(2026, 7, d) for d in (1, 2, 3)]
    first = batch_of(spark, 1, at[1], [measure(day="2026/05/01"), measure(day="2026/06/08")],
                     [bike("2026-05-01"), bike("2026-06-08")], [road("2026-05-01"), road("2026-06-08")])
    refresh_silver(spark, first, root, SITES)
    tables = {n: nightly.silver_table(spark, root, n) for n in MADE}
    may = {n: t.manifest().parts.get("month=2026-05-01") for n, t in tables.items()}
    before = {n: t.version() for n, t in tables.items()}
    # Again: nothing new. Then a newer load of one day of one table, an older load of another's.
    refresh_silver(spark, first, root, SITES)
    assert {n: t.version() for n, t in tables.items()} == before
    second = batch_of(spark, 2, at[2], bikes=[bike("2026-06-08", "99")])
    third = batch_of(spark, 3, at[0], roads=[road("2026-05-01", 9), road("2026-05-02")])
    got = as_text(refresh_silver(spark, together([first, second, third]), root, SITES))
    assert got == full(spark, [first, second, third], str(tmp_path / "full"))
    assert changed(spark, root, "int_velo_daily") == [(dt.date(2026, 5, 1), 1), (dt.date(2026, 6, 8), 2)]
    assert changed(spark, root, "int_velo_zoned") == [(dt.date(2026, 5, 1), 1), (dt.date(2026, 6, 8), 2)]
    assert changed(spark, root, "int_trafic_daily") == [(dt.date(2026, 5, 1), 1), (dt.date(2026, 5, 2), 2), (dt.date(2026, 6, 8), 1)]
    now = {n: t.manifest().parts.get("month=2026-05-01") for n, t in tables.items()}
    assert {n for n in MADE if now[n] != may[n]} == {"stg_trafic_routier", "int_trafic_daily", "int_trafic_zoned"}
    assert all(t.version() == before[n] for n, t in tables.items() if "air" in n or "coord" in n or "arr" in n)


def test_new_days_are_read_from_their_months_only(spark, tmp_path):
    root = str(tmp_path)
    days = [f"2026-0{m}-01" for m in range(1, 7)]
    refresh_silver(spark, batch_of(spark, 1, dt.datetime(2026, 7, 1), bikes=[bike(d) for d in days]), root, SITES)
    table = nightly.silver_table(spark, root, "stg_trafic_velo")
    assert len(table.read().inputFiles()) == 6
    assert len(table.read([dt.date(2026, 3, 1)]).inputFiles()) == 1


def test_a_site_that_moves_changes_all_of_its_days(spark, tmp_path):
    first = batch_of(spark, 1, dt.datetime(2026, 7, 1), [measure(day="2026/05/01"), measure("S2")])
    refresh_silver(spark, first, str(tmp_path / "a"), SITES)
    moved = dataclasses.replace(first, sites=first.sites.withColumn("longitude", F.lit("7.5")))
    got = as_text(refresh_silver(spark, moved, str(tmp_path / "a"), SITES))
    assert got == full(spark, [moved], str(tmp_path / "b")) and got["int_air_quality_zoned"] == []


def test_what_a_check_refuses_is_not_published(spark, tmp_path):
    root = str(tmp_path)
    good = batch_of(spark, 1, dt.datetime(2026, 7, 1), [measure()], [bike()], [road()])
    bad = batch_of(spark, 2, dt.datetime(2026, 7, 2), [measure(day="2026/06/09")], [bike() | {"compteur_id": None}], [road()])
    run = dt.datetime(2026, 7, 3)
    exported = nightly.run_day(spark, good, root, run, sites=SITES, refresh=refresh_silver)
    assert exported["dm_velo_daily"].rows == 1
    before = as_text({n: nightly.silver_table(spark, root, n).read() for n in MADE})
    for hour in (1, 2):  # it is found again by the next run
        with pytest.raises(QualityError, match="raw_trafic_velo not_null:compteur_id: 1"):
            nightly.run_day(spark, together([good, bad]), root, run + dt.timedelta(hours=hour), sites=SITES, refresh=refresh_silver)
    assert as_text({n: nightly.silver_table(spark, root, n).read() for n in MADE}) == before
    mended = batch_of(spark, 2, dt.datetime(2026, 7, 2), [measure(day="2026/06/09")], [bike()], [road()])
    exported = nightly.run_day(
        spark, together([good, mended]), root, run + dt.timedelta(hours=3), sites=SITES, refresh=refresh_silver)
    assert exported["dm_air_quality_daily"].rows == 1 and exported["dm_velo_daily"].rows == 0


def test_a_run_lost_between_tables_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "a")
    batches = [batch_of(spark, 1, dt.datetime(2026, 7, 1), [measure()], [bike()], [road()]),
               batch_of(spark, 2, dt.datetime(2026, 7, 2), [measure(hour=5)], [bike(count="7")], [road(hour=3)])]
    refresh_silver(spark, batches[0], root, SITES)
    whole = increments.publish_checked

    def lost(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(increments, "publish_checked", lost)
    with pytest.raises(OSError, match="lost"):
        refresh_silver(spark, together(batches), root, SITES)
    monkeypatch.setattr(increments, "publish_checked", whole)
    got = as_text(refresh_silver(spark, together(batches), root, SITES))
    assert got == full(spark, batches, str(tmp_path / "b"))


def test_new_rows_are_not_scanned_for_the_last_batch(spark, tmp_path):
    """The pass that finds the loads finds the last batch, also of rows that have no day."""
    first = batch_of(spark, 1, dt.datetime(2026, 7, 1), bikes=[bike("2026-05-01", "4")])
    sc = spark.sparkContext
    sc.setJobGroup("new-rows", "")
    increments.new_rows(nightly.silver_table(spark, str(tmp_path), "stg_trafic_velo"), first.bikes)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert list(sc.statusTracker().getJobIdsForGroup("new-rows")) == []
    refresh_silver(spark, first, str(tmp_path), SITES)
    dayless = batch_of(spark, 2, dt.datetime(2026, 7, 2), bikes=[bike("2026-05-01", "9") | {"date": None}])
    got = refresh_silver(spark, together([first, dayless]), str(tmp_path), SITES)
    assert rows(got["stg_trafic_velo"].select("nb_passages")) == [(4,)]
    notes = nightly.silver_table(spark, str(tmp_path), "stg_trafic_velo").manifest().notes
    assert notes[increments.BATCH] == 2
