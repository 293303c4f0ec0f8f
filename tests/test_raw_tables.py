"""Raw tables are read from the test tables, in the columns that are used."""

from pathlib import Path

from citylode.catalog.queries import REGISTRY, City
from citylode.session import scratch_path
from conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"


def written(spark):
    return {p.name.rsplit("-", 1)[0] for p in Path(scratch_path(spark, "x")).parent.glob("*")}


def test_raw_rows_are_not_written_before_they_are_read(spark):
    before = written(spark)
    assert REGISTRY["serve_road_daily_avg"](spark, SF_DIR).count()
    assert "raw_trafic_routier" not in written(spark) - before


def test_a_reader_scans_only_what_its_columns_need(spark):
    plan = plan_of(City(spark, SF_DIR).raw("raw_trafic_routier").select("_loaded_at"))
    assert "l_shipdate" in plan and "l_orderkey" in plan
    assert "l_suppkey" not in plan and "l_returnflag" not in plan


def test_a_raw_table_without_repeated_rows_is_stored(spark):
    City(spark, SF_DIR).raw("raw_coordonnees")
    assert "raw_coordonnees" in written(spark)


def test_daily_and_zoned_tables_are_made_of_stored_ones(spark, monkeypatch):
    city = City(spark, SF_DIR)
    city.silver("stg_trafic_routier")
    monkeypatch.setattr(City, "raw", lambda self, name: 1 / 0)
    assert city.silver("int_trafic_daily").count()
    assert "arc_id" in city.silver("int_trafic_zoned").columns
