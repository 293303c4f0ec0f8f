import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from citylode.operators import versions
from citylode.operators.merge import upsert_table
from citylode.operators.versions import ConcurrentCommit, VersionedTable, in_months, months_in, read_table

SCHEMA = "k int, day date, v int"
JAN, FEB, MAR = dt.date(2026, 1, 5), dt.date(2026, 2, 5), dt.date(2026, 3, 5)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def content(df):
    return rows(df.select("k", "day", "v"))


def folders(path, kind="data"):
    return sorted(p.name for p in (path / kind).glob("commit=*"))


def test_a_commit_replaces_the_months_it_names(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), "day")
    assert table.read() is None and table.version() == 0
    table.commit(frame(spark, [(1, JAN, 1), (2, FEB, 2), (3, None, 3)]))
    table.commit(frame(spark, [(2, FEB, 20)]), [FEB.replace(day=1), MAR.replace(day=1)])
    assert content(table.read()) == [(1, JAN, 1), (2, FEB, 20), (3, None, 3)]
    table.commit(frame(spark, []), [None, FEB.replace(day=1)])
    assert content(table.read()) == [(1, JAN, 1)] and table.version() == 3
    assert content(table.read([FEB.replace(day=1)])) == []
    with pytest.raises(ValueError, match="month=2026-03"):
        table.commit(frame(spark, [(9, MAR, 9)]), [JAN.replace(day=1)])
    assert content(table.read()) == [(1, JAN, 1)]
    table.commit(frame(spark, []))
    assert content(table.read()) == [] and table.read().columns == ["k", "day", "v", "month"]


def test_a_reader_sees_one_whole_version_while_the_table_is_refreshed(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), "day")
    old = table.commit(frame(spark, [(1, JAN, 1), (2, FEB, 2)]))
    new = table.commit(frame(spark, [(1, JAN, 10), (2, FEB, 20), (3, MAR, 30)]))
    assert content(old) == [(1, JAN, 1), (2, FEB, 2)] and content(new) == [(1, JAN, 10), (2, FEB, 20), (3, MAR, 30)]
    # A version derived from the current one may replace it.
    table.commit(new.withColumn("v", F.col("v") + 1))
    assert content(table.read()) == [(1, JAN, 11), (2, FEB, 21), (3, MAR, 31)]


@pytest.mark.parametrize("dated", [True, False])
def test_a_writer_killed_half_way_changes_nothing(spark, tmp_path, dated):
    table = VersionedTable(spark, str(tmp_path), "day" if dated else None)
    table.commit(frame(spark, [(1, JAN, 1), (2, FEB, 2)]))
    bad = frame(spark, [(k, JAN, k) for k in range(200)]).withColumn(
        "v", F.when(F.col("k") == 150, F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        table.commit(bad)
    assert content(table.read()) == [(1, JAN, 1), (2, FEB, 2)]
    # Killed while it wrote the manifest.
    (tmp_path / "manifest" / "000000000002.json").write_text('{"version": 2, "par')
    assert content(table.read()) == [(1, JAN, 1), (2, FEB, 2)] and table.version() == 1
    table.commit(frame(spark, [(3, MAR, 3)]))
    assert content(table.read()) == [(3, MAR, 3)] and table.version() == 3
    assert len(folders(tmp_path)) == 2  # what the killed writer left is gone


def test_old_folders_are_collected_once_no_kept_version_names_them(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), "day", keep=2)
    table.commit(frame(spark, [(1, JAN, 1), (2, FEB, 2)]))
    for v in range(4):
        table.commit(frame(spark, [(2, FEB, v)]), [FEB.replace(day=1)])
    assert content(table.read()) == [(1, JAN, 1), (2, FEB, 3)]
    assert len(list((tmp_path / "manifest").glob("*.json"))) == 2
    assert len(folders(tmp_path)) == 3  # January of the first commit, February of the last two
    assert sorted(p.name for p in next((tmp_path / "data").glob("commit=1-*")).glob("month=*")) == ["month=2026-01-01"]


def test_a_second_writer_fails_and_the_first_stays(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path), "day")
    table.commit(frame(spark, [(1, JAN, 1)]))
    whole = versions.create_text

    def overtaken(session, path, text):
        monkeypatch.setattr(versions, "create_text", whole)
        VersionedTable(session, str(tmp_path), "day").commit(frame(spark, [(2, FEB, 2)]))
        return whole(session, path, text)

    monkeypatch.setattr(versions, "create_text", overtaken)
    with pytest.raises(ConcurrentCommit):
        table.commit(frame(spark, [(3, MAR, 3)]))
    assert content(table.read()) == [(2, FEB, 2)]


def test_notes_and_sides_are_published_with_the_rows(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), "day")
    table.commit(frame(spark, [(1, JAN, 1)]), notes={"batch": 1}, sides={"days": frame(spark, [(7, JAN, 7)])})
    table.annotate(notes={"other": 2})
    assert table.manifest().notes == {"batch": 1, "other": 2} and content(table.side("days")) == [(7, JAN, 7)]
    table.annotate(sides={"days": frame(spark, [(8, FEB, 8)])})
    assert content(table.side("days")) == [(8, FEB, 8)] and table.side("none") is None
    assert content(table.read()) == [(1, JAN, 1)]
    assert json.loads((tmp_path / "manifest" / "000000000003.json").read_text())["version"] == 3


def test_months_of_a_table_are_pruned(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), "day")
    table.commit(frame(spark, [(1, JAN, 1), (2, FEB, 2), (3, None, 3)]))
    assert set(months_in(table.read())) == {JAN.replace(day=1), FEB.replace(day=1), None}
    kept = table.read().filter(in_months("month", [JAN.replace(day=1), None]))
    assert content(kept) == [(1, JAN, 1), (3, None, 3)]
    assert "PartitionFilters: [((" in kept._jdf.queryExecution().executedPlan().toString()


def test_an_upsert_is_a_version(spark, tmp_path):
    path = str(tmp_path / "served")
    upsert_table(spark, path, frame(spark, [(1, JAN, 1), (2, JAN, 2)]), ["k", "day"], "day")
    old = read_table(spark, path)
    bad = frame(spark, [(1, JAN, 5)]).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        upsert_table(spark, path, bad, ["k", "day"], "day")
    upsert_table(spark, path, frame(spark, [(2, JAN, 20), (3, FEB, 3)]), ["k", "day"], "day")
    assert content(old) == [(1, JAN, 1), (2, JAN, 2)]
    assert content(read_table(spark, path)) == [(1, JAN, 1), (2, JAN, 20), (3, FEB, 3)]
