import datetime as dt

import pytest
from conftest import rows

from citylode.operators.quality import (
    WARN, Accepted, AtMost, NotAfter, NotNull, QualityError, Unique, gate, run_checks,
)
from citylode.plans.checks import silver_checks

D = dt.date(2026, 6, 8)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("a", "x", D, 20), ("a", "y", D, 5), (None, "z", D, 25), ("b", None, dt.date(2027, 1, 1), 1)],
        "k string, label string, day date, hours int")


def test_each_check_counts_its_failures(table):
    checks = [
        NotNull("t", "k"), NotNull("t", "label", WARN), NotAfter("t", "day", D), AtMost("t", ("hours", "hours"), 40),
        Unique("t", ("k",)), Unique("t", ("k", "label")), Accepted("t", "label", ("x",), WARN)]
    report = {r["check_name"]: (r["severity"], r["failures"]) for r in run_checks({"t": table}, checks).collect()}
    assert report == {
        "not_null:k": ("error", 1), "not_null:label": ("warn", 1), "not_future:day": ("error", 1),
        "at_most:hours+hours": ("error", 1), "unique:k": ("error", 1), "unique:k|label": ("error", 0),
        "accepted_values:label": ("warn", 2)}


def test_only_errors_stop_a_run(table):
    gate(run_checks({"t": table}, [NotNull("t", "k", WARN), NotNull("t", "hours")]))
    with pytest.raises(QualityError, match="not_null:k: 1"):
        gate(run_checks({"t": table}, [NotNull("t", "k")]))


def test_row_checks_of_a_table_share_a_pass(table):
    report = run_checks({"t": table}, [NotNull("t", "k"), NotNull("t", "label"), AtMost("t", ("hours",), 24)])
    assert rows(report.select("failures")) == [(1,), (1,), (1,)]
    assert report._jdf.queryExecution().executedPlan().toString().count("ExistingRDD") == 1


def test_all_checks_of_a_table_share_a_pass(table):
    report = run_checks({"t": table}, [
        NotNull("t", "k"), Unique("t", ("k",)), Unique("t", ("k", "label")), Accepted("t", "label", ("x",), WARN)])
    assert rows(report.select("failures")) == [(0,), (1,), (1,), (2,)]
    assert report._jdf.queryExecution().executedPlan().toString().count("ExistingRDD") == 1


def test_checks_of_an_empty_table(spark, table):
    report = run_checks({"t": table.limit(0)}, [
        NotNull("t", "k"), Unique("t", ("k",)), Accepted("t", "label", ("x",)), AtMost("t", ("hours",), 1)])
    assert rows(report.select("failures")) == [(0,)] * 4
    assert rows(run_checks({"t": table.limit(0)}, [NotNull("t", "k")]).select("failures")) == [(0,)]


def test_repeated_sites_and_unreadable_coordinates_are_counted(spark):
    sites = spark.createDataFrame(
        [("S1", "48.8", "2.3"), ("S1", "48.9", "2.3"), ("S2", "north", "2,3"), (None, "", None)],
        "code_site string, latitude string, longitude string").selectExpr("*", "'f' as _file_name", "now() as _loaded_at")
    roads = spark.createDataFrame(
        [("r1", "48.8, 2.3"), ("r2", "48.8"), ("r3", "bad, 2.3"), ("r4", " "), ("r5", None)], "iu_ac string, geo_point_2d string"
    ).selectExpr("*", "'x' as t_1h", "'Dense' as etat_trafic", "'f' as _file_name", "now() as _loaded_at")
    tables = {"raw_coordonnees": sites, "raw_trafic_routier": roads}
    found = {(r["table_name"], r["check_name"]): (r["severity"], r["failures"])
             for r in run_checks(tables, silver_checks(tables)).collect()}
    assert found["raw_coordonnees", "unique:code_site"] == ("error", 1)
    assert found["raw_coordonnees", "not_null:code_site"] == ("error", 1)
    assert found["raw_coordonnees", "readable:latitude"] == ("warn", 1)
    assert found["raw_coordonnees", "readable:longitude"] == ("warn", 1)
    assert found["raw_trafic_routier", "readable:geo_point_2d"] == ("warn", 2)


def test_declared_checks():
    from citylode.plans.checks import DATED, KEYS, LABELS, REQUIRED
    assert sum(map(len, REQUIRED.values())) >= 60 and len(KEYS) == 7 and len(LABELS) == 4
    assert {c.table for c in silver_checks(REQUIRED)} == set(REQUIRED)
    assert len([c for c in silver_checks(REQUIRED) if isinstance(c, NotAfter)]) == len(DATED)
