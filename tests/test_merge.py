import datetime as dt

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from citylode.operators.merge import merge_rows, upsert_table
from citylode.operators.watermark import Watermarks, delta_start, merge_marks
from citylode.operators.predicates import EPOCH
from citylode.operators.slots import SlotTable
from citylode.operators.versions import read_table

SCHEMA = "k int, day date, v int"
JAN, FEB = dt.date(2026, 1, 5), dt.date(2026, 2, 5)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_matched_rows_are_replaced_and_others_inserted(spark):
    target = frame(spark, [(1, JAN, 1), (2, JAN, 2)])
    source = frame(spark, [(2, JAN, 20), (3, JAN, 30)])
    assert rows(merge_rows(target, source, ["k", "day"])) == [(1, JAN, 1), (2, JAN, 20), (3, JAN, 30)]


def test_repeated_and_missing_keys_settle_the_same_way(spark):
    target = frame(spark, [(None, JAN, 1)])
    source = frame(spark, [(None, JAN, 2), (1, JAN, 5), (1, JAN, 7), (1, JAN, None)])
    once = merge_rows(target, source, ["k", "day"])
    assert rows(once) == rows(merge_rows(once, source, ["k", "day"])) == [(1, JAN, 7), (None, JAN, 2)]


row = st.tuples(st.integers(0, 6), st.just(JAN), st.integers(0, 9))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 6), st.integers(0, 9), max_size=6), st.lists(row, min_size=1, max_size=8))
def test_merging_twice_is_merging_once(spark, target, source):
    t = frame(spark, [(k, JAN, v) for k, v in target.items()])
    s = frame(spark, source)
    once = merge_rows(t, s, ["k", "day"])
    assert rows(merge_rows(once, s, ["k", "day"])) == rows(once)
    assert {r["k"] for r in once.collect()} == set(target) | {k for k, _, _ in source}


def stored(spark, path):
    return rows(read_table(spark, path).select("k", "day", "v"))


def test_upsert_rewrites_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "served")
    upsert_table(spark, path, frame(spark, [(1, JAN, 1), (1, FEB, 1), (2, FEB, 2)]), ["k", "day"], "day")

    def january():
        return sorted(p.name for p in (tmp_path / "served").glob("data/*/month=2026-01-01/*.parquet"))

    before = january()
    for _ in range(2):
        upsert_table(spark, path, frame(spark, [(2, FEB, 20), (3, FEB, 30)]), ["k", "day"], "day")
    assert stored(spark, path) == [(1, JAN, 1), (1, FEB, 1), (2, FEB, 20), (3, FEB, 30)]
    assert january() == before and len(before) == 1


def test_empty_source_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "served")
    upsert_table(spark, path, frame(spark, []), ["k", "day"], "day")
    assert read_table(spark, path) is None
    upsert_table(spark, path, frame(spark, [(1, JAN, 1)]), ["k", "day"], "day")
    upsert_table(spark, path, frame(spark, []), ["k", "day"], "day")
    assert stored(spark, path) == [(1, JAN, 1)]


def test_table_without_dates(spark, tmp_path):
    path = str(tmp_path / "reference")
    for data in ([(1, JAN, 1), (2, JAN, 2)], [(2, JAN, 9)]):
        upsert_table(spark, path, frame(spark, data), ["k"])
    assert stored(spark, path) == [(1, JAN, 1), (2, JAN, 9)]


def test_marks_default_advance_and_look_back(spark, tmp_path):
    log = Watermarks(spark, str(tmp_path / "marks"))
    assert log.get("a") == EPOCH and delta_start(log.get("a"), 5) == delta_start(None) == EPOCH
    log.advance({"a": JAN, "b": JAN})
    log.advance({"a": FEB})
    log.advance({})
    assert log.get("a") == FEB and log.get("b") == JAN
    assert delta_start(log.get("a"), 3) == FEB - dt.timedelta(days=3)
    assert rows(log.current()) == [("a", FEB), ("b", JAN)]


def test_marks_merge(spark):
    current = spark.createDataFrame([("a", JAN), ("b", JAN)], "dataset string, last_date date")
    updates = spark.createDataFrame([("b", FEB), ("c", FEB)], "dataset string, last_date date")
    assert rows(merge_marks(current, updates)) == [("a", JAN), ("b", FEB), ("c", FEB)]


def test_month_partitions_are_pruned(spark, tmp_path):
    from citylode.operators.predicates import after
    path = str(tmp_path / "served")
    upsert_table(spark, path, frame(spark, [(1, JAN, 1), (1, FEB, 1)]), ["k", "day"], "day")
    kept = after(read_table(spark, path), "day", dt.date(2026, 2, 1))
    assert [r["day"] for r in kept.collect()] == [FEB]
    formatted = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in formatted


def test_a_version_counts_only_once_noted(spark, tmp_path):
    table = SlotTable(spark, str(tmp_path / "small"))
    assert table.read() is None
    for v in range(1, 7):
        table.replace(frame(spark, [(1, JAN, v)]))
    assert table.version() == 6 and rows(table.read()) == [(1, JAN, 6)]
    frame(spark, [(1, JAN, 99)]).write.mode("overwrite").parquet(table.data_path(7))  # lost before its note
    assert rows(table.read()) == [(1, JAN, 6)]
    assert len(list((tmp_path / "small").glob("data-*"))) == SlotTable.SLOTS


def test_scratch_folder_is_the_session_s(spark):
    from citylode.session import scratch_path
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/citylode/x-")


def test_stored_rows_without_a_date_survive(spark, tmp_path):
    path = str(tmp_path / "t")
    for key in ("a", "c"):
        upsert_table(spark, path, spark.createDataFrame([(key, None)], "k string, d date"), ["k", "d"], "d")
    upsert_table(spark, path, spark.createDataFrame([("e", dt.date(2026, 1, 5))], "k string, d date"), ["k", "d"], "d")
    assert {(r["k"], r["d"]) for r in read_table(spark, path).collect()} == {
        ("a", None), ("c", None), ("e", dt.date(2026, 1, 5))}
