import json
import os
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from citylode.plans import silver
from citylode.schemas import BIKE_COLUMNS, POLLED_STATION, SITE_COLUMNS
from citylode.sources.files import read_delimited, split_corrupt, split_documents
from citylode.sources.topic import decode, read_message_files, read_topic
from citylode.streaming import ingest
from citylode.streaming.station_state import (
    ChangeTable, StateTable, follow, follow_changes, latest_states, newest_by_station, to_messages,
)


def put(folder, name, text, at=None):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    if at:
        os.utime(folder / name, (at, at))


def test_files_are_loaded_once_across_restarts(spark, tmp_path):
    landed, work = tmp_path / "landed", str(tmp_path / "work")

    def run():
        ingest.load_new_files(
            ingest.stream_delimited(spark, str(landed), SITE_COLUMNS), work + "/raw", work + "/bad", work + "/checkpoint")
        return rows(ingest.loaded(spark, work + "/raw").select("code_site"))

    put(landed / "2026/06/08/07/00", "a.csv", "h;h;h\na;1;2\nbroken\n")
    assert run() == [("a",)]
    assert run() == [("a",)]
    put(landed / "2026/06/09/07/00", "b.csv", "h;h;h\nb;1;2\n")
    assert run() == [("a",), ("b",)]
    assert rows(spark.read.parquet(work + "/bad").select("_corrupt_record")) == [("broken",)]


def test_a_new_checkpoint_loads_nothing_again_and_loses_nothing(spark, tmp_path):
    landed, work = tmp_path / "landed", str(tmp_path / "work")

    def run(checkpoint):
        ingest.load_new_files(
            ingest.stream_delimited(spark, str(landed), SITE_COLUMNS, files_per_batch=1), work + "/raw", work + "/bad",
            f"{work}/checkpoint-{checkpoint}")
        return rows(ingest.loaded_batches(spark, work + "/raw").select("code_site", "batch"))

    assert ingest.loaded(spark, work + "/raw") is None
    put(landed / "2026/06/08/07/00", "a.csv", "h;h;h\na;1;2\nbroken\n", at=1_700_000_000)
    put(landed / "2026/06/08/08/00", "b.csv", "h;h;h\nb;1;2\n", at=1_700_000_100)
    assert run(1) == [("a", 1), ("b", 2)]
    assert run(2) == [("a", 1), ("b", 2)]
    put(landed / "2026/06/09/07/00", "c.csv", "h;h;h\nc;1;2\n", at=1_703_000_000)
    assert run(3) == [("a", 1), ("b", 2), ("c", 3)]
    # A file that is replaced is another file.
    put(landed / "2026/06/09/07/00", "c.csv", "h;h;h\nc;1;2\nd;1;2\n", at=1_703_000_100)
    assert run(4) == [("a", 1), ("b", 2), ("c", 3), ("c", 4), ("d", 4)]
    assert rows(spark.read.parquet(work + "/bad").select("_corrupt_record")) == [("broken",)]
    entries = ingest.Ledger(spark, work + "/raw").entries.read()
    assert rows(entries.select("batch", "_file_size")) == [(1, 19), (2, 12), (3, 12), (4, 18)]


def test_rows_of_a_batch_that_was_not_published_do_not_count(spark, tmp_path, monkeypatch):
    landed, work = tmp_path / "landed", str(tmp_path / "work")

    def run(checkpoint):
        ingest.load_new_files(
            ingest.stream_delimited(spark, str(landed), SITE_COLUMNS), work + "/raw", work + "/bad", f"{work}/{checkpoint}")

    def codes():
        found = ingest.loaded(spark, work + "/raw")
        return found and rows(found.select("code_site"))

    put(landed, "a.csv", "h;h;h\na;1;2\n")
    add = ingest.Ledger.add

    def killed(*_):
        raise OSError("killed")

    monkeypatch.setattr(ingest.Ledger, "add", killed)
    with pytest.raises(Exception, match="killed"):
        run("one")
    assert codes() is None
    monkeypatch.setattr(ingest.Ledger, "add", add)
    put(landed, "b.csv", "h;h;h\nb;1;2\n")
    run("one")
    run("two")
    assert codes() == [("a",), ("b",)]


def test_files_of_a_batch_that_are_partly_known(spark, tmp_path):
    landed, work = tmp_path / "landed", str(tmp_path / "work")
    for checkpoint, name in (("one", "a"), ("two", "b")):
        put(landed, f"{name}.csv", f"h;h;h\n{name};1;2\n")
        ingest.load_new_files(
            ingest.stream_delimited(spark, str(landed), SITE_COLUMNS), work + "/raw", work + "/bad", f"{work}/{checkpoint}")
    assert rows(ingest.loaded(spark, work + "/raw").select("code_site")) == [("a",), ("b",)]


def test_only_files_that_are_not_known_are_opened(spark, tmp_path):
    landed, work, opened = tmp_path / "landed", str(tmp_path / "work"), []

    def run(checkpoint):
        stream = ingest.stream_delimited(spark, str(landed), SITE_COLUMNS)
        noted = replace(stream, scan=lambda paths: opened.extend(paths) or stream.scan(paths))
        ingest.load_new_files(noted, work + "/raw", work + "/bad", f"{work}/{checkpoint}")
        return rows(ingest.loaded(spark, work + "/raw").select("code_site"))

    put(landed / "2026/06/08/07/00", "a[1] {x}*.csv", "h;h;h\na;1;2\n")
    put(landed / "2026/06/08/07/00", "a1 x.csv", "h;h;h\nb;1;2\n")
    put(landed / "2026/06/08/07/00", "empty.csv", "")
    assert run(1) == [("a",), ("b",)] and len(opened) == 2
    assert run(2) == [("a",), ("b",)] and len(opened) == 2
    put(landed / "2026/06/09/07/00", "c.csv", "h;h;h\nc;1;2\nbroken\n")
    assert run(3) == [("a",), ("b",), ("c",)] and len(opened) == 3
    assert rows(spark.read.parquet(work + "/bad").select("_corrupt_record")) == [("broken",)]


def test_json_arrays_and_documents_are_loaded_once_across_checkpoints(spark, tmp_path):
    landed, work = tmp_path / "landed", str(tmp_path / "work")
    put(landed / "stations/2026/06/08/07/00", "1.json", json.dumps([
        {"stationcode": "1", "name": "A", "capacity": 3, "coordonnees_geo": {"lat": 48.5, "lon": 2.5}}, {"stationcode": "2"}]))
    put(landed / "stations/2026/06/08/07/00", "2.json", "no json")
    put(landed / "zones/2026/06/08/07/00", "1.json", '{"features": [1]}')
    put(landed / "zones/2026/06/08/07/00", "2.json", "{broken")
    put(landed / "zones/2026/06/08/07/00", "3.json", " ")

    def run(checkpoint):
        ingest.load_new_files(
            ingest.stream_stations(spark, f"{landed}/stations"), work + "/s", work + "/s-bad", f"{work}/s-{checkpoint}")
        ingest.load_new_files(
            ingest.stream_documents(spark, f"{landed}/zones"), work + "/z", work + "/z-bad", f"{work}/z-{checkpoint}",
            split_documents)

    for checkpoint in (1, 2):
        run(checkpoint)
        stations = ingest.loaded(spark, work + "/s")
        assert rows(stations.select("stationcode", "capacity", "coordonnees_geo_lat")) == [("1", "3", "48.5"), ("2", None, None)]
        assert {str(r[0]) for r in stations.select("_loaded_at").collect()} == {"2026-06-08 07:00:00"}
        assert rows(spark.read.parquet(work + "/s-bad").select("_corrupt_record")) == [("no json",)]
        assert rows(ingest.loaded(spark, work + "/z").selectExpr("to_json(raw_geojson)")) == [('{"features":[1]}',)]
        bad = spark.read.parquet(work + "/z-bad").select("_corrupt_record", F.substring_index("_file_name", "/", -1))
        assert rows(bad) == [(" ", "3.json"), ("{broken", "2.json")]


def test_streamed_loads_give_the_marts_of_a_batch_scan(spark, tmp_path):
    """Two files of one run and day: both count, as they do when they are scanned together."""
    landed, work = tmp_path / "landed", str(tmp_path / "work")
    line = ";".join(["{}", "C", "s", "n", "5", "2026-06-08T08:00:00", "", "", "0.5, 0.5", *[""] * 7])
    head = ";".join(BIKE_COLUMNS)
    put(landed / "2026/06/08/07/00", "a.csv", f"{head}\n{line.format('c1')}\n", at=1_700_000_000)
    put(landed / "2026/06/08/07/00", "b.csv", f"{head}\n{line.format('c2')}\n", at=1_700_000_900)
    ingest.load_new_files(
        ingest.stream_delimited(spark, str(landed), BIKE_COLUMNS, files_per_batch=1), work + "/raw", work + "/bad", work + "/c")
    streamed = silver.bike_daily(silver.bike_counts(ingest.loaded(spark, work + "/raw")))
    scanned = silver.bike_daily(silver.bike_counts(split_corrupt(read_delimited(spark, f"{landed}/*/*/*/*/*", BIKE_COLUMNS))[0]))
    assert rows(streamed) == rows(scanned) and streamed.count() == 2


def message(station, at, bikes):
    return json.dumps({"stationId": station, "timestamp": at, "num_bikes_available": bikes, "latitude": 48.5})


def test_an_older_state_never_replaces_a_newer_one(spark, tmp_path):
    topic, work = tmp_path / "topic", str(tmp_path / "work")
    table = StateTable(spark, work + "/state")

    def run():
        follow(decode(read_message_files(spark, str(topic))), table, work + "/bad", work + "/checkpoint")
        return rows(table.read().select("stationId", "timestamp", "num_bikes_available"))

    assert table.read() is None
    put(topic, "1.txt", "\n".join([message("s", "T2", 5), message("t", "T1", 1), message("", "T9", 9), message(None, "T9", 9)]))
    assert run() == [("s", "T2", 5), ("t", "T1", 1)]
    put(topic, "2.txt", "\n".join([message("s", "T1", 9), message("t", "T3", 3), "not json"]))
    assert run() == [("s", "T2", 5), ("t", "T3", 3)]
    assert run() == [("s", "T2", 5), ("t", "T3", 3)]
    assert rows(spark.read.option("recursiveFileLookup", True).parquet(work + "/bad")) == [("not json",)]


def test_changed_stations_are_written_and_no_others(spark, tmp_path):
    topic, work = tmp_path / "topic", str(tmp_path / "work")
    table = ChangeTable(spark, work + "/state", merge_after=4)
    columns = ["stationId", "timestamp", "num_bikes_available"]

    def run(checkpoint):
        follow_changes(decode(read_message_files(spark, str(topic))), table, f"{work}/{checkpoint}")
        return rows(table.read().select(*columns))

    assert table.read() is None
    put(topic, "1.txt", "\n".join([message("s", "T2", 5), message("t", "T1", 1), message("", "T9", 9), "not json"]), at=1_700_000_000)
    assert run("one") == [("s", "T2", 5), ("t", "T1", 1)]
    put(topic, "2.txt", "\n".join([message("s", "T1", 9), message("t", "T3", 3), message("u", "T1", 0)]), at=1_700_000_100)
    assert run("one") == [("s", "T2", 5), ("t", "T3", 3), ("u", "T1", 0)]
    put(topic, "3.txt", message("u", "T4", 8), at=1_700_000_200)
    assert run("one") == [("s", "T2", 5), ("t", "T3", 3), ("u", "T4", 8)]
    sizes = [spark.read.parquet(folder).count() for folder in table.changes()]
    assert sizes == [2, 3, 1]  # the second batch has met s again, the third only u
    # A new checkpoint starts over; the changes are merged, and nothing goes back in time.
    assert run("two") == [("s", "T2", 5), ("t", "T3", 3), ("u", "T4", 8)]
    assert table.base.version() == 1 and table.changes() == []
    put(topic, "4.txt", message("s", "T0", 7), at=1_700_000_300)
    assert run("three") == [("s", "T2", 5), ("t", "T3", 3), ("u", "T4", 8)]


def test_the_aggregate_settles_ties_as_the_window_does(spark):
    data = [("s", t, b, d, p) for t in ("T1", "T2", None) for b in (1, 2, None) for d in (3, None) for p in (1.0, 2.0)]
    states = spark.createDataFrame(data, "stationId string, timestamp string, num_bikes_available bigint, "
                                   "num_docks_available bigint, position double")
    for part in (states, states.filter("timestamp is null"), states.filter("timestamp = 'T1' and position = 1")):
        assert rows(newest_by_station(part).select(part.columns)) == rows(latest_states(part).select(part.columns))


def test_equal_times_are_settled_by_position(spark, tmp_path):
    topic, work = tmp_path / "topic", str(tmp_path / "work")
    put(topic, "1.txt", message("s", "T1", 1), at=1_700_000_000)
    put(topic, "2.txt", message("s", "T1", 2), at=1_700_000_100)
    table = StateTable(spark, work + "/state")
    follow(decode(read_message_files(spark, str(topic))), table, work + "/bad", work + "/checkpoint")
    assert table.read().first()["num_bikes_available"] == 2


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"))
    batch = decode(spark.createDataFrame(
        [(message("s", "T1", 1), 1.0), (message("s", "T2", 2), 2.0)], "value string, position double")).drop("bad_message")
    table.put(batch)
    once = rows(table.read())
    table.put(batch)
    assert rows(table.read()) == once and table.table.version() == 2


def test_polled_records_share_the_cycle_time(spark):
    polled = spark.createDataFrame(
        [("1", 3, 4, 1, 2, "Area", (48.8, 2.3)), ("2", None, None, None, None, None, None)], POLLED_STATION)
    got = to_messages(polled, F.lit("T1"))
    assert rows(got.select("stationId", "timestamp", "num_bikes_available", "latitude", "longitude")) == [
        ("1", "T1", 3, 48.8, 2.3), ("2", "T1", None, None, None)]
    assert latest_states(got.withColumn("position", F.lit(1.0))).count() == 2


def test_topic_scan_needs_its_connector(spark):
    try:
        stream = read_topic(spark, "broker:9092", "states")
    except Exception as problem:
        if "kafka" not in str(problem).lower():
            raise
        pytest.skip("Kafka connector absent")
    assert stream.columns == ["value", "position"] and stream.isStreaming


def test_messages_that_are_no_states_are_kept_apart(spark):
    texts = ["[1,2]", "5", "null", "not json", '{"stationId":"2","num_bikes_available":"x"}', None, message("s", "T1", 1)]
    got = decode(spark.createDataFrame([(t, float(i)) for i, t in enumerate(texts)], "value string, position double"))
    states = {r["position"]: (r["bad_message"], r["stationId"]) for r in got.collect()}
    assert [i for i, (bad, _) in states.items() if bad is None] == [6.0] and states[6.0][1] == "s"
    assert all(station is None for bad, station in states.values() if bad is not None)
