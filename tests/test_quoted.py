"""Line breaks in quoted values, split by split, against a sequential parse."""

import csv
import io
import random

import pytest
from conftest import rows

from citylode.sources.files import read_delimited, split_corrupt
from citylode.sources.quoted import numbered_lines, read_quoted

COLUMNS = ["code", "text", "rest"]


@pytest.fixture
def split_size(spark):
    """Sets how many bytes a split has."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def set_size(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")
        spark.conf.set(names[2], "1")

    yield set_size
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def written(path, records):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=";", lineterminator="\n")
    writer.writerow(COLUMNS)
    writer.writerows(records)
    path.write_text(out.getvalue(), encoding="utf-8", newline="")
    return sorted(tuple(r) for r in list(csv.reader(io.StringIO(out.getvalue(), newline=""), delimiter=";"))[1:])


def parsed(spark, path):
    good, bad = split_corrupt(read_quoted(spark, str(path), COLUMNS))
    return sorted(tuple("" if v is None else v for v in r) for r in good.select(*COLUMNS).collect()), bad


@pytest.mark.parametrize("size", [16, 61, 1 << 20])
def test_records_equal_a_sequential_parse(spark, tmp_path, split_size, size):
    rng = random.Random(size)
    texts = ["plain", "two\nlines", 'a "quoted"\nword', "\n\n", "semi;colon", "", 'é"', "x" * 70 + "\n" + "y" * 70, "\nfirst", "last\n"]
    want = []
    for name in ("a.csv", "b.csv"):
        want += written(tmp_path / name, [(f"{name}{i}", rng.choice(texts), rng.choice(texts)) for i in range(40)])
    split_size(size)
    got, bad = parsed(spark, tmp_path)
    assert got == sorted(want) and bad.count() == 0
    if size == 61:
        splits = numbered_lines(spark, str(tmp_path), "run").select("file", "block").distinct().count()
        assert splits > 40 and numbered_lines(spark, str(tmp_path), "run").rdd.getNumPartitions() > 40


def test_files_without_quotes_read_as_before(spark, tmp_path, split_size):
    written(tmp_path / "a.csv", [(str(i), f"t{i}", "") for i in range(30)])
    (tmp_path / "b.csv").write_text("h;h;h\r\n1;2\r\n\r\n4;5;6\r\n")
    split_size(50)
    scans = (read_quoted(spark, str(tmp_path), COLUMNS), read_delimited(spark, str(tmp_path), COLUMNS))
    (good, bad), (want_good, want_bad) = (split_corrupt(s) for s in scans)
    assert rows(good.select(*COLUMNS)) == rows(want_good.select(*COLUMNS))
    assert rows(bad.select("_corrupt_record", "fields_present")) == rows(want_bad.select("_corrupt_record", "fields_present"))


def test_one_long_value_over_many_splits(spark, tmp_path, split_size):
    text = "\n".join(f"line {i}" for i in range(500))
    want = written(tmp_path / "a.csv", [("1", text, "z"), ("2", "short", "z")])
    split_size(32)
    got, bad = parsed(spark, tmp_path)
    assert got == want and bad.count() == 0


def test_odd_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("code;text;rest\n")
    (tmp_path / "open.csv").write_text('code;text;rest\n1;a;b\n2;"never closed;x\n3;c;d\n')
    got, bad = parsed(spark, tmp_path)
    assert ("1", "a", "b") in got and len(got) + bad.count() == 2
