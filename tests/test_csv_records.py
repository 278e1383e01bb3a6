"""CSV records over line ends, malformed records and files, against Python's csv
reader; and the plan stays split."""

import csv
import gzip
import io
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline.sources import csvrecords as R
from tideline.session import path_exists
from tideline.sources.csvfiles import dataset_row_counts, read_csv_dataset, write_csv_dataset

VALUES = ["", None, "plain", 'say "hi"', "a,b", "two\nlines", "\n", "three\n\nlines, \"q\"\nend", " padded ", "é 日", '"', "x\r\ny"]


def _rows(n):
    return [(str(k), VALUES[k % len(VALUES)], VALUES[k * 7 % len(VALUES)]) for k in range(n)]


def _write(path, rows):
    out = io.StringIO()
    for r in [("Key", "First Text", "Second"), *rows]:
        out.write(",".join("" if v is None else '"' + v.replace('"', '""') + '"' for v in r) + "\n")
    path.write_bytes(out.getvalue().encode())


def _good(df):
    return sorted((tuple(r) for r in R.good_records(df).collect()), key=lambda r: int(r[0]))


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_across_lines_and_splits(spark, tmp_path, small_splits):
    rows = _rows(400)
    for k in range(3):
        _write(tmp_path / f"part-{k}.csv", rows[k::3])
    lines = R.read_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20           # three files, many tasks
    assert _good(R.read_csv_records(spark, str(tmp_path))) == rows


def test_what_is_written_comes_back(spark, tmp_path):
    rows = _rows(60)
    df = spark.createDataFrame(rows, "Key string, `First Text` string, Second string").repartition(3)
    for name, part in (("d.csv", df), ("plain.csv", df.where("Key % 12 = 2").select("Key", "First Text", "Key"))):
        path = str(tmp_path / name)
        if name == "plain.csv":
            part = part.toDF("Key", "First Text", "Second")
        write_csv_dataset(part, path)
        back = read_csv_dataset(spark, path)
        assert Counter(map(tuple, back.collect())) == Counter(map(tuple, part.collect()))
        assert path_exists(spark, f"{path}/_ONE_LINE") == (name == "plain.csv")
    assert {r.dataset: r.rows for r in dataset_row_counts(spark, str(tmp_path), "*.csv").collect()} == {"d": 60, "plain": 5}


def test_a_ragged_record_stops_the_plain_read(spark, tmp_path):
    for name, text in (("one.csv", "a,b\n1,2\n4,5,6\n"), ("two.csv", 'a,b\n"1\n2",2\n3\n')):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match="MALFORMED|wrong number"):
            read_csv_dataset(spark, str(tmp_path / name)).collect()


def test_python_reader_agrees(spark, tmp_path, small_splits):
    rows = [(a, b or "", c or "") for a, b, c in _rows(100)]
    _write(tmp_path / "x.csv", rows)
    with open(tmp_path / "x.csv", newline="") as f:
        want = [tuple(r) for r in csv.reader(f)][1:]
    assert _good(R.read_csv_records(spark, str(tmp_path / "x.csv"))) == want


def test_bad_records_and_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,x\n2\n3,y,z\n\n4,"q\nr"\n5,w\n')
    (tmp_path / "b.csv").write_text('k,v\n6,x\n7,"never closed\n8,x\n9,x\n')
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("k,v\n")
    (tmp_path / "e.csv.gz").write_bytes(b"this is no gzip file")
    with gzip.open(tmp_path / "f.csv.gz", "wt") as f:
        f.write("k,v\n10,x\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv", "d.csv", "e.csv.gz", "f.csv.gz")]
    df = R.read_csv_records(spark, paths)
    assert sorted(map(tuple, R.good_records(df).collect())) == [("1", "x"), ("10", "x"), ("4", "q\nr"), ("5", "w"), ("6", "x")]
    bad = {(r.file.rsplit("/", 1)[1], r.reason, r.text) for r in R.bad_records(df).collect()}
    assert bad == {("a.csv", R.RAGGED, "2"), ("a.csv", R.RAGGED, "3,y,z"), ("b.csv", R.UNCLOSED, '7,"never closed\n8,x\n9,x')}
    status = {r.file.rsplit("/", 1)[1]: (r.status, r.rows, r.bad_rows)
              for r in R.file_status(spark, [*paths, str(tmp_path / "none.csv")], df).collect()}
    assert status == {"a.csv": ("loaded", 3, 2), "b.csv": ("loaded", 1, 1), "c.csv": ("empty", 0, 0), "d.csv": ("empty", 0, 0),
                      "e.csv.gz": ("unreadable", 0, 0), "f.csv.gz": ("loaded", 1, 0), "none.csv": ("missing", 0, 0)}


def test_an_endless_record_is_set_aside_line_by_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,x\n2,"open\n' + "3,x\n" * 50)
    (tmp_path / "b.csv").write_text("k,v\n4,x\n")
    df = R.read_csv_records(spark, str(tmp_path), max_lines=20)
    assert sorted(map(tuple, R.good_records(df).collect())) == [("1", "x"), ("4", "x")]
    assert {r.reason for r in R.bad_records(df).collect()} == {R.TOO_LONG} and R.bad_records(df).count() == 51
