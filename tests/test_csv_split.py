"""One CSV file with quoted line breaks read by several tasks: the same rows as the plain reader."""

import csv
import random

import pytest

from snapmart.sources.files import read_csv, read_csv_split, read_csv_text

SCHEMA = "id bigint, note string, price double, name string"


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(["id", "note", "price", "name"])
        out.writerows(rows)


def table(seed, n):
    rng = random.Random(seed)
    notes = ["plain", "", 'a "quoted" word', "two\nlines", "\n\n", '"', '""\n"', "comma, here", "é\n日本", " spaced ", "x" * 700, "many\n" * 90]
    return [(i, rng.choice(notes), rng.choice([1.5, "", -2]), rng.choice(["n", "a,b", 'q"'])) for i in range(n)]


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_are_those_of_the_plain_reader(spark, small_ranges, tmp_path, as_rows, end):
    for k in range(3):
        write(tmp_path / f"{k}.csv", table(k, 400 * k), end)
    path = str(tmp_path)
    split = read_csv_split(spark, path, SCHEMA)
    assert split.columns == ["id", "note", "price", "name"]
    assert as_rows(split) == as_rows(read_csv(spark, path, SCHEMA)) and split.count() == 1200
    assert as_rows(read_csv_split(spark, path)) == as_rows(read_csv_text(spark, path))


def test_file_is_read_by_many_tasks(spark, small_ranges, tmp_path):
    write(tmp_path / "one.csv", [(i, "a\nb" * 3, 1, "n") for i in range(2000)])
    path = str(tmp_path)
    assert read_csv(spark, path, SCHEMA).rdd.getNumPartitions() == 1
    lines = spark.read.text(path).rdd.getNumPartitions()
    assert lines > 10 and read_csv_split(spark, path, SCHEMA).count() == 2000


def test_record_over_many_ranges_and_bad_values(spark, small_ranges, tmp_path, as_rows):
    write(tmp_path / "a.csv", [(1, "line\n" * 5000, 2, "n"), (2, "", 1, "m")])
    assert as_rows(read_csv_split(spark, str(tmp_path), SCHEMA)) == [(1, "line\n" * 5000, 2.0, "n"), (2, None, 1.0, "m")]
    write(tmp_path / "a.csv", [("x", "", 2, "n")])
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read_csv_split(spark, str(tmp_path), SCHEMA).collect()


def test_header_alone(spark, tmp_path):
    write(tmp_path / "a.csv", [])
    assert read_csv_split(spark, str(tmp_path), SCHEMA).count() == 0
