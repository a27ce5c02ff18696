"""Versioned days, the ledger of sources, and runs that arrive in parts."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapmart.operators import history, versions
from snapmart.operators.history import (
    add_rows,
    commit_part,
    commit_snapshot,
    read_history,
    replace_days,
    stored_day,
    stored_days,
    stored_state,
    taken_sources,
)
from snapmart.operators.latest import DAY
from snapmart.streaming.ingest import commit_days, commit_runs, ingest_available

DAY1, DAY2, DAY3 = (datetime(2024, 5, d, 6) for d in (1, 2, 3))


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "history")


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id bigint, inserted_at timestamp_ntz")


def priced(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id bigint, price double")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_open_reader_keeps_the_day_that_a_load_replaces(spark, path):
    replace_days(rows(spark, (1, DAY1), (2, DAY2)), path)
    before = read_history(spark, path)
    before.createOrReplaceTempView("open_history")
    replace_days(rows(spark, (3, DAY2)), path)
    assert ids(before) == [1, 2] and ids(spark.table("open_history")) == [1, 2]
    assert ids(read_history(spark, path)) == [1, 3]


def test_killed_commit_leaves_the_old_days(spark, path, monkeypatch):
    replace_days(rows(spark, (1, DAY1), (2, DAY2)), path)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(history, "write_state", killed)
        for commit in (lambda: replace_days(rows(spark, (8, DAY1), (9, DAY2)), path), lambda: add_rows(rows(spark, (7, DAY1)), path)):
            with pytest.raises(RuntimeError, match="killed"):
                commit()
    assert ids(read_history(spark, path)) == [1, 2]
    replace_days(rows(spark, (3, DAY2)), path)
    assert ids(read_history(spark, path)) == [1, 3]


def test_days_that_are_replaced_by_their_own_rows(spark, path):
    replace_days(rows(spark, (1, DAY1), (2, DAY1)), path)
    replace_days(read_history(spark, path).where("id = 2").drop(DAY), path)
    assert ids(read_history(spark, path)) == [2]


def test_faster_commit_fails_the_slower_one(spark, path):
    state = stored_state(spark, path)
    replace_days(rows(spark, (1, DAY1)), path)
    with pytest.raises(RuntimeError, match="another commit"):
        versions.write_state(spark, path, state)
    assert ids(read_history(spark, path)) == [1]


def test_history_without_versions_is_taken_over(spark, path):
    old = rows(spark, (1, DAY1), (2, DAY2)).withColumn(DAY, F.col("inserted_at").cast("date"))
    old.write.partitionBy(DAY).parquet(path)
    assert ids(read_history(spark, path)) == [1, 2]
    replace_days(rows(spark, (3, DAY2), (4, DAY3)), path)
    assert ids(read_history(spark, path)) == [1, 3, 4]
    assert ids(stored_day(spark, path, DAY1.date())) == [1]
    assert read_history(spark, path).schema[DAY].dataType.simpleString() == "date"


def test_unused_versions_are_removed_on_request(spark, path):
    for k in range(3):
        replace_days(rows(spark, (k, DAY1)), path)
    assert len(versions.remove_unused(spark, path, DAY)) == 2
    assert ids(read_history(spark, path)) == [2] and versions.remove_unused(spark, path, DAY) == []


def test_rows_without_a_time_stay(spark, path):
    commit = commit_days(path)
    commit(rows(spark, (1, None), (2, DAY1)), 0)
    commit(rows(spark, (3, None)), 1)
    found = read_history(spark, path)
    assert ids(found) == [1, 2, 3] and found.columns == ["id", "inserted_at", DAY]
    assert stored_days(spark, path) == [DAY1.date()]
    replace_days(rows(spark, (4, None)), path)
    assert ids(read_history(spark, path)) == [2, 4]


def test_batches_of_other_streams_with_the_same_number_are_kept(spark, path):
    commit_days(path)(rows(spark, (1, DAY1), (2, DAY1)), 0)
    commit_days(path)(rows(spark, (3, DAY1)), 0)
    commit_days(path)(rows(spark, (3, DAY1)), 0)  # a retry
    assert ids(read_history(spark, path)) == [1, 2, 3]


def land(spark, folder, name, *pairs):
    rows(spark, *pairs).coalesce(1).write.parquet(f"{folder}/{name}")


def test_each_file_is_taken_once_by_any_stream(spark, tmp_path, path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")

    def ingest(landing, checkpoint):
        stream = spark.readStream.schema("id bigint, inserted_at timestamp_ntz").parquet(f"{landing}/*")
        ingest_available(stream, commit_days(path), str(tmp_path / checkpoint))
        return ids(read_history(spark, path))

    land(spark, first, "a", (1, DAY1), (1, DAY1), (2, None))
    land(spark, second, "a", (1, DAY1), (3, DAY2))
    assert ingest(first, "c1") == [1, 1, 2]
    assert ingest(second, "c2") == [1, 1, 1, 2, 3]  # also batch 0, and an equal row
    assert ingest(first, "lost") == [1, 1, 1, 2, 3]  # a lost checkpoint reads all files again
    land(spark, first, "b", (4, DAY1))
    assert ingest(first, "lost again") == [1, 1, 1, 2, 3, 4]  # one file is new among known ones
    assert taken_sources(spark, path).count() == 3


def test_ledger_is_merged(spark, path, monkeypatch):
    monkeypatch.setattr(history, "LEDGER_PARTS", 2)
    commit = commit_days(path)
    for k in range(5):
        commit(rows(spark, (k, DAY1)), k)
        commit(rows(spark, (k, DAY1)), k)
    assert ids(read_history(spark, path)) == [0, 1, 2, 3, 4]
    assert len(stored_state(spark, path).ledger) <= 2 and taken_sources(spark, path).count() == 5


def test_unequal_run_is_judged_without_reading_rows(spark, path, monkeypatch):
    commit_snapshot(priced(spark, (1, 1.0)), path, DAY1, ["id"])

    def read(*_):
        raise AssertionError("rows were read")

    monkeypatch.setattr(history, "stored_day", read)
    assert commit_snapshot(priced(spark, (1, 2.0)), path, DAY2, ["id"]) is True
    assert commit_snapshot(priced(spark, (1, 3.0), (2, 3.0)), path, DAY2.replace(hour=8), ["id"]) is True
    with pytest.raises(AssertionError, match="rows were read"):  # equal facts are confirmed by the rows
        commit_snapshot(priced(spark, (2, 3.0), (1, 3.0)), path, DAY3, ["id"])


def content(spark, path):
    return sorted((r["inserted_at"].day, r["inserted_at"].hour, r["id"], r["price"]) for r in read_history(spark, path).collect())


def test_unchanged_run_in_two_parts_is_skipped(spark, path):
    commit_snapshot(priced(spark, (1, 1.0), (2, 6.0)), path, DAY1, ["id"])
    assert commit_part(priced(spark, (1, 1.0)), path, DAY2, ["id"]) is True  # a row less, so far
    for _ in range(2):
        assert commit_part(priced(spark, (2, 6.0)), path, DAY2, ["id"]) is False
        assert content(spark, path) == [(1, 6, 1, 1.0), (1, 6, 2, 6.0)]
    assert commit_part(priced(spark, (2, 7.0)), path, DAY2, ["id"]) is True  # a corrected part
    assert content(spark, path) == [(1, 6, 1, 1.0), (1, 6, 2, 6.0), (2, 6, 1, 1.0), (2, 6, 2, 7.0)]


def test_run_that_is_taken_back_gives_its_day_back(spark, path):
    commit_snapshot(priced(spark, (1, 1.0), (2, 6.0)), path, DAY1, ["id"])
    before = content(spark, path)
    later = DAY1.replace(hour=9)
    assert commit_part(priced(spark, (1, 1.0)), path, later, ["id"]) is True
    assert content(spark, path) == [(1, 9, 1, 1.0)]
    assert commit_part(priced(spark, (2, 6.0)), path, later, ["id"]) is False
    assert content(spark, path) == before
    assert commit_snapshot(priced(spark, (1, 1.0), (2, 6.0)), path, DAY2, ["id"]) is False


def test_parts_of_several_runs_of_a_day(spark, path):
    commit = commit_runs(path, ["id"])

    def part(run, *pairs):
        return priced(spark, *pairs).withColumn("run_ts", F.lit(run).cast("timestamp_ntz"))

    commit(part(DAY1, (1, 1.0)), 0)
    commit(part(DAY1.replace(hour=9), (1, 2.0)), 1)
    commit(part(DAY1, (2, 5.0)), 2)  # a late part of a run that a later one has replaced
    commit(part(DAY1.replace(hour=9), (2, 5.0)), 3)
    assert content(spark, path) == [(1, 9, 1, 2.0), (1, 9, 2, 5.0)]


def test_a_commit_is_a_folder_and_a_state(spark, path):
    replace_days(rows(spark, (1, DAY1)), path)
    names = sorted(p.name for p in Path(path).iterdir())
    assert names[0] == "_commits" and names[1].startswith("version=00000001-") and len(names) == 2


def test_a_run_is_computed_once_and_a_repeated_one_leaves_no_folder(spark, path):
    computed = spark.sparkContext.accumulator(0)

    def counted(x):
        computed.add(1)
        return x

    once = F.udf(counted, "bigint").asNondeterministic()
    batch = spark.range(10, numPartitions=2).select(once("id").alias("id"), F.lit(1.0).alias("price"))
    assert history.load_snapshot(batch, path, DAY1, ["id"]) == (True, 10)
    assert computed.value == 10
    names = sorted(p.name for p in Path(path).iterdir())
    assert history.load_snapshot(batch, path, DAY2, ["id"]) == (False, 10)
    assert computed.value == 20 and sorted(p.name for p in Path(path).iterdir()) == names
    assert ids(read_history(spark, path)) == list(range(10))


def test_runs_without_rows(spark, path):
    none = priced(spark, (1, 1.0)).limit(0)
    assert history.load_snapshot(none, path, DAY1, ["id"]) == (True, 0)
    assert history.load_snapshot(priced(spark, (1, 1.0)), path, DAY2, ["id"]) == (True, 1)
    assert history.load_snapshot(none, path, DAY3, ["id"]) == (True, 0)
    assert ids(read_history(spark, path)) == [1]
