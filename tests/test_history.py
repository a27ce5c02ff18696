import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from snapmart.operators.compare import row_difference, same_fingerprint, same_rows
from snapmart.operators.history import (
    adopt_unstamped,
    append_by_name,
    backfill_stamp,
    commit_snapshot,
    newest_snapshot,
    read_history,
    replace_days,
    replace_same_day,
    stamp,
)
from snapmart.streaming.ingest import commit_days, commit_runs, ingest_available

DAY1, DAY2, DAY3 = datetime(2024, 5, 1, 6), datetime(2024, 5, 2, 6), datetime(2024, 5, 3, 6)
SCHEMA = "id bigint, price decimal(30,10), note string"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "history")



def make(spark, *pairs):
    from decimal import Decimal

    return spark.createDataFrame([(i, Decimal(str(p)) if p is not None else None, n) for i, p, n in pairs], SCHEMA)


def stamps(history):
    return sorted((r["inserted_at"], r["n"]) for r in history.groupBy("inserted_at").agg(F.count("*").alias("n")).collect())


def test_same_rows_ignores_order_and_counts_copies(spark):
    one = make(spark, (1, 1.5, "a"), (2, None, None), (2, None, None))
    reordered = make(spark, (2, None, None), (1, 1.5, "a"), (2, None, None)).repartition(3)
    fewer_copies = make(spark, (1, 1.5, "a"), (1, 1.5, "a"), (2, None, None))
    assert same_rows(one, reordered).first()["same"] is True
    assert same_fingerprint(one, reordered) and not same_fingerprint(one, fewer_copies)
    assert same_rows(one, fewer_copies).first()["same"] is False
    assert same_rows(one, one.drop("note")).first()["same"] is False
    assert sorted(r["surplus"] for r in row_difference(one, fewer_copies).collect()) == [-1, 1]


def test_unchanged_run_is_skipped_in_any_order(spark, path):
    assert commit_snapshot(make(spark, (1, 1, "a"), (2, None, "b")), path, DAY1, ["id"]) is True
    assert commit_snapshot(make(spark, (2, None, "b"), (1, 1, "a")).repartition(2), path, DAY2, ["id"]) is False
    assert stamps(read_history(spark, path)) == [(DAY1, 2)]


def test_changed_run_is_appended_and_same_day_replaced(spark, path):
    commit_snapshot(make(spark, (1, 1, "a")), path, DAY1, ["id"])
    commit_snapshot(make(spark, (1, 2, "a"), (2, 2, "b")), path, DAY2, ["id"])
    later = DAY2.replace(hour=18)
    commit_snapshot(make(spark, (1, 3, "a")), path, later, ["id"])
    assert stamps(read_history(spark, path)) == [(DAY1, 1), (later, 1)]


def test_rerun_of_the_same_day_with_equal_data_is_a_no_op(spark, path):
    commit_snapshot(make(spark, (1, 1, "a")), path, DAY1, ["id"])
    assert commit_snapshot(make(spark, (1, 1, "a")), path, DAY1.replace(hour=9), ["id"]) is False
    assert stamps(read_history(spark, path)) == [(DAY1, 1)]


def test_return_to_an_older_state_is_a_change(spark, path):
    for day, price in ((DAY1, 1), (DAY2, 2), (DAY3, 1)):
        assert commit_snapshot(make(spark, (1, price, "a")), path, day, ["id"]) is True
    assert len(stamps(read_history(spark, path))) == 3


def test_new_or_missing_key_column_is_a_change(spark, path, as_rows):
    commit_snapshot(make(spark, (1, 1, "a")), path, DAY1, ["id"])
    wider = make(spark, (1, 1, "a")).withColumn("extra", F.lit(5))
    assert commit_snapshot(wider, path, DAY2, ["id"]) is True
    assert newest_snapshot(spark, path).columns == ["id", "price", "note", "extra"]
    merged = read_history(spark, path, merge=True)
    assert as_rows(merged, "id", "extra") == [(1, 5), (1, None)]
    assert commit_snapshot(wider, path, DAY3, ["no_such_key"]) is True
    assert commit_snapshot(wider, path, DAY3, []) is True  # nothing to compare by


def test_stamp_has_seconds(spark):
    stamped = stamp(spark.range(1), datetime(2024, 1, 1, 1, 2, 3, 999))
    assert stamped.first()["inserted_at"] == datetime(2024, 1, 1, 1, 2, 3)
    assert backfill_stamp(stamped, DAY1) is stamped


def test_first_history_without_stamp_is_kept(spark, path):
    old = make(spark, (1, 1, "old"), (7, 7, "old"))
    adopt_unstamped(old, make(spark, (1, 2, "new")), path, DAY1)
    history = read_history(spark, path)
    assert stamps(history) == [(DAY1, 3)]
    assert commit_snapshot(make(spark, (1, 3, "new")), path, DAY2, ["id"]) is True
    assert stamps(read_history(spark, path)) == [(DAY1, 3), (DAY2, 1)]


def test_no_history_yet(spark, path):
    assert read_history(spark, path) is None
    assert newest_snapshot(spark, path) is None


def test_same_day_replace_keeps_other_days_and_null_times(spark, as_rows):
    history = spark.createDataFrame([(1, DAY1), (2, DAY2), (3, None)], "id int, inserted_at timestamp_ntz")
    new = spark.createDataFrame([(9, DAY2.replace(hour=7))], "id int, inserted_at timestamp_ntz")
    assert as_rows(replace_same_day(history, new, DAY2), "id") == [(1,), (3,), (9,)]


def test_append_by_name(spark, as_rows):
    left = spark.createDataFrame([(1, "a")], "id int, s string")
    right = spark.createDataFrame([(5.0, 2)], "x double, id int")
    assert as_rows(append_by_name(left, right)) == [(1, "a", None), (2, None, 5.0)]


def test_replacing_days_twice_gives_the_same_content(spark, path, as_rows):
    rng = random.Random(1)
    rows = [(i, datetime(2024, 5, rng.choice([1, 1, 1, 2, 3]), 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, inserted_at timestamp_ntz").repartition(6)
    replace_days(df, path)
    replace_days(df, path)
    history = read_history(spark, path)
    assert as_rows(history, "id", "inserted_at") == as_rows(df, "id", "inserted_at")
    assert {r[0] for r in history.select("snapshot_date").distinct().collect()} == {date(2024, 5, d) for d in (1, 2, 3)}


def test_newest_day_is_read_from_its_partition_only(spark, path):
    for day in (DAY1, DAY2):
        commit_snapshot(make(spark, (1, day.day, "a")), path, day, ["id"])
    last = newest_snapshot(spark, path)
    assert all("snapshot_date=2024-05-02" in f for f in last.inputFiles())


def test_stream_commits_whole_days_and_restarts(spark, tmp_path):
    landing, path, checkpoint = (str(tmp_path / n) for n in ("landing", "history", "checkpoint"))
    schema = "id bigint, at timestamp_ntz"

    def land(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{landing}/{name}")

    def ingest():
        stream = spark.readStream.schema(schema).json(f"{landing}/*")
        ingest_available(stream, commit_days(path, "at"), checkpoint)
        return sorted(r["id"] for r in read_history(spark, path).collect())

    land("a", [(1, DAY1), (2, DAY2)])
    assert ingest() == [1, 2]
    assert ingest() == [1, 2]  # nothing new
    land("b", [(3, DAY2.replace(hour=9)), (4, DAY3)])
    assert ingest() == [1, 2, 3, 4]  # the second day has come in two files


def test_retried_batch_of_days_replaces_its_own_rows_only(spark, path):
    def rows(*pairs):
        return spark.createDataFrame(pairs, "id bigint, at timestamp_ntz")

    commit = commit_days(path, "at")
    commit(rows((1, DAY1), (2, DAY2)), 0)
    for _ in range(2):
        commit(rows((3, DAY2), (3, DAY2), (4, DAY3)), 1)
    assert sorted(r["id"] for r in read_history(spark, path).collect()) == [1, 2, 3, 3, 4]


def runs_of(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, price double, run_ts timestamp_ntz")


def content(spark, path):
    return sorted((r["inserted_at"].day, r["id"], r["price"]) for r in read_history(spark, path).collect())


def test_retried_batch_of_runs_changes_nothing(spark, path):
    commit = commit_runs(path, ["id"])
    commit(runs_of(spark, (1, 1.0, DAY1)), 0)
    for _ in range(2):  # the second day repeats the first
        commit(runs_of(spark, (1, 1.0, DAY2), (1, 2.0, DAY3)), 1)
    assert content(spark, path) == [(1, 1, 1.0), (3, 1, 2.0)]


def test_late_run_is_compared_with_the_one_before_it(spark, path):
    commit = commit_runs(path, ["id"])
    commit(runs_of(spark, (1, 1.0, DAY1), (1, 3.0, DAY3)), 0)
    commit(runs_of(spark, (1, 1.0, DAY2), (1, 9.0, DAY3.replace(hour=1))), 1)
    assert content(spark, path) == [(1, 1, 1.0), (3, 1, 3.0)]  # unchanged, and older than its day's run
    commit(runs_of(spark, (1, 2.0, DAY2)), 2)
    assert content(spark, path) == [(1, 1, 1.0), (2, 1, 2.0), (3, 1, 3.0)]


@pytest.mark.parametrize("first", [5.0, 1.0])
def test_run_in_two_parts_keeps_both(spark, path, first):
    commit = commit_runs(path, ["id"])
    commit(runs_of(spark, (1, 1.0, DAY1)), 0)
    commit(runs_of(spark, (1, first, DAY2)), 1)  # may repeat the first day so far
    for _ in range(2):
        commit(runs_of(spark, (2, 6.0, DAY2)), 2)
    assert content(spark, path) == [(1, 1, 1.0), (2, 1, first), (2, 2, 6.0)]


def test_stream_commits_runs_in_order(spark, tmp_path):
    landing, path, checkpoint = (str(tmp_path / n) for n in ("landing", "history", "checkpoint"))
    schema = "id bigint, price double, run_ts timestamp_ntz"
    runs = [(DAY3, 2.0), (DAY1, 1.0), (DAY2, 1.0), (DAY3.replace(hour=20), 5.0)]  # day 2 repeats day 1
    for i, (run, price) in enumerate(runs):
        rows = [(k, price, run) for k in (1, 2)]
        spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{landing}/{i}")
    stream = spark.readStream.schema(schema).json(f"{landing}/*")
    ingest_available(stream, commit_runs(path, ["id"]), checkpoint)
    assert stamps(read_history(spark, path)) == [(DAY1, 2), (DAY3.replace(hour=20), 2)]


def test_failed_commit_fails_the_ingest(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text('{"id": 1}\n')
    stream = spark.readStream.schema("id bigint").json(str(tmp_path / "landing"))

    def broken(df, batch_id):
        raise ValueError("no commit")

    with pytest.raises(Exception, match="no commit"):
        ingest_available(stream, broken, str(tmp_path / "checkpoint"))


def test_stamps_do_not_depend_on_the_session_zone(spark, path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    late = datetime(2024, 5, 1, 23, 30)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        commit_snapshot(make(spark, (1, 1, "a")), path, late, ["id"])
        assert commit_snapshot(make(spark, (1, 1, "a")), path, DAY2, ["id"]) is False
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    row = read_history(spark, path).first()
    assert row["inserted_at"] == late and row["snapshot_date"] == date(2024, 5, 1)
