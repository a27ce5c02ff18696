from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapmart.functions import (
    day_text,
    escape_markup,
    hours_between,
    interval_hours,
    minutes_between,
    moment,
    percent_of,
    ratio,
    within_days,
)
from snapmart.operators.aggregates import (
    counts_per_day,
    delimited_chunks,
    duplicate_keys,
    duplicate_values,
    joined_names,
    missing_percent,
    success_rate,
)
from snapmart.operators.joins import (
    enrich,
    join_same_day,
    orphans,
    rows_at_group_max,
    scoped,
    scoped_latest,
    union_labelled,
)

D = datetime


def test_left_enrich_keeps_unmatched(spark, as_rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (None, "n")], "k int, s string")
    assert as_rows(enrich(left, right, "k")) == [(1, "a"), (2, None), (None, None)]


@pytest.fixture(params=["-1", "10485760"])
def threshold(spark, request):
    """No broadcasts, and Spark's default."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


def test_scope_drops_untracked_and_repeats_nothing(spark, as_rows, threshold):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (1, "z")], "k int, s string")
    universe = spark.createDataFrame([(1, 9), (1, 8), (None, 7)], "k int, other int")
    assert as_rows(scoped(df, universe, "k")) == [(1, "x"), (1, "z")]


@pytest.mark.parametrize("keys", [["k"], ["c", "k"]])
def test_scoped_latest_is_the_same_for_any_threshold_and_repeated_keys(spark, as_rows, threshold, keys):
    rows = [("a", 1, D(2024, 1, 1), 1), ("a", 1, D(2024, 1, 2), 2), ("b", 1, None, 3), ("b", 2, D(2024, 1, 9), 4), ("a", 3, D(2024, 1, 1), 5)]
    df = spark.createDataFrame(rows, "c string, k int, at timestamp_ntz, v int")
    universe = spark.createDataFrame([(1,), (3,), (1,)], "k int")
    want = [(3,), (5,)] if keys == ["k"] else [(2,), (3,), (5,)]
    assert as_rows(scoped_latest(df, universe, "k", keys, "at"), "v") == want


def test_declaring_a_scope_runs_no_job(spark):
    df = spark.range(1000).selectExpr("id % 9 as k", "timestamp_ntz'2024-01-01' as at", "id as v")
    spark.sparkContext.setJobGroup("declared", "")
    scoped_latest(df, spark.range(5).selectExpr("id as k"), "k", ["k"], "at")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("declared") == []
    spark.sparkContext.setJobGroup("default", "")


def test_same_day_join(spark, as_rows):
    left = spark.createDataFrame([(1, D(2024, 1, 1, 1), "l"), (1, D(2024, 1, 2, 1), "m")], "k int, at timestamp_ntz, s string")
    right = spark.createDataFrame([(1, D(2024, 1, 1, 23), 5), (2, D(2024, 1, 2), 6)], "k int, seen timestamp_ntz, v int")
    assert as_rows(join_same_day(left, right, "k", "at", "seen"), "s", "v") == [("l", 5), ("m", None)]


def test_group_max_keeps_ties(spark, as_rows):
    df = spark.createDataFrame(
        [("j", D(2024, 1, 2), 1), ("j", D(2024, 1, 2), 2), ("j", D(2024, 1, 1), 3), ("i", None, 4)],
        "job string, at timestamp_ntz, v int",
    )
    assert as_rows(rows_at_group_max(df, "job", "at"), "v") == [(1,), (2,)]


def test_orphans_ignore_null_keys(spark, as_rows):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert as_rows(orphans(child, "fk", parent, "id")) == [(2, 2)]


def test_duplicates(spark, as_rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert as_rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 2), (None, 1, 2)]
    assert as_rows(duplicate_values(df, "a")) == [(1, 3)]


def test_missing_percent_in_one_pass(spark, as_rows):
    df = spark.createDataFrame([(1, None), (2, None), (None, None)], "a int, b int")
    assert as_rows(missing_percent(df, ["a", "b"])) == [("a", 33.33), ("b", 100.0)]
    out = missing_percent(df, ["a", "b"])
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert as_rows(missing_percent(df.where("false"), ["a"])) == [("a", None)]


def test_day_pivot_leaves_holes_null(spark, as_rows):
    a = spark.createDataFrame([(D(2024, 1, 1, 5),), (D(2024, 1, 1, 6),)], "at timestamp_ntz")
    b = spark.createDataFrame([(D(2024, 1, 2),)], "seen timestamp_ntz")
    out = counts_per_day([("a", a, "at"), ("b", b, "seen")])
    assert [(d.day, x, y) for d, x, y in as_rows(out)] == [(1, 2, None), (2, None, 1)]


def test_success_rate_rounds_half_up(spark, as_rows):
    df = spark.createDataFrame([("j", i < 3) for i in range(16)], "job string, good boolean")
    assert as_rows(success_rate(df, "job", F.col("good"))) == [("j", 16, 18.8)]  # 18.75


def test_names_and_chunks(spark, as_rows):
    df = spark.createDataFrame([("t", "b"), ("t", "a"), ("t", "a"), ("u", "c")], "t string, n string")
    assert as_rows(joined_names(df, "t", "n")) == [("t", 2, "a, b"), ("u", 1, "c")]
    keys = spark.range(1200).withColumnRenamed("id", "k")
    chunks = delimited_chunks(keys.union(keys), "k", 500).collect()
    assert sorted(r["n_keys"] for r in chunks) == [200, 500, 500]
    assert ",".join(r["keys"] for r in sorted(chunks, key=lambda r: r["chunk"])) == ",".join(map(str, range(1200)))


def test_union_labelled_aligns_names(spark, as_rows):
    one = spark.createDataFrame([(1, 2)], "a int, b int")
    two = spark.createDataFrame([(4, 3)], "b int, a int")
    assert as_rows(union_labelled([("x", one), ("y", two)])) == [("x", 1, 2), ("y", 3, 4)]


def test_ratio_and_percent(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 4)], "a int, b int")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, None, 0.75]
    assert spark.range(1).select(percent_of(F.lit(1), F.lit(0), 2)).first()[0] is None


def test_time_differences_do_not_depend_on_the_session_zone(spark):
    """2024-03-10 02:30 does not exist in New York; the zone must not matter."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        later, earlier = (F.expr(f"timestamp_ntz'{t}'") for t in ("2024-03-10 05:00:00", "2024-03-09 23:30:00.5"))
        row = spark.range(1).select(
            hours_between(later, earlier),
            minutes_between(earlier, later),
            later - earlier > interval_hours(F.lit(5)),
            day_text(later),
            moment(D(2024, 3, 10, 2, 30, 0, 5)).cast("string"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row[0] == pytest.approx((5.5 * 3600 - 0.5) / 3600, abs=1e-12)
    assert row[1] == pytest.approx(-(5.5 * 60 - 0.5 / 60), abs=1e-9)
    assert row[2] is True and row[3] == "2024-03-10"
    assert row[4] == "2024-03-10 02:30:00.000005"  # no such time in that zone


def test_recency_flag(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 2),), (None,)], "at timestamp_ntz")
    assert [r[0] for r in df.select(within_days("at", D(2024, 4, 1), 90)).collect()] == [False, True, None]


def test_markup_is_escaped_once(spark):
    out = spark.range(1).select(escape_markup(F.lit("""<a href="x">it's &amp;</a>"""))).first()[0]
    assert out == "&lt;a href=&quot;x&quot;&gt;it&#x27;s &amp;amp;&lt;/a&gt;"
