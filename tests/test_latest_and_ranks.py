import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapmart.operators import ranking
from snapmart.operators.latest import latest_batch, latest_per_key, latest_per_key_day, latest_whole_rows
from snapmart.operators.ranking import rank_in_group, rank_pieces, top_k, top_per_group, with_previous

D = datetime


@pytest.fixture(scope="module")
def history(spark):
    rows = [
        (1, D(2024, 1, 1, 8), 10, "a"),
        (1, D(2024, 1, 1, 20), 11, "b"),  # later the same day
        (1, D(2024, 1, 3, 8), 12, "c"),
        (2, D(2024, 1, 1, 8), 20, "a"),
        (2, D(2024, 1, 1, 8), 21, "z"),  # same key, same time
        (3, None, 30, "n"),  # unknown time
        (3, D(2024, 1, 2, 8), 31, "o"),
        (None, D(2024, 1, 2, 9), 40, "p"),
    ]
    return spark.createDataFrame(rows, "k int, at timestamp_ntz, v int, s string")


@pytest.mark.parametrize("few_keys", [False, True])
def test_newest_row_per_key(history, as_rows, few_keys):
    found = as_rows(latest_per_key(history, ["k"], "at", ["v"], few_keys=few_keys), "k", "v", "s")
    assert found == [(1, 12, "c"), (2, 21, "z"), (3, 30, "n"), (None, 40, "p")]


@pytest.mark.parametrize("few_keys", [False, True])
def test_newest_row_per_key_of_a_dated_history(history, as_rows, few_keys):
    df = history.withColumn("snapshot_date", F.to_date("at"))
    found = as_rows(latest_per_key(df, ["k"], "at", ["v"], few_keys=few_keys), "k", "v", "s")
    assert found == [(1, 12, "c"), (2, 21, "z"), (3, 30, "n"), (None, 40, "p")]


def test_newest_whole_row_per_key(history, as_rows):
    found = latest_whole_rows(history, ["k"], "at", ["v"])
    assert found.columns == history.columns
    assert as_rows(found, "k", "v", "s") == [(1, 12, "c"), (2, 21, "z"), (3, 30, "n"), (None, 40, "p")]


def test_whole_rows_are_shuffled_once_for_two_branches(history):
    daily = latest_per_key_day(history, ["k"], "at", ["v"], whole_rows=True)
    texts = daily.groupBy("snapshot_date").agg(F.max("s").alias("s"))
    both = texts.join(daily.groupBy("snapshot_date").agg(F.sum("v").alias("v")), "snapshot_date")
    both.collect()
    plan = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("whole_rows", [False, True])
def test_newest_row_per_key_and_day(history, as_rows, whole_rows):
    found = as_rows(latest_per_key_day(history, ["k"], "at", ["v"], whole_rows=whole_rows), "k", "v")
    assert found == [(1, 11), (1, 12), (2, 21), (3, 30), (3, 31), (None, 40)]


def test_both_ways_agree_on_a_hot_key(spark, as_rows):
    rng = random.Random(3)
    rows = [(rng.choice([0] * 5 + list(range(1, 11))), D(2024, 1, 1 + rng.randrange(9)), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, at timestamp_ntz, id int").repartition(7)
    best = {}
    for k, at, i in rows:
        best[k] = max(best.get(k, (at, i)), (at, i))
    want = sorted((k, i) for k, (_, i) in best.items())
    for few_keys in (False, True):
        assert sorted(as_rows(latest_per_key(df, ["k"], "at", ["id"], few_keys), "k", "id")) == want


def test_newest_row_is_limited_before_the_shuffle(history):
    plan = latest_per_key(history, ["k"], "at", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_batch_ignores_null_times(history, as_rows):
    assert as_rows(latest_batch(history, "at"), "k", "v") == [(1, 12)]
    assert latest_batch(history.where("at is null"), "at").count() == 0


def brute_ranks(rows):
    groups = defaultdict(list)
    for g, v, k in rows:
        groups[g].append((v is None, -(v or 0), k))
    return {(g, k): i + 1 for g, members in groups.items() for i, (_, _, k) in enumerate(sorted(members))}


@pytest.mark.parametrize("pieces", [2, 8, 64])
def test_full_rank_equals_brute_force(spark, pieces):
    """A group with most rows, a value shared by a third of all rows, and many nulls."""
    rng = random.Random(pieces)
    rows = []
    for key in range(4000):
        group = rng.choice([None, 1, 1, 1, 2])
        value = rng.choice([5.0, 5.0, None, round(rng.uniform(0, 10), 1), round(rng.expovariate(1), 2)])
        rows.append((group, value, key))
    df = spark.createDataFrame(rows, "g int, v double, k bigint").repartition(5)
    ranked = rank_in_group(df, ["g"], "v", "k", pieces=pieces)
    assert {(r["g"], r["k"]): r["rank"] for r in ranked.collect()} == brute_ranks(rows)


def test_full_rank_is_exact_for_any_cut_points(spark):
    rows = [(1, float(i % 7), i) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, v double, k bigint")
    other = spark.createDataFrame([(3.0, 50), (3.0, 50), (100.0, 60)], "v double, k bigint")
    ranked = rank_in_group(df, ["g"], "v", "k", pieces=4, cuts_from=other)
    assert {(r["g"], r["k"]): r["rank"] for r in ranked.collect()} == brute_ranks(rows)


def test_full_rank_of_only_nulls(spark):
    df = spark.createDataFrame([(1, None, 2), (1, None, 1)], "g int, v double, k bigint")
    assert sorted((r["k"], r["rank"]) for r in rank_in_group(df, ["g"], "v", "k").collect()) == [(1, 1), (2, 2)]


@pytest.mark.parametrize(
    "value, key",
    [
        ("5.0D", "id"),
        ("id % 3 * 1.0D", "CAST(NULL AS BIGINT)"),
        ("CAST(NULL AS DOUBLE)", "7"),
    ],
)
def test_full_rank_splits_a_hot_group(spark, value, key):
    """One group with all rows but ten, equal values, equal and null ties: no piece has twice the median's rows."""
    df = spark.range(10_000).select(F.when(F.col("id") < 10, 2).otherwise(1).alias("g"), F.expr(value).alias("v"), F.expr(key).alias("k"))
    placed = rank_pieces(df, ["g"], "v", "k", "at", pieces=16)
    sizes = sorted(r["count"] for r in placed.groupBy(F.shiftright("at", 33)).count().collect())
    assert len(sizes) == 16 and sum(sizes) == 10_000 and sizes[-1] <= 2 * sizes[8]
    ranked = rank_in_group(df, ["g"], "v", "k", pieces=16)
    found = ranked.groupBy("g").agg(F.max("rank"), F.count_distinct("rank")).orderBy("g").collect()
    assert [tuple(r) for r in found] == [(1, 9_990, 9_990), (2, 10, 10)]


def test_full_rank_moves_rows_once_and_joins_counts(spark):
    """No window over the rows: they are joined with one row of counts for each group and piece."""
    df = spark.range(5_000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("v"), F.col("id").alias("k"))
    plan = rank_in_group(df, ["g"], "v", "k", pieces=4)._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and "BroadcastHashJoin" in plan


def test_full_rank_counts_rows_for_its_pieces(spark, monkeypatch):
    monkeypatch.setattr(ranking, "PIECE_ROWS", 300)
    df = spark.range(1_000).select(F.lit("x").alias("g"), F.col("id").cast("string").alias("v"), F.col("id").alias("k"))
    placed = rank_pieces(df, ["g"], "v", "k", "at")
    assert placed.select(F.shiftright("at", 33)).distinct().count() == 4
    expected = {int(v): i + 1 for i, v in enumerate(sorted(map(str, range(1_000)), reverse=True))}
    assert {r["k"]: r["rank"] for r in rank_in_group(df, ["g"], "v", "k").collect()} == expected


def test_full_rank_of_odd_tables(spark):
    """No row; repeated rows; helper names, a dot, a map and an old rank among the columns."""
    schema = "`a.g` int, v double, k bigint, _place string, _piece int, _hash map<int,int>, rank int"
    rows = [(1, 2.0, 1, "p", 9, {1: 2}, 77), (1, 2.0, 1, "p", 9, {1: 2}, 77), (None, None, None, None, None, None, None)]
    ranked = rank_in_group(spark.createDataFrame(rows, schema), ["a.g"], "v", "k", pieces=3)
    assert ranked.columns == ["a.g", "v", "k", "_place", "_piece", "_hash", "rank"]
    found = sorted(((r["a.g"] or 0, r["_place"], r["_hash"], r["rank"]) for r in ranked.collect()), key=lambda r: (r[0], r[3]))
    assert found == [(0, None, None, 1), (1, "p", {1: 2}, 1), (1, "p", {1: 2}, 2)]
    assert rank_in_group(spark.createDataFrame([], schema), ["a.g"], "v", "k").count() == 0


def test_top_per_group(spark, as_rows):
    df = spark.createDataFrame([(1, 5.0, 1), (1, None, 2), (1, 7.0, 3), (2, None, 4)], "g int, v double, k int")
    order = [F.col("v").desc_nulls_last(), F.col("k")]
    assert as_rows(top_per_group(df, ["g"], order, 2), "g", "k") == [(1, 1), (1, 3), (2, 4)]


def test_previous_rank_change_and_first_appearance(spark):
    rows = [
        (1, D(2024, 1, 1), 5),
        (1, D(2024, 1, 2), 3),
        (1, D(2024, 1, 20), 9),  # back after a gap
        (2, D(2024, 1, 2), None),
        (2, D(2024, 1, 3), 4),  # previous rank was unknown
    ]
    df = spark.createDataFrame(rows, "k int, day timestamp_ntz, rank int").withColumn("day", F.to_date("day"))
    found = {(r["k"], r["day"].day): r for r in with_previous(df, ["k"], "day", "rank").collect()}
    assert (found[1, 1]["prev_rank"], found[1, 1]["rank_change"], found[1, 1]["is_new_entry"]) == (5, 0, True)
    assert (found[1, 2]["prev_rank"], found[1, 2]["rank_change"], found[1, 2]["is_new_entry"]) == (5, 2, False)
    assert found[1, 20]["prev_day"].day == 2 and found[1, 20]["rank_change"] == -6
    assert found[2, 3]["is_new_entry"] is True and found[2, 3]["rank_change"] == 0


def test_lag_columns_share_one_window(spark):
    df = spark.createDataFrame([(1, 1, 1)], "k int, day int, rank int")
    plan = with_previous(df, ["k"], "day", "rank")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("- Window") + plan.count("+- Window") <= 2


def test_top_k_is_planned_without_a_full_sort(spark):
    df = spark.range(100)
    plan = top_k(df, [F.col("id").desc()], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
