"""Rows chosen by id: the exact ones, and only these and few others are moved to find them."""

import pytest
from pyspark.sql import functions as F

from snapmart.llm import common, jaccard_join


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def frame(spark, n=20_000):
    rows = spark.range(n).select((F.col("id") * 7).alias("doc_id"), F.col("id").cast("string").alias("te xt"))
    return rows.unionByName(spark.createDataFrame([(None, "a"), (None, "b"), (14, "c")], "doc_id long, `te xt` string"))


@pytest.mark.parametrize("words", [1, 1 << 18])
@pytest.mark.parametrize("ids", [[], [14], [None], [None, 14, 21, 10**12]])
def test_rows_are_chosen_exactly(spark, monkeypatch, no_broadcast, as_rows, words, ids):
    monkeypatch.setattr(common, "FILTER_WORDS", words)  # with one word nearly every row passes the filter
    df, key = frame(spark, 300), F.col("doc_id")
    all_rows = as_rows(df)
    wanted = spark.createDataFrame([(i,) for i in ids], "of long")
    assert as_rows(common.rows_with(df, key, wanted)) == [r for r in all_rows if r[0] in ids]
    assert as_rows(common.rows_without(df, key, wanted)) == [r for r in all_rows if r[0] is None or r[0] not in ids]


def test_few_rows_pass_the_filter_and_none_is_moved_for_it(spark, no_broadcast):
    df = frame(spark)
    ids = spark.range(0, 14_000, 70).select(F.col("id").alias("of"))
    asked = common._filtered(df, F.col("doc_id"), ids)
    kept = asked.where("__maybe").select("doc_id").collect()
    assert {r.doc_id for r in kept} >= set(range(0, 14_000, 70)) and len(kept) < 250
    plan = asked._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_texts_of_the_join_are_filtered_before_they_are_moved(spark, monkeypatch, no_broadcast):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(k, " ".join(f"{k}x{i}" for i in range(60))) for k in range(200)] + [(300, text), (301, text + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    passed, real = [], common._filtered

    def counted(frame, key, ids):
        out = real(frame, key, ids)
        passed.append(out.where("__maybe").count())
        return out

    monkeypatch.setattr(common, "_filtered", counted)
    kept = {r.doc_id for r in jaccard_join.one_of_each(df).collect()}
    assert kept == {*range(200), 300}
    assert passed and max(passed) <= 4
