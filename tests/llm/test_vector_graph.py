"""Nearest neighbours: recall and exact scores against brute force, ties, hot vectors, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.llm import queries, vector_graph


def brute(rows, is_query, shown):
    out = {}
    for q, x in rows:
        if is_query(q):
            scores = sorted((-float((np.array(x) * np.array(y)).sum()), v) for v, y in rows if v != q)
            out[q] = [(v, -s) for s, v in scores[:shown]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_given_vectors_reach_the_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = found(queries.op10_vector_graph(spark, folder))
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    of = dict(zip(ids.tolist(), range(len(ids)), strict=True))
    assert set(got) == {i for i in of if i % 20 == 0}
    hits = 0
    for q, near in got.items():
        scores = (x * x[of[q]]).sum(1)
        assert [s for _, s in near] == pytest.approx([scores[of[v]] for v, _ in near], abs=1e-12)
        assert near == sorted(near, key=lambda r: (-r[1], r[0])) and q not in dict(near) and len(near) == 20
        scores[of[q]] = -np.inf
        hits += len({v for v, _ in near} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hits >= 0.95 * 20 * len(got)


def test_unequal_lengths_over_shards(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "SHARD_ROWS", 500)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 8)) * rng.uniform(0.5, 2, size=(1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = brute(rows, lambda i: i % 50 == 0, 20)
    got = found(vector_graph.nearest(df, F.col("vec_id") % 50 == 0))
    hits = sum(len(set(dict(got[q])) & set(dict(want[q]))) for q in want)
    assert set(got) == set(want) and hits >= 0.9 * 20 * len(want)


def test_hot_vector_ties_and_odd_rows(spark):
    one, two = [1.0, 0.0], [0.5, 0.5]
    bad = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0, 3.0]]
    rows = [(i, one) for i in range(100)] + [(i, two) for i in range(100, 110)] + [(110, [-1.0, -0.0]), (111, [-1.0, 0.0])]
    odd = [(200 + i, v) for i, v in enumerate(bad)] + [(None, one), (0, one)]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, ids int").repartition(4)
    want = brute(rows, lambda i: i % 20 == 0, 20)
    assert found(vector_graph.nearest(df, F.col("vec_id") % 20 == 0)) == want
    few = spark.createDataFrame(rows[:1] + rows[100:103], "vec_id long, embedding array<float>")
    assert found(vector_graph.nearest(few, F.col("vec_id") % 20 == 0)) == brute(
        rows[:1] + rows[100:103], lambda i: i % 20 == 0, 20
    )
    assert vector_graph.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_every_length_has_its_own_shards(spark, monkeypatch):
    """Two lengths alike often, one in a few rows, one in a single row."""
    monkeypatch.setattr(vector_graph, "SHARD_ROWS", 100)
    rng = np.random.default_rng(4)
    size = {i: (4, 6)[i % 2] for i in range(400)} | {i: 3 for i in range(400, 410)} | {410: 5}
    rows = [(i, rng.normal(size=n).tolist()) for i, n in size.items()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = found(vector_graph.nearest(df, F.col("vec_id") % 5 == 0, 10))
    want = {}
    for n in (3, 4, 6):
        want |= brute([(i, v) for i, v in rows if len(v) == n], lambda i: i % 5 == 0, 10)
    assert set(got) == set(want)
    assert all(size[v] == size[q] for q, near in got.items() for v, _ in near)
    assert all([v for v, _ in got[q]] == [v for v, _ in want[q]] for q in want)


def test_repeated_ids_take_the_least_vector_in_any_order(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.9, 0.1]), (2, [0.1, 0.9]), (1, [0.9, 0.1]), (20, None)]
    found = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<double>").repartition(2)
        found.append(sorted(tuple(r) for r in vector_graph.nearest(df, F.col("vec_id") % 20 == 0, 2).collect()))
    assert found[0] == found[1] == [(0, 1, 2, pytest.approx(0.9)), (0, 2, 1, pytest.approx(0.1))]
