"""Near duplicates: components against all pairs by brute force, signatures against plain ones, hot groups, odd rows."""

import random

import numpy as np
import pytest

from snapmart.llm import circulant_minhash as cm
from snapmart.llm import components as graph
from tests.llm.test_jaccard_join import corpus, plain


def plain_rows(rows, size, percent):
    return sorted(((d, n, c, d == c) for d, n, c in plain(rows, size, percent)), key=repr)


@pytest.mark.parametrize(("size", "percent", "part"), [(2, 80, 2000), (5, 80, 2000), (2, 80, 3), (2, 90, 1)])
def test_components_agree_with_all_pairs(spark, monkeypatch, size, percent, part):
    monkeypatch.setattr(cm, "PART", part)
    rows = corpus(size * 10 + percent + part)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, key int").repartition(3)
    got = cm.near_duplicates(df, size, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_rows(rows, size, percent)


def test_passage_shared_by_documents_that_are_not_near(spark, monkeypatch):
    monkeypatch.setattr(cm, "PART", 7)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    # Shares of the passage around the limit: many buckets with many components, some linked in chains.
    rows = [(i, " ".join([*passage, *(f"w{rng.randrange(4000)}" for _ in range(rng.randint(2, 30)))])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = cm.near_duplicates(df, 2, 80)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_rows(rows, 2, 80)


def test_coordinates_are_minima_of_one_permutation_shifted():
    def finish(x):
        x ^= x >> 33
        x = x * 0xFF51AFD7ED558CCD % 2**64
        x ^= x >> 33
        x = x * 0xC4CEB9FE1A85EC53 % 2**64
        return x ^ x >> 33

    rng = random.Random(1)
    sets = [[rng.getrandbits(64) for _ in range(rng.choice([1, 3, 40, 20_000]))] for _ in range(9)]
    bounds = np.cumsum([0, *map(len, sets)])
    got = cm.signatures(np.array([x for s in sets for x in s], np.uint64), bounds, 6)
    scatter = int(cm._SCATTER)
    want = [[min(finish((finish(x * scatter % 2**64) + k) % 2**64) for x in s) for k in range(6)] for s in sets]
    assert got.tolist() == want


def test_share_of_equal_coordinates_estimates_the_similarity():
    rng = np.random.default_rng(2)
    for shared in (0, 30, 60, 80):
        x = rng.integers(0, 2**63, 100, np.uint64)
        y = np.concatenate([x[:shared], rng.integers(0, 2**63, 100 - shared, np.uint64)])
        found = cm.signatures(np.concatenate([x, y]), np.array([0, 100, 200]), 2000)
        assert abs((found[0] == found[1]).mean() - shared / (200 - shared)) < 0.05


def test_large_group_of_near_copies_takes_few_pairs(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(600):
        copy = list(base)
        copy[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    profiles = cm._profiles(df, 2, cm.BANDS, cm.ROWS)
    postings = profiles.selectExpr("explode(keys) key", "node")
    leaders = postings.groupBy("key").agg({"node": "min"}).withColumnRenamed("min(node)", "low")
    high = postings.groupBy("key").agg({"node": "max"}).withColumnRenamed("max(node)", "high")
    pairs = cm._leader_pairs(postings.join(leaders, "key").join(high, "key"))
    assert pairs.count() <= cm.LEADERS * 600
    got = cm.near_duplicates(df, 2, 80).collect()
    assert {r.component_id for r in got} == {0} and [r.doc_id for r in got if r.kept] == [0]


def test_empty_table_and_texts_without_words(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert cm.near_duplicates(df).count() == 0
    df = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    got = sorted((tuple(r) for r in cm.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)], key=repr)


def test_least_pair_of_each_component_over_several_blocks():
    rng = np.random.default_rng(4)
    best, seen = np.empty((0, 4)), {}
    for _ in range(5):
        x, y = rng.integers(0, 30, 200), rng.integers(30, 60, 200)
        rank, i, j = rng.integers(0, 9, 200) / 9, rng.integers(0, 500, 200), rng.integers(500, 999, 200)
        best = cm._least_of_each(best, x, y, rank, i, j)
        for pair in zip(rank.tolist(), i.tolist(), j.tolist(), x.tolist(), y.tolist(), strict=True):
            for c in pair[3:]:
                seen[c] = min(seen.get(c, (2.0, 0, 0)), pair[:3])
    assert {int(c): (r, int(i), int(j)) for c, r, i, j in best} == seen


def test_stars_are_found_without_another_round(spark, monkeypatch):
    rounds, real = [], graph.written

    def counted(df, label):
        rounds.append(label)
        return real(df, label)

    monkeypatch.setattr(graph, "written", counted)
    stars = [(k, k // 10 * 10) for k in range(100) if k % 10]
    got = graph.components(spark.createDataFrame(stars, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == [(k, k // 10 * 10) for k in range(100)] and len(rounds) == 1
    path = [(k, k + 1) for k in range(40)] + [(7, 7), (50, 51)]
    got = graph.components(spark.createDataFrame(path, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == [(k, 0) for k in range(41)] + [(50, 50), (51, 50)]
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
