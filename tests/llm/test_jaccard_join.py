"""Similarity join: components against all pairs by brute force, hot groups, cut lists, odd rows."""

import random

import numpy as np
import pytest

from snapmart.llm import jaccard_join
from tests.llm import brute


def plain(rows, size, percent):
    sets = [brute.shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    texts = [None, "", " \t", "one", "One", "one two", "one two three", "x" * 9000, "a b " * 3000, "a b " * 3000]
    for _ in range(40):
        base = rng.choices(vocabulary, k=rng.randint(3, 150))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy))
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=12)) for _ in range(40)]
    hot = rng.choices(vocabulary, k=120)
    for _ in range(80):  # a large group of near copies around the threshold
        copy = list(hot)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    return [(None if i == 7 else i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("size", "percent", "part"), [(3, 90, 20_000), (5, 80, 20_000), (3, 90, 15), (2, 70, 15)])
def test_components_agree_with_all_pairs(spark, monkeypatch, size, percent, part):
    monkeypatch.setattr(jaccard_join, "LIST_PART", part)
    rows = corpus(size * 100 + part)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, n int").repartition(3)
    got = jaccard_join.join(df, size, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, size, percent)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_outlines_allow_every_pair_that_reaches(percent):
    rng = np.random.default_rng(percent)
    refused = 0
    for _ in range(400):
        pool = np.unique(rng.integers(0, 2**64, rng.integers(2, 3000), np.uint64))
        cut = sorted(rng.integers(0, len(pool) + 1, 2)) if rng.random() < 0.5 else (0, len(pool) * rng.integers(80, 101) // 100)
        x, y = pool[: max(cut[1], 1)], pool[min(cut[0], len(pool) - 1) :]
        outlines = [np.frombuffer(jaccard_join._outline(s), np.uint8) for s in (x, y)]
        allowed = jaccard_join.outlines_allow(*outlines, percent)
        assert allowed or not jaccard_join.reaches(x, y, percent)
        assert allowed == jaccard_join.outlines_allow(*outlines[::-1], percent)
        refused += not allowed
    assert refused > 40


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (3, text + " more"), (9, "other words"), (9, "other words"), (None, text), (4, None), (7, "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, extra int")
    out = jaccard_join.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [3, 4, 7, 9, None]


def test_rows_of_a_repeated_id_are_decided_by_their_own_text(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(50)) for x in "abcde")
    rows = [(3, a), (9, a + " more"), (9, b), (11, c), (11, d), (12, e), (12, e + " more"), (12, e), (20, d)]
    rows += [(30, None), (30, ""), (31, None), (31, None), (None, c)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id int, text string, extra int").repartition(3)
    out = jaccard_join.one_of_each(df)
    assert out.columns == df.columns and out.schema["doc_id"].dataType == df.schema["doc_id"].dataType
    want = [(3, a), (9, b), (11, c), (11, d), (12, e), (30, ""), (31, None), (None, c)]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.join(df).count() == 0
    assert jaccard_join.one_of_each(df).count() == 0


def test_round_two_names_few_pairs_of_a_group_below_the_limit(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):  # pairs share about three quarters, so all stay components of their own
        copy, at = list(base), rng.randrange(350)
        copy[at : at + 47] = [f"x{i}.{k}" for k in range(47)]
        rows.append((i, " ".join(copy)))
    made, real = [], jaccard_join.map_arrow

    def counted(df, function, schema):
        out = real(df, function, schema)
        if function.__qualname__.startswith("_cross_pairs"):
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "map_arrow", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.join(df, 5, 80)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, 5, 80)
    assert len(made) == 1 and made[0] <= 10 * len(rows)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_first_common_shingle_of_a_link_is_early_enough(percent):
    rng = random.Random(percent)
    links = 0
    for _ in range(2000):
        pool = rng.sample(range(200), rng.randint(1, 60))
        x, y = (sorted(set(rng.sample(pool, rng.randint(max(1, len(pool) * percent // 100), len(pool))))) for _ in range(2))
        common = set(x) & set(y)
        if 100 * len(common) >= percent * len(set(x) | set(y)):
            links += 1
            p, q = (np.array([s.index(min(common))]) for s in (x, y))
            n, m = np.array([len(x)]), np.array([len(y)])
            assert jaccard_join._can_be_first(n, m, p, q, percent)[0]
            assert p[0] <= len(x) - -(-percent * len(x) // 100)  # in the short lists of both
            assert q[0] <= len(y) - -(-percent * len(y) // 100)
    assert links > 100
