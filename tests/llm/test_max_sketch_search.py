"""Ranked search: rows against plain scores of all documents, bounds above scores, blocks of queries, odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from snapmart.llm import max_sketch_search as ms


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]


def plain(docs, items, k):
    counts = [(doc, Counter(terms(text))) for doc, text in docs]
    counts = [(doc, c) for doc, c in counts if c]
    if not counts:
        return []
    documents, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            m = 25 + 75 * sum(c.values()) * documents // length
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is not None, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ü", "İx", "ſ", "A_B", "c-d", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(n):
        return " ".join(rng.choices(vocabulary, weights, k=n)).replace("w1", rng.choice(["W1", "w1"]))

    docs = [(i, text(rng.choice([1, 5, 60, 300]))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " .,"), (None, text(40)), (203, "w7 " * 70_000), (204, text(30_000)), (3, text(9)), (3, text(9))]
    docs += [(300 + i, docs[5][1]) for i in range(30)]  # ties beyond the last rank
    items = [(i, text(rng.choice([1, 3, 40]))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, docs[5][1]), (53, "w1 w1 É"), (None, "w2 w3")]
    return docs, items


@pytest.mark.parametrize(("bits", "queries"), [(14, 256), (3, 9), (8, 2)])
def test_rows_agree_with_plain_scores(spark, bits, queries):
    docs, items = corpus(random.Random(bits))
    if queries == 2:
        items = items[-7:]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id int, text string, terms int").repartition(3)
    asked = spark.createDataFrame([(*i, "x") for i in items], "query_id long, text string, doc_id string")
    for k in (1, 10):
        got = ms.search(df, asked, k, bits=bits, at_once=queries)
        assert got.columns == ["query_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, items, k)
        if bits != 14:
            break


def test_bounds_are_never_below_scores(spark):
    docs, items = corpus(random.Random(4))
    indexed = ms.index(spark.createDataFrame(docs, "doc_id long, text string")).cache()
    total = indexed.agg({"n": "sum", "*": "count"}).first()
    rows = [{"id": i, "text": t} for i, t in items]
    block = ms._block(rows, indexed, total["count(1)"], total["sum(n)"])
    found = indexed.collect()
    n = np.array([r["n"] for r in found])
    bounds = ms.bounds_of(block, n, [bytes(r["places"]) for r in found], [bytes(r["largest"]) for r in found])
    score = ms.scorer(block)
    exact = np.array([[score(q, r["n"], bytes(r["terms"]), bytes(r["occurrences"])) for q in range(len(rows))] for r in found])
    assert (bounds >= exact).all() and (exact > 0).any() and (bounds == exact).mean() > 0.5


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "query_id long, text string")
    assert ms.search(none, asked).count() == 0
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert ms.search(docs, asked.limit(0)).count() == 0
    assert [tuple(r) for r in ms.search(docs, asked).collect()] == plain([(1, "a"), (2, None)], [(1, "a")], 10)
