"""Personal data: fixed patterns against plain expressions, dynamic programming by enumeration, masks, odd rows."""

import hashlib
import itertools
import math
import random
import re

import pytest

from snapmart.llm import pii_crf as p
from snapmart.llm import queries


def plain(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        check = sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
        if 12 <= len(digits) <= 19 and check % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(a, p.KINDS[k], b) for a, k, b in sorted(out)]


CARD = "4111 1111 1111 1111"
TEXTS = [
    "",
    "mail a.b+c@x-1.example.com, and d@e.f@g.h.i or @x.y a@b",
    f"card {CARD} 4111-1111-1111-1111 4111111111111112 99{CARD}",
    "ip 1.2.3.4.5.6.7.8 256.1.1.1 000255.01.2.3 1.2.3",
    "+1 (555) 010-9999 +49 30 1234567 ++1 234567890123456 +1-",
    "é😀 +1 (826) 555-4081 190.11.2.3 4111111111111111",
    "9" * 20_000 + " " + "0" * 5_000 + ".1.1.1 " + "a" * 50_000 + "@x.y",
]


def test_fixed_patterns_agree_with_plain_expressions():
    rng = random.Random(2)
    texts = TEXTS[:-1] + ["".join(rng.choices("12 .-+@a()x", k=60)) for _ in range(4000)]
    for text in texts:
        assert p.base_spans(text) == plain(text), text
    assert [k for _, k, _ in p.base_spans(TEXTS[-1])] == ["ip", "email"]


def segmentations(n, segments):
    def extend(at):
        if at == n:
            yield []
            return
        for rest in extend(at + 1):
            yield rest
        for k, (i, j, _) in enumerate(segments):
            if i == at:
                for rest in extend(j):
                    yield [k, *rest]

    return list(extend(0))


def test_sums_and_best_agree_with_enumeration():
    rng = random.Random(4)
    for _ in range(40):
        n = rng.randint(1, 6)
        spans = [s for s in itertools.combinations(range(n + 1), 2) if rng.random() < 0.6]
        segments = [(i, j, rng.uniform(-2, 2)) for i, j in spans for _ in range(rng.randint(1, 2))]
        every = segmentations(n, segments)
        weights = [math.exp(sum(segments[k][2] for k in s)) for s in every]
        total, chance = p.expectations(n, segments)
        assert total == pytest.approx(math.log(sum(weights)))
        for k in range(len(segments)):
            assert chance[k] == pytest.approx(sum(w for s, w in zip(every, weights, strict=True) if k in s) / sum(weights))
        top = sum(segments[k][2] for k in p.best(n, segments))
        assert top == pytest.approx(max(sum(segments[k][2] for k in s) for s in every))


@pytest.fixture(scope="module")
def model(spark):
    return p.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_added_spans_leave_fixed_ones_alone(model):
    text = "call +1 (826) 555-4081 190.11.2.3 or 7536784127813050 4845168114407329 now"
    base = p.base_spans(text)
    added = p.added_spans(text, base, model)
    for a, _, b in added:
        assert all(b <= x or y <= a for x, _, y in base)
    assert any(text[a:b] == "+1 (826) 555-4081" and kind == "phone" for a, kind, b in added)
    assert p.added_spans("no number, 12 or 2024-01-05", [], model) == []
    assert p.masked_text(text, base + added).startswith("call [PHONE] [IP] or ")


def test_query_and_odd_rows(spark, model):
    rows = [(i, t, "x") for i, t in enumerate([None, *TEXTS, TEXTS[1]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    got = p.with_spans(df, model).select("doc_id", p.joined("base").alias("b"), p.of_kind("base", "email").alias("n"))
    for r in got.collect():
        want = p.base_spans(rows[r.doc_id][1] or "")
        assert r.b == ",".join(f"{k}:{a}:{b}" for a, k, b in want)
        assert r.n == sum(k == "email" for _, k, _ in want)
    masked = p.mask(df, model)
    assert masked.columns == df.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[0] is None and texts[1] == "" and "@x-1" not in texts[2]
    assert texts[3].startswith("card [CARD] [CARD] ")
    assert p.with_spans(df.limit(0), model).count() == 0 and p.mask(df.limit(0), model).count() == 0
    assert p.with_spans(df, p.fit(df.limit(0))).select("added").where("size(added) > 0").count() == 0


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op3_pii_crf(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(",")) or not joined
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, x, _ in want) for k in p.KINDS)


def test_long_texts_and_long_stretches_are_learned_from(spark):
    item = "a.b@mail.example.com 10.20.30.40 4111 1111 1111 1111 +49 30 1234567 "
    texts = [(i, (item * (31_200 // len(item) + 1))[:31_200] + str(i)) for i in range(20)]
    model = p.fit(spark.createDataFrame(texts, "doc_id long, text string"))
    assert len(model.weights) > 10
    spans = p.base_spans(texts[0][1])
    for a, b in p.stretches(texts[0][1]):
        parts = list(p._parts(a, b, sorted(spans)))
        assert parts[0][0] == a and parts[-1][1] == b and all(x[1] == y[0] for x, y in zip(parts, parts[1:], strict=False))
        assert not [s for s in spans for x, y in parts if s[0] < y < s[2]]
        assert max(y - x for x, y in parts) <= p.PART
    assert len(p._windows("x" * 100_000, 20_000)) == 10 and p._windows("x", 20_000) is None
