"""Rules as weak supervision: counts against a plain version, votes, estimation, odd rows."""

import math

import pytest

from snapmart.llm import quality_rules as q
from tests.llm import brute

GOOD = " ".join(f"word{i} next{i * 7} other{i * 3}" for i in range(60))
TEXTS = [
    None,
    "",
    " \t\x0b\n",
    "one",
    "a b c a b c",
    "a b c d a b c d\nx\nx\n\n x\nx",
    "x y " * 400,
    "é😀 ß#$ <b>|\x0bq\fr\rs " * 30,
    "THIS!! IS!! LOUD!! " * 5 + "AND!! " * 60,
    GOOD,
    GOOD,
    "lone" * 50_000,
    "long words here " * 20_000,
    " nbsp em " * 3,
]


def docs(spark, texts):
    rows = [(i if t is not None else None, t, "extra", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, __quality_n_words string, count int")


def test_counts_agree_with_plain_version(spark):
    got = q.quality_report(docs(spark, TEXTS)).collect()
    want = sorted((brute.rule_counts(t) for t in TEXTS), key=repr)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == want
    assert all(not (r.base_failed and r.kept) for r in got)


def test_good_text_stays_and_loud_text_goes(spark):
    loud = " ".join(f"W{i}!!" for i in range(90)).upper()
    symbols = " ".join(f"w{i}&&&" for i in range(90))
    rows = [GOOD + f" end{i}" for i in range(20)] + [loud, symbols + " " + loud]
    verdict = {r.doc_id: r.kept for r in q.quality_report(docs(spark, rows)).collect()}
    assert all(verdict[i] for i in range(20))
    assert not verdict[21]


def test_kept_rows_have_their_own_columns(spark):
    df = docs(spark, [GOOD, "short"])
    out = q.keep_good(df.withColumn("__quality_row", df["count"]))
    assert out.columns == ["doc_id", "text", "__quality_n_words", "count", "__quality_row"]
    assert [(r.doc_id, r["__quality_n_words"], r["__quality_row"]) for r in out.collect()] == [(0, "extra", 0)]


def test_empty_table(spark):
    assert q.quality_report(docs(spark, TEXTS).limit(0)).count() == 0


def test_estimation_finds_the_reliable_rule():
    # Rules 0 and 1 agree; rule 2 finds fault at random.
    patterns = [((1, 1, v), 400) for v in (0, 1)] + [((0, 0, v), 100) for v in (0, 1)] + [((None, None, None), 5)]
    bias, add = q.fit(patterns)
    assert bias == pytest.approx(math.log(0.8 / 0.2), abs=0.6)
    assert add[0][0] < -2 and add[0][0] == pytest.approx(add[1][0])
    assert abs(add[2][0]) < 0.5
    # The counts' size does not matter, only their shares.
    assert q.fit([(p, 7 * n) for p, n in patterns])[0] == pytest.approx(bias)
    assert q.fit([])[1] == []
