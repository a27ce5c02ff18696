"""Quality, toxicity and language: held-out accuracy on the given tables, odd rows, plain versions of the scores."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from snapmart.llm import common, language_ppm, quality_knn, queries, toxicity_ftrl
from snapmart.llm.common import table
from snapmart.llm.text import sorted_sets, text_slices, window_hashes, words_of
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"
ODD = [None, "", " \n", "one", "x" * 300_000, "word " * 60_000, "é😀 ß " * 50, "same text", "same text", "12 345 !!"]


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in table(spark, FOLDER, "labels").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(None if i == 3 else i, t, "en", i) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, y int")


def test_words_and_windows_agree_with_plain_version():
    texts = [t or "" for t in ODD] + ["A b\x0bC\fd", "a B c D", "a b c d"]
    for part in text_slices(pa.array(texts), limit=64):
        words = words_of(part)
        hashes, bounds = window_hashes(words.hashes, words.bounds, 3)
        sets, cuts = sorted_sets(hashes, bounds)
        for i in range(len(part)):
            plain = [w.lower() if w.isascii() else w for w in brute.words(texts[part.first + i])]
            mine = words.hashes[words.bounds[i] : words.bounds[i + 1]]
            assert len(mine) == len(plain)
            assert len(set(mine.tolist())) == len(set(plain))
            assert cuts[i + 1] - cuts[i] == len({tuple(plain[k : k + 3]) for k in range(len(plain) - 2)})


def test_long_text_is_read_in_blocks_alike():
    text = " ".join(f"Word{i % 977} x" for i in range(700_000))
    (long,) = text_slices(pa.array([text]))
    parts = [text[a : a + 700_000] for a in range(0, len(text), 700_000)]
    words = words_of(long, letters_only=True, shapes=True, begin=(5,))
    assert len(long.data) > 4 << 20 and words.bounds[-1] == len(text.split()) == len(words.shapes)
    (short,) = text_slices(pa.array([parts[0].rsplit(" ", 1)[0]]))
    want = words_of(short, letters_only=True, begin=(5,))
    n = len(want.hashes)
    assert (words.hashes[:n] == want.hashes).all() and (words.beginnings[0][:n] == want.beginnings[0]).all()


def test_quality_is_right_on_held_out_documents(spark, labels):
    rows = queries.op1_quality_knn(spark, FOLDER).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (brute.fold(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id].quality for r in held)
    assert right >= 0.95 * len(held)


def test_quality_votes_agree_with_plain_version():
    rng = np.random.default_rng(1)
    vectors = quality_knn._unit(rng.normal(size=(50, 4)))
    model = quality_knn.Model(np.zeros(4), np.eye(4), vectors, (rng.random(50) < 0.5).astype(np.float32))
    x = quality_knn._unit(rng.normal(size=(20, 4)))
    for row, got in zip(x, quality_knn.vote(x, model, 7), strict=True):
        near = sorted(((float(row @ v), y) for v, y in zip(vectors, model.labels, strict=True)), reverse=True)[:7]
        weights = [max(s, 0) ** 4 for s, _ in near]
        assert got == pytest.approx(sum(w * y for w, (_, y) in zip(weights, near, strict=True)) / sum(weights), abs=1e-5)
    assert quality_knn.vote(np.zeros((1, 4), np.float32), model)[0] == pytest.approx(model.labels.mean())


def test_toxic_documents_score_higher(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r for r in table(spark, folder, "labels").collect()}
    rows = queries.op4_toxicity_ftrl(spark, folder).collect()
    assert len(rows) == 10_000
    assert all(r.held_out == (brute.fold(r.doc_id, 4) == 2) and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id].toxic) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum(a > b for a in toxic for b in clean) > 0.95 * len(toxic) * len(clean)
    assert sum(s >= 0.3 for s in clean) <= 0.02 * len(clean)


def test_ftrl_separates_and_is_sparse():
    rng = np.random.default_rng(0)
    examples = []
    for k in range(300):
        found = np.unique(rng.integers(0, 5000, 40))
        y = k % 2
        examples.append((np.unique(np.append(found, 7777 if y else 8888)), y))
    examples = [(f, np.ones(len(f), np.uint8), y) for f, y in examples]
    weights, _ = toxicity_ftrl.train(examples, toxicity_ftrl.Ftrl())
    assert weights[7777] > 0.5 and weights[8888] < -0.5
    assert np.count_nonzero(weights) < 2500


def test_language_is_right_on_held_out_documents(spark):
    rows = queries.op6_language_ppm(spark, FOLDER).collect()
    of = {r.doc_id: r.lang for r in table(spark, FOLDER, "documents").select("doc_id", "lang").collect()}
    assert all(r.held_out == (brute.fold(r.doc_id, 3) == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == of[r.doc_id] for r in held) >= 0.98 * len(held)


def plain_bits(text, texts):
    """Code length of a text by prediction by partial matching after the texts, byte by byte."""
    trees = [{} for _ in range(language_ppm.ORDER + 1)]
    pad = b"\n" * language_ppm.ORDER
    for t in texts:
        data = pad + t.lower().encode()
        for i in range(len(pad), len(data)):
            for k, tree in enumerate(trees):
                tree.setdefault(data[i - k : i], Counter())[data[i]] += 1
    data, bits = pad + text.lower().encode(), 0.0
    for i in range(len(pad), len(data)):
        for k in range(language_ppm.ORDER, -1, -1):
            seen = trees[k].get(data[i - k : i])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits += math.log2(total / seen[data[i]])
                break
            bits += math.log2(total / len(seen))
        else:
            bits += 8
    return bits


def test_code_lengths_agree_with_plain_version():
    texts = {"a": ["the cat sat on the mat", "a hat"], "b": ["le chat est sur la table", "un été"]}
    model = language_ppm.build(texts)
    tests = ["the chat", "", "zzz été\x00", "the cat sat on the table " * 3]
    (part,) = text_slices(pa.array(tests))
    got = language_ppm._code_lengths(part, model, model.places())
    want = [[plain_bits(t, texts[n]) for n in model.names] for t in tests]
    assert got == pytest.approx(np.array(want), rel=1e-4, abs=1e-4)


def plain_pieces(text, key, longest):
    size = min(common.PIECE, longest)
    if len(text) <= longest:
        return text
    cut = [text[a : a + size] for a in range(0, len(text), size)]
    order = sorted(range(len(cut)), key=lambda k: (zlib.crc32(f"{key}:{k}".encode()), k))
    return "\n".join(cut[k] for k in sorted(order[: longest // size]))


@pytest.mark.parametrize("longest", [1, 7, 1999, 2000, 2001, 4500, 20_000])
def test_long_texts_are_read_in_pieces_spread_over_them(spark, longest):
    texts = ["", "é" * longest, "aé\u4e2d😀" * 6007, "x" * (longest + 1), "q\n" * 2000, None]
    rows = [(None if i == 4 else i, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = df.select("text", common.spread_pieces(F.col("text"), F.col("doc_id"), longest).alias("read")).collect()
    for (key, text), row in zip(rows, got, strict=True):
        if text is None:
            assert row["read"] is None
        elif key is None:  # the number alone is hashed
            assert len(text) <= longest or 0 < len(row["read"]) < longest + longest // min(common.PIECE, longest)
        else:
            assert row["read"] == plain_pieces(text, key, longest)


def test_fits_learn_from_the_ends_of_long_texts(spark):
    """Texts of 60,000 characters that are alike but for their last 20,000."""
    ends = ["calm river ", "vile brute "]
    rows = [(i, "plain words here " * 2400 + ends[i % 2] * 1900, i % 2) for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y int").withColumn("lang", F.col("y").cast("string"))
    tests = spark.createDataFrame([(i, t * 20) for i, t in enumerate(ends)], "doc_id long, text string")
    model = toxicity_ftrl.fit(df, df.selectExpr("doc_id", "y toxic"))
    score = {r.doc_id: r.score for r in toxicity_ftrl.with_score(tests, model).collect()}
    assert score[1] > 0.6 > 0.4 > score[0]
    lang = language_ppm.predict(tests, language_ppm.fit(df, longest=20_000)).collect()
    assert {r.doc_id: r.lang_pred for r in lang} == {0: "0", 1: "1"}


def test_every_language_is_learned(spark, monkeypatch):
    """More languages than 64, one whose first ids have no text, one of long texts only, one of few repeated ids."""
    of = {f"l{k:02d}": " ".join(chr(0x4E00 + 20 * k + i) * 3 for i in range(15)) for k in range(70)}
    rows = [(100 * k + i, text, lang) for k, (lang, text) in enumerate(of.items()) for i in range(3)]
    of |= {"long": "zebra quilt " * 5000, "void": "jovial fox ", "some": "mumm " * 9}
    rows += [(8000 + i, of["long"], "long") for i in range(3)]
    rows += [(9000 + i, [None, ""][i % 2] if i < 60 else of["void"], "void") for i in range(62)]
    rows += [(9900 + i % 2, of["some"], "some") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language_ppm.fit(docs, per_language=3, longest=1000)
    assert model.names == sorted(of)
    texts = {lang: [text] * {"void": 2, "some": 2}.get(lang, 3) for lang, text in of.items()}
    texts["long"] = [plain_pieces(of["long"], 8000 + i, 1000) for i in range(3)]
    want = language_ppm.counts_of(texts)
    for got, plain in zip(model.windows, want.windows, strict=True):
        assert all((g == p).all() for a, b in zip(got, plain, strict=True) for g, p in zip(a, b, strict=True))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_ppm.predict(docs, model).collect()}
    assert all(found[i][0] == lang for i, text, lang in rows if text)
    monkeypatch.setattr(language_ppm, "BLOCK_ENTRIES", 5000)
    assert len(list(model.blocks())) > 5 and sum((b.names for b in model.blocks()), []) == model.names
    parts = list(text_slices(pa.array([t for _, t, _ in rows])))
    whole = language_ppm._trees(model.names, model.windows)
    for part in parts:
        bits = language_ppm._code_lengths(part, whole, whole.places())
        best, first = language_ppm._Best(len(part)), 0
        for block in model.blocks():
            best.add(slice(0, len(part)), language_ppm._code_lengths(part, block, block.places()), first)
            first += len(block.names)
        assert (best.at == bits.argmin(1)).all() and (best.bits == bits.min(1)).all()
        assert best.sum == pytest.approx(np.exp2(np.clip(bits.min(1, keepdims=True) - bits, -1000, 0)).sum(1))


def test_fit_brings_no_texts_to_the_driver(spark, monkeypatch):
    """Texts of 6 MB with few windows: the driver gets a few kilobytes."""
    rows = [(i, "abc def " * 6000 + "xyz"[i % 3], "uvw"[i % 3]) for i in range(128)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    got = []
    for name in ("collect", "toLocalIterator"):
        real = getattr(type(docs), name)
        monkeypatch.setattr(type(docs), name, lambda df, *a, real=real: got.extend(real(df, *a)) or iter(got))
    model = language_ppm.fit(docs)
    monkeypatch.undo()
    assert got and sum(len(v) for r in got for v in r if isinstance(v, str | bytes | bytearray)) < 20_000
    want = language_ppm.counts_of({n: [t for _, t, lang in rows if lang == n] for n in "uvw"})
    assert model.names == want.names
    for levels, plain in zip(model.windows, want.windows, strict=True):
        assert all((g == p).all() for a, b in zip(levels, plain, strict=True) for g, p in zip(a, b, strict=True))


def test_samples_are_chosen_among_texts_and_read_long_ones(spark):
    """One class has long texts only, and most of its ids have no text."""
    rows = [(i, f"calm river {i % 7} " * 5, 0) for i in range(20)]
    rows += [(100 + i, f"vile brute {i % 7} " * 20_000 if i % 10 == 0 else [None, ""][i % 2], 1) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y int")
    known = df.selectExpr("doc_id", "y quality", "y toxic")
    ends = {0: "calm river", 100: "vile brute"}
    tests = spark.createDataFrame([(i, f"{t} 3 " * 10) for i, t in ends.items()], "doc_id long, text string")
    toxic = toxicity_ftrl.with_score(tests, toxicity_ftrl.fit(df, known, per_class=4)).collect()
    quality = quality_knn.score(tests, quality_knn.fit(df, known, per_class=4)).collect()
    for rows in (toxic, quality):
        score = {r.doc_id: r.score for r in rows}
        assert score[100] > 0.3 > score[0]


def test_counts_over_255_are_kept():
    rows, found, counts = toxicity_ftrl._counted(np.zeros(70_000, int), np.full(70_000, 5, np.int32))
    assert (rows.tolist(), found.tolist(), counts.tolist()) == ([0], [5], [70_000])


def test_odd_rows_and_empty_tables(spark, odd):
    known = odd.select("doc_id", "y").selectExpr("doc_id", "y % 2 quality", "y % 2 toxic")
    q = {r.doc_id: r.score for r in quality_knn.score(odd, quality_knn.fit(odd, known)).collect()}
    model = toxicity_ftrl.fit(odd, known, longest=400_000)
    t = toxicity_ftrl.with_score(odd, model).collect()
    assert t[0].asDict().keys() == {"doc_id", "text", "lang", "y", "score"}
    t = {r.doc_id: r.score for r in t}
    lang = {r.doc_id: (r.lang_pred, r.score) for r in language_ppm.predict(odd, language_ppm.fit(odd)).collect()}
    assert len(q) == len(t) == len(lang) == len(ODD)
    assert q[7] == q[8] and t[7] == t[8] and t[0] == t[1]
    assert all(lang[i] == ("und", 0) for i in (0, 1, 2, 9)) and lang[7] == ("en", 1)
    none = odd.limit(0)
    assert {r.score for r in quality_knn.score(odd, quality_knn.fit(none, known)).collect()} == {0.0}
    assert {r.score for r in toxicity_ftrl.with_score(odd, toxicity_ftrl.fit(none, known)).collect()} == {0.0}
    assert {r.lang_pred for r in language_ppm.predict(odd, language_ppm.fit(none)).collect()} == {"und"}
    assert quality_knn.score(none, quality_knn.fit(odd, known)).count() == 0
    assert toxicity_ftrl.with_score(none, model).count() == 0
    assert language_ppm.predict(none, language_ppm.fit(odd)).count() == 0


def plain_finish(x):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ x >> 33) * factor % 2**64
    return x ^ x >> 33


def plain_hash(word):
    value = sum(plain_finish(b + 1) * pow(0x9E3779B97F4A7C15, i, 2**64) for i, b in enumerate(word))
    return plain_finish((value + len(word)) % 2**64)


def plain_features(text):
    """Hashed words, beginnings and pairs of a text, with log2(1 + count)."""
    words = [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]
    keys = [plain_hash(w) for w in words]
    found = [plain_finish(k) for k in keys]
    for size in toxicity_ftrl.BEGINNINGS:
        found += [plain_finish((plain_hash(w[:size]) + (size << 32)) % 2**64) for w in words]
    for distance in toxicity_ftrl.PAIR_DISTANCES:
        for x, y in zip(keys, keys[distance:], strict=False):
            found.append(plain_finish((x * (2 * distance + 1) + plain_finish(y)) % 2**64))
    return Counter(f >> 64 - toxicity_ftrl.BITS for f in found)


def plain_ftrl(examples, how):
    """FTRL-proximal one coordinate at a time, in the operator's order of examples."""
    z, n, bias = defaultdict(float), defaultdict(float), -1

    def weight(i):
        reach = abs(z[i]) - (0 if i == bias else how.l1)
        return 0.0 if reach <= 0 else -math.copysign(reach, z[i]) / ((how.beta + math.sqrt(n[i])) / how.alpha + how.l2)

    order = np.random.default_rng(0)
    for _ in range(how.epochs):
        for k in order.permutation(len(examples)):
            y, counts = examples[k]
            values = {i: math.log2(1 + c) for i, c in counts.items()} | {bias: 1.0}
            w = {i: weight(i) for i in values}
            error = 1 / (1 + math.exp(-sum(w[i] * x for i, x in values.items()))) - y
            for i, x in values.items():
                g = error * x
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / how.alpha * w[i]
                n[i] += g * g
    return {i: w for i in z if i != bias and (w := weight(i))}, weight(bias)


def test_ftrl_agrees_with_a_plain_version(spark):
    rng = random.Random(11)
    clean, bad = [f"good{i}" for i in range(25)] + ["Été", "x1"], ["scum", "Idiot", "trash-talk", "verylongbadword"]
    rows = []
    for i in range(60):
        words = rng.choices(clean, k=rng.randint(3, 40)) + rng.choices(bad, k=rng.randint(1, 4)) * (i % 3 == 0)
        rng.shuffle(words)
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    df = spark.createDataFrame([*rows, (90, None), (91, "")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    how = toxicity_ftrl.Ftrl(l1=0.3)
    model = toxicity_ftrl.fit(df, labels, how=how)
    examples = [(int(i % 3 == 0), plain_features(t)) for i, t in rows]

    def key(example):
        found = sorted(example[1].items())
        return example[0], *(np.array(c, d).tobytes() for c, d in zip(zip(*found, strict=True), ("<i4", "<u4"), strict=True))

    weights, bias = plain_ftrl(sorted(examples, key=key), how)  # the sample has the shares of all labels
    assert set(model.features.tolist()) == set(weights) and len(weights) > 20
    assert all(w == pytest.approx(weights[f], rel=1e-4, abs=1e-6) for f, w in zip(model.features.tolist(), model.weights.tolist(), strict=True))
    assert model.bias == pytest.approx(bias, rel=1e-6)
    scores = {r.doc_id: r.score for r in toxicity_ftrl.with_score(df, model, keep=["doc_id"]).collect()}
    for i, text in [*rows, (90, None), (91, "")]:
        total = bias + sum(weights.get(f, 0) * math.log2(1 + c) for f, c in plain_features(text).items())
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-5)


def test_score_may_not_take_the_name_of_a_column(spark):
    df = spark.createDataFrame([(1, "a", 0.5)], "doc_id long, text string, score double")
    model = toxicity_ftrl.Model(np.zeros(0, np.int32), np.zeros(0, np.float32), 0.0)
    with pytest.raises(ValueError, match="score"):
        toxicity_ftrl.with_score(df, model)
    out = toxicity_ftrl.with_score(df, model, score="toxicity")
    assert [tuple(r) for r in out.collect()] == [(1, "a", 0.5, 0.5)]
