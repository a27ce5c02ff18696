"""SentencePiece: ids as the library has them, giant texts by the scan, exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from snapmart.llm import piece_scan

NAME = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=public_tokenizers.path(NAME))


def texts():
    rng = random.Random(5)
    out = [None, "", " ", "a", "hello world", "hello world", "▁ mark", "\n\n tab\t", "é日本😀" * 30, " " * 400, "a" * 700]
    for alphabet in ("aeinrst", "theansdor ", "01 2", "é日😀a \n\tb", "abcdefghijklmnopqrstuvwxyz", "=-_ #"):
        out += ["".join(rng.choices(alphabet, k=rng.choice([5, 90, 600]))) for _ in range(6)]
    return out


@pytest.mark.parametrize(("chunk", "run"), [(32, 3), (41, 64), (1 << 16, 64)])
def test_ids_and_texts_agree_with_the_library(spark, library, monkeypatch, chunk, run):
    monkeypatch.setattr(piece_scan, "RUN", run)
    rows = [(i, t, 7) for i, t in enumerate(texts())]
    encoded = piece_scan.encode(spark.createDataFrame(rows, "doc_id long, text string, chunk int"), NAME, chunk)
    ids, back = {}, {}
    for r in sorted(encoded.collect(), key=lambda r: (r.doc_id, r.chunk)):
        ids.setdefault(r.doc_id, []).extend(r.ids)
    for r in sorted(piece_scan.decode(encoded, NAME).collect(), key=lambda r: (r.doc_id, r.chunk)):
        back[r.doc_id] = back.get(r.doc_id, "") + r.text
    for i, text, _ in rows:
        assert ids[i] == (library.encode(text) if text else [])
        assert back[i] == (text or "").replace(piece_scan.MARK, " ")


def test_given_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r.doc_id: r for r in piece_scan.checksums(docs).collect()}
    for r in docs.collect():
        ids = library.encode(r.text or "")
        got = found[r.doc_id]
        assert (got.n_ids, got.n_chars) == (len(ids), len(r.text or ""))
        assert got.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_null_ids_repeats_and_empty_table(spark):
    long = "x y " * 60
    df = spark.createDataFrame([(None, long), (None, long), (1, "a")], "doc_id long, text string")
    rows = piece_scan.encode(df, NAME, 64).collect()
    assert sum(r.chunk == 0 for r in rows) == 3
    assert {r.chunks for r in rows if r.doc_id is None} == {4}
    assert piece_scan.encode(df.limit(0), NAME, 64).count() == 0
    with pytest.raises(ValueError, match="characters"):
        piece_scan.encode(df, NAME, 8)


@pytest.mark.parametrize("chunk", [512, 1 << 16])
def test_decoded_text_of_the_whole_table_is_the_source_text(spark, chunk):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {}
    for r in sorted(piece_scan.checksums(docs, chunk=chunk).collect(), key=lambda r: (r.doc_id, r.chunk)):
        found.setdefault(r.doc_id, []).append(r)
    rows = docs.collect()
    assert len(found) == len(rows)
    for r in rows:
        text, at = (r.text or "").replace(piece_scan.MARK, " "), 0
        for got in found[r.doc_id]:
            assert got.text_crc32 == zlib.crc32(text[at : at + got.n_chars].encode())
            at += got.n_chars
        assert at == len(text)
