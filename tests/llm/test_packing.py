"""Packing: ids, windows, checksums and a whole rebuild of the stream."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from snapmart.llm import packing

TEXTS = ["hello world", None, "", "x" * 3000, "a b\nc\t é😀 " * 900, "hello world", " " * 5000, "<|endoftext|> it's", "12 345", "a  <|endoftext|><|endoftext|>  b\n\n<|endoftext|", " <|endoftext|> "]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("window", [64, 2048])
def test_pieces_rebuild_the_stream(spark, tokenizer, window):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    pieces = packing.pack(df, window).collect()
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(TEXTS)}
    fill = {}
    done = {i: 0 for i in ids}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill.get(p.sequence_id, 0)
        fill[p.sequence_id] = p.offset + p.length
        assert p.doc_tokens == len(ids[p.doc_id])
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert p.start == done[p.doc_id] and len(part) == p.length > 0
        done[p.doc_id] += p.length
        assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert done == {i: len(x) for i, x in ids.items()}
    assert sorted(fill) == list(range(len(fill)))
    assert all(n == window for s, n in fill.items() if s != len(fill) - 1)


def test_null_ids_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a"), (1, "a")], "doc_id long, text string")
    assert packing.pack(df).count() == 4
    assert packing.pack(df.limit(0)).count() == 0


def test_ids_are_those_of_the_tokenizers_library(spark, tokenizer):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rng = random.Random(6)
    parts = ["<|endoftext|>", "<|endoftext", " ", "  ", "\n", "\t", "it's", "é", "日本", "123", "!!", "a", "B", "\u00a0"]
    texts = [r.text for r in given] + ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    encoder = packing.encoder("byte_bpe_50k.tiktoken")
    for text in texts:
        ids = encoder.encode_to_numpy(text or "", allowed_special="all").tolist()
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids, text
