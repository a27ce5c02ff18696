"""Packing: concatenate all documents' tokens and cut the stream into fixed windows.

Pass one turns each document into token ids and writes them with the document's place in its partition: the
partition's number and the tokens before it there. Pass two sums the partitions' totals in order, which gives every
partition its global offset, and cuts each document where the global stream crosses a multiple of the window. Only
one number per partition goes through the driver. No row is shuffled in either pass; the places are part of the written
table, so a retried task or another split of the files gives the same windows.

A text that holds the vocabulary's special token has that token's id there, as in the tokenizers library. Null and empty texts are one end-of-document id. Repeated rows are packed as often as they come. A document longer
than a window is cut freely. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.llm.common import map_arrow, written

WINDOW = 2048
END_ID = 1

#: Fixed value: the special token of the vocabulary, whose id is the one after the merged pieces.
END_OF_TEXT = "<|endoftext|>"

#: Spark's column batches hold many texts; so many bytes are encoded at once.
ENCODE_BYTES = 4 << 20

_encoders: dict[str, object] = {}


def encoder(name: str):
    """The byte-level BPE of the public vocabulary file `name`, as the library that reads it fastest has it.

    The file `byte_bpe_50k.tiktoken` holds the vocabulary of `byte_bpe_50k.json`; tests hold the ids against it.
    """
    if name not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _encoders[name] = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)}
        )
    return _encoders[name]


def tokenized(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """doc_id, ids (little-endian unsigned 16-bit), n, part, start: the tokens before the document in its partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, tokens = TaskContext.get().partitionId(), 0, encoder(vocabulary)
        for batch in batches:
            at, texts = 0, batch.column(1)
            while at < len(texts):
                ids, size, first = [], 0, at
                while at < len(texts) and (size < ENCODE_BYTES or at == first):
                    text = texts[at].as_py() or ""
                    ids.append(np.append(tokens.encode_to_numpy(text, allowed_special="all"), END_ID).astype("<u2"))
                    size, at = size + len(text), at + 1
                n = np.array([len(x) for x in ids], np.int64)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(ids)),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                        pa.array(n),
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(starts),
                    ],
                    names=["doc_id", "ids", "n", "part", "start"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, encode, "doc_id long, ids binary, n long, part int, start long")


_PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *[
            T.StructField(name, T.LongType(), False)
            for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        ],
    ]
)


def pack(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per piece of a document in a window (boundary record), with a checksum of its ids."""
    tokens = written(tokenized(docs), "packing")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    offsets, before = {}, 0
    for row in totals:
        offsets[row["part"]], before = before, before + row["n"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, ids, n, part, start = batch.columns
            n = n.to_numpy()
            if not len(n):
                continue
            begin = start.to_numpy() + np.array([offsets[p] for p in part.to_pylist()], np.int64)
            first, last = begin // window, (begin + n - 1) // window
            pieces = last - first + 1
            row = np.repeat(np.arange(len(n)), pieces)
            which = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[row] + which
            low = np.maximum(sequence * window, begin[row])
            high = np.minimum((sequence + 1) * window, (begin + n)[row])
            inside = low - begin[row]
            sums, at, wide = np.empty(len(row), np.int64), -1, None
            for k in range(len(row)):
                if row[k] != at:
                    at = row[k]
                    wide = np.frombuffer(ids[at].as_buffer(), "<u2").astype("<u4")
                sums[k] = zlib.crc32(wide[inside[k] : inside[k] + high[k] - low[k]])
            yield pa.RecordBatch.from_arrays(
                [
                    doc.take(pa.array(row)),
                    *[pa.array(x) for x in (inside, high - low, sums, n[row], sequence, low - sequence * window)],
                ],
                names=_PIECES.names,
            )

    return map_arrow(tokens, cut, _PIECES)
