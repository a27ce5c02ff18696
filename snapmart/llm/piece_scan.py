"""SentencePiece encoding and decoding; giant documents by a max-plus parallel scan.

A byte-pair encoding is the one segmentation in which every piece encodes as itself and any two neighbours encode as
these two. In the max-plus algebra that is a path of score 0 in the lattice of all vocabulary pieces, where two pieces
that can't be neighbours are joined by minus infinity. A text of up to CHUNK characters is one chunk, encoded piece of
text by piece of text between word marks, which no vocabulary piece spans. A longer text is split into chunks that carry
a margin of one longest piece:

1. Each chunk gives its transfer matrix: which pieces over its first boundary can be followed, within it, by which
   pieces over its last one (0 or minus infinity, kept as bit sets).
2. The product of such matrices is associative. Runs of RUN chunks are multiplied first, then the runs' products of a
   document (a text's size limits their number), and then the boundary pieces go back down to the chunks.
3. Each chunk, now knowing the pieces over both its boundaries, finds its own path.

As no piece spans the beginning of a word, the lattice is only needed up to a chunk's first and from its last one.

Texts become pieces as the library has it: spaces are word marks, one mark comes first, and a character that is not in
the vocabulary is its UTF-8 bytes. Decoding gives the text back, with a word mark character read as a space. Null and
empty texts have no ids. Repeated rows are encoded as often as they come. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import map_arrow, ship, written

CHUNK = 1 << 16
RUN = 64
MARK = "▁"

#: Entries of a worker's memory of encoded pieces of text; it is emptied when full.
REMEMBERED = 1 << 20

_NEVER = float("-inf")

#: Word marks and what follows them: no vocabulary piece has a mark after anything else.
_BEGIN = re.compile(f"[^{MARK}](?={MARK})")
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _word_begins(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The first and the last place between two places of a text where a word begins."""
    first = next((m.start() + 1 for m in _BEGIN.finditer(text, start, end)), None)
    if first is None:
        return None
    last = text.rfind(MARK, first, end)
    while text[last - 1] == MARK:
        last -= 1
    return first, max(first, last)


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """The encoder of a public vocabulary file, kept by the worker process."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]


class Encoder:
    """Pieces, their scores, and what can stand beside what. Unknown characters have the id -1 - code point."""

    def __init__(self, name: str):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=public_tokenizers.path(name))
        size = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.utf8 = [bytes([self.byte_of[i]]) if i in self.byte_of else p.encode() for i, p in enumerate(self.pieces)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i] and i not in self.byte_of}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.valid = {p for p in self.ids if self.merged(p) == [p]}
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, list[int]] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging the neighbours with the best score, the first among equals."""
        parts, score = list(text), self.scores.get
        pairs = [score(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (top := max(pairs)) > _NEVER:
            k = pairs.index(top)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = score(parts[k - 1] + parts[k], _NEVER)
            if k < len(pairs):
                pairs[k] = score(parts[k] + parts[k + 1], _NEVER)
        return parts

    def beside(self, a: str, b: str) -> bool:
        """Whether a and b are neighbours of score 0; the first piece of a text has the empty one before it."""
        if not a:
            return True
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) >= REMEMBERED:
                self.fits.clear()
            known = self.fits[a, b] = self.merged(a + b) == [a, b]
        return known

    def starting(self, text: str, at: int) -> list[str]:
        """Pieces that begin at a place and encode as themselves: one character, or longer ones of the vocabulary."""
        out = [text[at]]
        for end in range(at + 2, min(len(text), at + self.longest) + 1):
            piece = text[at:end]
            if piece in self.valid:
                out.append(piece)
        return out

    def over(self, text: str, at: int) -> list[tuple[int, str]]:
        """Pieces (start, piece) that begin before a place and end at it or beyond, in a fixed order."""
        return [
            (s, p)
            for s in range(max(0, at - self.longest), at)
            for p in self.starting(text, s)
            if s + len(p) >= at
        ]

    def forward(self, text: str, begin: list[tuple[int, str]], end: int) -> list[dict[str, int]]:
        """Lattice from the boundary pieces `begin` to `end`: for each place, the pieces that begin there and the bit
        set of boundary pieces from which a path of score 0 reaches them. Boundary pieces are pieces of the lattice."""
        reach: list[dict[str, int]] = [{} for _ in range(end)]
        arriving: dict[int, list[tuple[str, int]]] = {}
        for k, (s, p) in enumerate(begin):
            arriving.setdefault(s + len(p), []).append((p, 1 << k))
        first = min(arriving, default=end)
        for at in range(first, end):
            before = arriving.pop(at, ())
            if not before:
                continue
            for piece in self.starting(text, at):
                bits = 0
                for p, b in before:
                    if self.beside(p, piece):
                        bits |= b
                if bits:
                    reach[at][piece] = bits
                    arriving.setdefault(at + len(piece), []).append((piece, bits))
        return reach

    def transfer(self, text: str, start: int, end: int, first: bool) -> list[int]:
        """Transfer matrix of a chunk text[start:end]: for each boundary piece over `end` the bit set of those over
        `start` that reach it. A boundary piece may span the whole chunk and then reaches itself.

        No piece spans the beginning of a word, so every path passes there: only the parts before the chunk's first and
        after its last such place need the lattice.
        """
        begin = [(0, "")] if first else self.over(text, start)
        cut = _word_begins(text, start, end)
        if cut:
            through = 0
            for s, p in self.over(text, cut[0]):
                if s + len(p) == cut[0]:
                    through |= self.reached(text, begin, cut[0], s, p)
            begin, start = [(cut[1], "")], cut[1]
        reach = self.forward(text, begin, end)
        rows = []
        for s, p in self.over(text, end):
            if s >= start:
                row = reach[s].get(p, 0)
                rows.append(through if cut and row else row)
            else:
                rows.append(0 if cut else sum(1 << k for k, b in enumerate(begin) if b == (s, p)))
        return rows

    def reached(self, text: str, begin: list[tuple[int, str]], end: int, s: int, p: str) -> int:
        """The boundary pieces of `begin` from which a path ends with piece `p` at `s`."""
        own = sum(1 << k for k, b in enumerate(begin) if b == (s, p))
        return own | self.forward(text, begin, end)[s].get(p, 0)

    def path(self, text: str, start: int, end: int, before: tuple[int, str], after: tuple[int, str] | None) -> list[str]:
        """The pieces that begin in text[start:end], between the boundary pieces; None ends where `end` is."""
        at = before[0] + len(before[1])
        if after is None and at == end:
            return []
        reach = self.forward(text, [before], end)
        if after is None:
            s, p = next((s, p) for s, p in self.over(text, end) if s + len(p) == end and reach[s].get(p))
        else:
            s, p = after
        out: list[str] = []
        while s >= at:
            out.append(p)
            if s == at:
                break
            s, p = next(
                (q, r) for q, r in self.over(text, s) if q + len(r) == s and reach[q].get(r) and self.beside(r, p)
            )
        return out[::-1]

    def chunk_ids(
        self, text: str, start: int, end: int, before: tuple[int, str], after: tuple[int, str] | None
    ) -> list[int]:
        """Ids of the pieces that begin in a chunk: paths at its ends, whole words between them."""
        cut = (start, end) if after is None and not before[1] else _word_begins(text, start, end)
        if not cut:
            return self.ids_of(self.path(text, start, end, before, after))
        first, last = cut[0], end if after is None else cut[1]
        head = self.ids_of(self.path(text, start, first, before, None)) if before[1] or first > start else []
        tail = [] if after is None else self.ids_of(self.path(text, last, end, (last, ""), after))
        return head + self.words_ids(text[first:last]) + tail

    def ids_of(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            found = self.ids.get(p)
            if found is None:
                out += [self.bytes[b] for b in p.encode()]
            else:
                out.append(found)
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text of one chunk."""
        if not text:
            return []
        return self.words_ids(MARK + text.replace(" ", MARK))

    def words_ids(self, marked: str) -> list[int]:
        """Ids of whole words, each found once while it is remembered."""
        out: list[int] = []
        known = self.known
        for word in _WORD.findall(marked):
            ids = known.get(word)
            if ids is None:
                if len(word) <= 2 * self.longest:
                    pieces = self.merged(word)
                else:
                    pieces = self.path(word, 0, len(word), (0, ""), None)
                if len(known) >= REMEMBERED:
                    known.clear()
                ids = known[word] = self.ids_of(pieces)
            out += ids
        return out

    def decode(self, ids: list[int], first: bool = True) -> str:
        """The text of ids; `first` if they are a text's first ones, whose leading word mark is not part of it."""
        text = b"".join(map(self.utf8.__getitem__, ids)).decode(errors="replace").replace(MARK, " ")
        return text[1:] if first else text


_IDS = "doc_id long, chunk int, chunks int, ids array<int>"
_DIGEST = "doc_id long, chunk int, chunks int, n_ids long, ids_crc32 long, n_chars long, text_crc32 long"


def _rows(model: Encoder, places: list, numbers: list[int], ids: list[list[int]], digest: bool) -> pa.RecordBatch:
    """Encoded chunks, or only number and checksum of their ids, and length and checksum of the text that these give back."""
    if not digest:
        return pa.RecordBatch.from_arrays([*places, pa.array(ids, pa.list_(pa.int32()))], names=_IDS_NAMES)
    sizes = pa.array([len(x) for x in ids], pa.int64())
    sums = pa.array([zlib.crc32(np.array(x, "<u4")) for x in ids], pa.int64())
    lengths, text_sums = [], []
    for x, n in zip(ids, numbers, strict=True):
        text = model.decode(x, n == 0) if x else ""
        lengths.append(len(text))
        text_sums.append(zlib.crc32(text.encode()))
    back = pa.array(lengths, pa.int64()), pa.array(text_sums, pa.int64())
    return pa.RecordBatch.from_arrays([*places, sizes, sums, *back], names=_DIGEST_NAMES)


_IDS_NAMES = ["doc_id", "chunk", "chunks", "ids"]
_DIGEST_NAMES = ["doc_id", "chunk", "chunks", "n_ids", "ids_crc32", "n_chars", "text_crc32"]


def _short(docs: DataFrame, name: str, digest: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(name)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids = [model.encode(t.as_py() or "") for t in rows.column(1)]
                places = [rows.column(0), pa.array(np.zeros(len(ids), np.int32)), pa.array(np.ones(len(ids), np.int32))]
                yield _rows(model, places, [0] * len(ids), ids, digest)

    return map_arrow(docs, run, _DIGEST if digest else _IDS)


def _chunks(docs: DataFrame, chunk: int, margin: int) -> DataFrame:
    """row, doc_id, chunk, chunks, and the chunk's text with its margins, of which the left one has `left` characters."""
    marked = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.concat(F.lit(MARK), F.translate("text", " ", MARK)).alias("marked"),
    )
    size = F.length("marked")
    chunks = F.ceil(size / chunk).cast("int")
    parts = marked.select(
        "row", "doc_id", "marked", chunks.alias("chunks"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk")
    )
    left = F.least(F.col("chunk") * chunk, F.lit(margin))
    start = F.col("chunk") * chunk - left
    return parts.select(
        "row",
        "doc_id",
        "chunk",
        "chunks",
        left.cast("int").alias("left"),
        F.col("marked").substr(start + 1, left + chunk + margin).alias("part"),
    )


def _bounds(text: str, left: int, chunk: int, last: bool) -> tuple[int, int]:
    return left, len(text) if last else left + chunk


def _through(matrix: list[int], reached: int) -> int:
    """The pieces over a chunk's end that paths from a set of pieces over its start reach."""
    return sum(1 << k for k, row in enumerate(matrix) if row & reached)


def _product(first: list[int], then: list[int]) -> list[int]:
    """Max-plus product of two transfer matrices, rows by the last boundary: 0 where some path reaches, else nothing."""
    out = []
    for row in then:
        bits, k = 0, 0
        while row >> k:
            if row >> k & 1:
                bits |= first[k]
            k += 1
        out.append(bits)
    return out


def _packed(matrix: list[int]) -> list[str]:
    return [format(row, "x") for row in matrix]


def _unpacked(matrix) -> list[int]:
    return [int(row, 16) for row in matrix]


def _run_products(rows: pd.DataFrame) -> pd.DataFrame:
    """The product of a run of chunks' matrices."""
    rows = rows.sort_values("chunk")
    total = _unpacked(rows.matrix.iloc[0])
    for matrix in rows.matrix.iloc[1:]:
        total = _product(total, _unpacked(matrix))
    return pd.DataFrame({"row": [rows.row.iloc[0]], "run": [rows.run.iloc[0]], "matrix": [_packed(total)]})


def _boundaries(matrices: list[list[int]], first: int, last: int | None) -> list[int]:
    """The boundary piece after each of the matrices but the last, on the path from piece `first` to piece `last` (None:
    any, which is the single one over the end of a text that has a path)."""
    reached = [1 << first]
    for matrix in matrices:
        reached.append(_through(matrix, reached[-1]))
    at = reached[-1] if last is None else 1 << last
    out = []
    for matrix, before in zip(matrices[::-1], reached[-2::-1], strict=True):
        k = at.bit_length() - 1
        at = matrix[k] & before
        out.append(at.bit_length() - 1)
    return out[::-1][1:]


def _run_ends(rows: pd.DataFrame) -> pd.DataFrame:
    """For each run of a document the boundary pieces before and after it (-1 after the last)."""
    rows = rows.sort_values("run")
    middle = _boundaries([_unpacked(m) for m in rows.matrix], 0, None)
    return pd.DataFrame({"row": rows.row, "run": rows.run, "before": [0, *middle], "after": [*middle, -1]})


def _chunk_ends(rows: pd.DataFrame) -> pd.DataFrame:
    """For each chunk of a run the boundary pieces before and after it."""
    rows = rows.sort_values("chunk")
    first, last = int(rows.before.iloc[0]), int(rows.after.iloc[0])
    middle = _boundaries([_unpacked(m) for m in rows.matrix], first, None if last < 0 else last)
    return pd.DataFrame({"row": rows.row, "chunk": rows.chunk, "before": [first, *middle], "after": [*middle, last]})


def _giant(docs: DataFrame, name: str, chunk: int, margin: int, digest: bool) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    parts = written(_chunks(docs, chunk, margin).repartition("row", "chunk"), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(name)
        for batch in batches:
            out = []
            for number, chunks, left, part in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                start, end = _bounds(part, left, chunk, number == chunks - 1)
                rows = model.transfer(part, start, end, number == 0)
                if number == chunks - 1:  # only pieces that end with the text
                    ends = [s + len(p) == end for s, p in model.over(part, end)]
                    rows = [row if good else 0 for row, good in zip(rows, ends, strict=True)]
                out.append(_packed(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.string()))], names=["row", "chunk", "matrix"]
            )

    transfers = written(
        map_arrow(parts.select("row", "chunk", "chunks", "left", "part"), matrices, "row long, chunk int, matrix array<string>"),
        "transfers",
    ).withColumn("run", (F.col("chunk") / RUN).cast("int"))
    products = transfers.groupBy("row", "run").applyInPandas(_run_products, "row long, run int, matrix array<string>")
    ends = products.groupBy("row").applyInPandas(_run_ends, "row long, run int, before int, after int")
    boundaries = (
        transfers.join(ends, ["row", "run"])
        .groupBy("row", "run")
        .applyInPandas(_chunk_ends, "row long, chunk int, before int, after int")
    )

    def backtrace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(name)
        for batch in batches:
            out = []
            for number, chunks, left, part, before, after in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                start, end = _bounds(part, left, chunk, number == chunks - 1)
                first = (0, "") if number == 0 else model.over(part, start)[before]
                last = None if number == chunks - 1 else model.over(part, end)[after]
                if last is not None and last[0] < start:
                    out.append([])  # one piece spans the whole chunk
                    continue
                out.append(model.chunk_ids(part, start, end, first, last))
            yield _rows(model, batch.columns[:3], batch.column(1).to_pylist(), out, digest)

    rows = parts.join(boundaries, ["row", "chunk"]).select(
        "doc_id", "chunk", "chunks", "left", "part", "before", "after"
    )
    return map_arrow(rows, backtrace, _DIGEST if digest else _IDS)


def _encoded(docs: DataFrame, name: str, chunk: int, digest: bool) -> DataFrame:
    margin = encoder(name).longest
    if chunk < 2 * margin:
        raise ValueError(f"a chunk needs {2 * margin} characters at least")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    long = F.coalesce(F.length("text"), F.lit(0)) >= chunk
    short = _short(rows.where(~long), name, digest)
    return short.unionByName(_giant(rows.where(long), name, chunk, margin, digest))


def encode(docs: DataFrame, name: str = "piece_bpe_32k.model", chunk: int = CHUNK) -> DataFrame:
    """doc_id, chunk, chunks and ids: one row for each chunk of each document. A chunk must hold two longest pieces."""
    return _encoded(docs, name, chunk, digest=False)


def checksums(docs: DataFrame, name: str = "piece_bpe_32k.model", chunk: int = CHUNK) -> DataFrame:
    """doc_id, chunk, chunks, n_ids, ids_crc32 (of little-endian unsigned 32-bit ids), and n_chars and text_crc32 (of
    UTF-8) of the text that the chunk's ids give back, in one pass."""
    return _encoded(docs, name, chunk, digest=True)


def decode(encoded: DataFrame, name: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, chunk, chunks and text of encoded chunks; a document's text is its chunks' texts one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(name)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = [
                    model.decode(ids, number == 0)
                    for number, ids in zip(rows.column(1).to_pylist(), rows.column(3).to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:3], pa.array(texts, pa.string())], names=["doc_id", "chunk", "chunks", "text"]
                )

    rows = encoded.select("doc_id", "chunk", "chunks", "ids")
    return map_arrow(rows, run, "doc_id long, chunk int, chunks int, text string")
