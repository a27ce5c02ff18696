"""Language identification by prediction by partial matching on bytes.

Every language has a context tree: how often each byte followed each context of up to ORDER bytes. A byte's
probability is its share in the longest context that has seen it; for every longer context that knows other bytes only
an escape probability is paid (method C: distinct followers / (followers + distinct followers)), and below the empty
context all 256 bytes are alike. The statistics are frozen before scoring, so a text's code length in a language is an
exact sum over its bytes, and the language with the shortest code is predicted. Texts are read as UTF-8 with upper-case
ASCII and Latin-1 letters made lower case, each after ORDER line feeds.

The trees are fitted on a bounded sample of every language: at most `per_language` documents that have a text, of
which at most `longest` characters are read, of longer ones in pieces that spread over the text. Trees are laid out as tables a block of languages at a time, so that
many languages need no more memory in a task than a few. The sample's windows are counted in tasks and summed by a
shuffle; the driver gets each language's distinct windows with their counts, never a text. Nothing is shuffled for scoring, and every whole text is read.

Null texts and texts without a letter are `und` with score 0, as is every text if there is nothing to learn from.
Equal code lengths go to the language that sorts first. Repeated rows get the same answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import map_arrow, spread_pieces, written
from snapmart.llm.text import Slice, text_slices

ORDER = 3
PER_LANGUAGE = 800
LONGEST = 50_000

#: Entries (windows x languages) of a block's tables; a block has one language at least.
BLOCK_ENTRIES = 1 << 26

#: Bytes of texts that are scored together if there are several blocks, and code lengths that are found at a time.
GROUP_BYTES = 1 << 25
COSTS = 1 << 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _bytes(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """The rows' bytes in lower case with ORDER line feeds before each row, and where each row's own bytes begin."""
    n = len(part)
    data = _LOWER[part.data]
    if len(data):
        latin = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[1:][latin] += 32
    sizes = np.diff(part.offsets)
    out = np.full(len(data) + ORDER * n, 10, np.uint8)
    out[np.arange(len(data)) + ORDER * np.repeat(np.arange(1, n + 1), sizes)] = data
    return out, part.offsets[:-1] + ORDER * np.arange(1, n + 1)


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """The windows of `size` bytes as numbers; the window at i begins with byte i."""
    out = np.zeros(max(len(data) - size + 1, 0), np.uint32)
    for k in range(size):
        out = (out << np.uint32(8)) | data[k : k + len(out)]
    return out


class Places:
    """Places of known numbers in an ascending list; -1 for others. Exact for any list."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.high, self.low = np.unique(known >> np.uint32(16)), np.unique(known & np.uint32(0xFFFF))
        self.dense = None
        if (len(self.high) + 1) * (len(self.low) + 1) <= 1 << 24:
            self.dense = np.full((len(self.high) + 1, len(self.low) + 1), -1, np.int32)
            self.row, self.column = (np.full(1 << 16, len(x), np.int32) for x in (self.high, self.low))
            self.row[self.high] = np.arange(len(self.high))
            self.column[self.low] = np.arange(len(self.low))
            self.dense[self.row[known >> np.uint32(16)], self.column[known & np.uint32(0xFFFF)]] = np.arange(len(known))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            return self.dense[self.row[keys >> np.uint32(16)], self.column[keys & np.uint32(0xFFFF)]]
        if not len(self.known):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        return np.where(self.known[at] == keys, at, -1).astype(np.int32)


@dataclass(frozen=True)
class Level:
    """One order of all languages' trees: windows that some language knows with their code lengths, and contexts with
    the bits of an escape from them."""

    windows: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray


@dataclass(frozen=True)
class Model:
    names: list[str]
    levels: list[Level]

    def cost(self, keys: np.ndarray, order: int, places: list[tuple[Places, Places]]) -> np.ndarray:
        """Code lengths, by language, of the last byte of each window of `order` + 1 bytes."""
        if order < 0:
            return np.full((len(keys), len(self.names)), 8.0, np.float32)
        level, (window, context) = self.levels[order], places[order]
        at = window(keys)
        out = level.bits[at] if len(level.bits) else np.zeros((len(keys), len(self.names)), np.float32)
        new = np.flatnonzero(at < 0)
        if len(new):
            shorter = keys[new] & np.uint32((1 << 8 * order) - 1)
            out[new] = self.cost(shorter, order - 1, places)
            before = context(keys[new] >> np.uint32(8))
            known = np.flatnonzero(before >= 0)
            out[new[known]] += level.escape[before[known]]
        return out

    def places(self) -> list[tuple[Places, Places]]:
        return [(Places(x.windows), Places(x.contexts)) for x in self.levels]


@dataclass(frozen=True)
class Counts:
    """For each language, ascending, how often the windows of 1 to ORDER + 1 bytes come: by order, the windows that do,
    ascending, and their counts."""

    names: list[str]
    windows: list[list[tuple[np.ndarray, np.ndarray]]]

    def blocks(self) -> Iterator[Model]:
        """Trees of all languages in the order of their names, a block of them at a time."""
        first, total = 0, 0
        for k, levels in enumerate(self.windows):
            size = sum(len(known) for known, _ in levels)
            if k > first and (total + size) * (k + 1 - first) > BLOCK_ENTRIES:
                yield _trees(self.names[first:k], self.windows[first:k])
                first, total = k, 0
            total += size
        if self.names:
            yield _trees(self.names[first:], self.windows[first:])

    @cached_property
    def single(self) -> list[tuple[Model, list[tuple[Places, Places]]]]:
        """The block with its places if one block holds all languages, else nothing; kept for a worker's next tasks."""
        blocks = list(islice(self.blocks(), 2))
        return [(x, x.places()) for x in blocks] if len(blocks) == 1 else []


def counted(part: Slice, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of `order` + 1 bytes of a slice's rows, and how often each comes."""
    data, first = _bytes(part)
    ends = np.concatenate([first[1:] - ORDER, [len(data)]])
    own = np.concatenate([np.arange(a, b) for a, b in zip(first, ends, strict=True)] or [np.zeros(0, int)])
    return np.unique(_grams(data, order + 1)[own - order], return_counts=True)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of several parts, ascending, with the sums of their counts."""
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    windows, at = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
    return windows, np.bincount(at, np.concatenate([n for _, n in parts]), len(windows)).astype(np.int64)


def counts_of(texts: dict[str, list[str]]) -> Counts:
    names = sorted(texts)
    slices = {n: list(text_slices(pa.array(texts[n], pa.string()))) for n in names}
    return Counts(names, [[_summed([counted(x, k) for x in slices[n]]) for k in range(ORDER + 1)] for n in names])


def build(texts: dict[str, list[str]]) -> Model:
    """Frozen trees of the languages, in the order of their names."""
    counts = counts_of(texts)
    return _trees(counts.names, counts.windows)


def _trees(names: list[str], counts: list[list[tuple[np.ndarray, np.ndarray]]]) -> Model:
    model = Model(names, [])
    places: list[tuple[Places, Places]] = []
    for order in range(ORDER + 1) if names else ():
        windows = np.unique(np.concatenate([levels[order][0] for levels in counts]))
        contexts = np.unique(windows >> np.uint32(8))
        escape = np.zeros((len(contexts), len(names)), np.float32)
        bits = np.empty((len(windows), len(names)), np.float32)
        lower = model.cost(windows & np.uint32((1 << 8 * order) - 1), order - 1, places)
        of = np.searchsorted(contexts, windows >> np.uint32(8))
        for k, levels in enumerate(counts):
            known, count = levels[order]
            at = np.searchsorted(contexts, known >> np.uint32(8))
            total = np.bincount(at, count, len(contexts))
            distinct = np.bincount(at, minlength=len(contexts))
            seen = total > 0
            escape[seen, k] = np.log2((total[seen] + distinct[seen]) / distinct[seen])
            bits[:, k] = lower[:, k] + escape[of, k]
            bits[np.searchsorted(windows, known), k] = np.log2((total + distinct)[at] / count)
        model.levels.append(Level(windows, bits, contexts, escape))
        places.append((Places(windows), Places(contexts)))
    return model


def _sample(docs: DataFrame, per_language: int, longest: int) -> DataFrame:
    """lang and text of the documents that are learned: rows with a language, an id and a text that isn't empty."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0))
    known = written(usable.select("doc_id", "lang").distinct(), "languages")
    sizes = known.groupBy("lang").count()
    place = F.xxhash64("doc_id")
    order = Window.partitionBy("lang").orderBy(place, "doc_id")
    # Hashes below a share of their range, for twice the documents wanted: so a frequent language isn't ranked whole.
    # A language of few documents is ranked whole, as a share of them could be none.
    share = F.when(F.col("count") <= 16 * per_language, 1.0).otherwise(2.0 * per_language / F.col("count"))
    chosen = (
        known.join(F.broadcast(sizes), "lang")
        .where((place.cast("double") + 2.0**63) <= share * 2.0**64)
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= per_language)
        .select("doc_id", F.col("lang").alias("of"))
    )
    return (
        usable.select("doc_id", "text", "lang")
        .join(F.broadcast(chosen), "doc_id")
        .where(F.col("lang") == F.col("of"))
        .withColumn("text", spread_pieces(F.col("text"), F.col("doc_id"), longest))
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))  # one text for an id that rows repeat
        .select("lang", "text")
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each window comes in the texts of a language (lang, text); its size is above the lower 32 bits."""
    for batch in batches:
        for lang in pc.unique(batch.column(0)):
            for part in text_slices(batch.column(1).filter(pc.equal(batch.column(0), lang))):
                for order in range(ORDER + 1):
                    windows, n = counted(part, order)
                    keys = windows.astype(np.int64) | order << 32
                    langs = pa.repeat(lang, len(keys))
                    yield pa.RecordBatch.from_arrays([langs, pa.array(keys), pa.array(n)], names=["lang", "window", "n"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows and counts of a language and order as 32-bit numbers, eight bytes for each."""
    for batch in batches:
        names = pc.unique(batch.column(0))
        keys, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        of = pc.index_in(batch.column(0), names).to_numpy() * (ORDER + 1) + (keys >> 32)
        place = np.argsort(of, kind="stable")
        groups, first = np.unique(of[place], return_index=True)
        spans = list(zip(first, [*first[1:], len(of)], strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(groups // (ORDER + 1))),
                pa.array(groups % (ORDER + 1), pa.int32()),
                *(pa.array([x[place[a:b]].astype("<u4").tobytes() for a, b in spans], pa.binary()) for x in (keys, n)),
            ],
            names=["lang", "ord", "windows", "counts"],
        )


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, longest: int = LONGEST) -> Counts:
    """Counts of the languages in `docs` (doc_id, text, lang); rows without a language, an id or a text take no part."""
    found = map_arrow(_sample(docs, per_language, longest), _count, "lang string, window long, n long")
    summed = found.groupBy("lang", "window").agg(F.sum("n").alias("n"))
    packed = map_arrow(summed, _pack, "lang string, ord int, windows binary, counts binary")
    parts: dict[str, list[list[tuple[np.ndarray, np.ndarray]]]] = {}
    for row in packed.toLocalIterator():
        levels = parts.setdefault(row["lang"], [[] for _ in range(ORDER + 1)])
        levels[row["ord"]].append((np.frombuffer(row["windows"], "<u4"), np.frombuffer(row["counts"], "<u4")))
    names = sorted(parts)
    return Counts(names, [[_summed(level) for level in parts[n]] for n in names])


def _code_lengths(part: Slice, model: Model, places: list[tuple[Places, Places]]) -> np.ndarray:
    data, first = _bytes(part)
    sums = np.zeros((len(part), len(model.names)))
    keys = _grams(data, ORDER + 1)
    rows = np.repeat(np.arange(len(part)), np.diff(part.offsets))
    own = np.arange(len(rows)) + ORDER * rows  # the window before each own byte, with that byte last
    step = max(1, COSTS // len(model.names))
    for a in range(0, len(own), step):
        at = own[a : a + step]
        # Windows that are not in any tree are few; their cost follows the escapes down.
        cost = model.cost(keys[at], ORDER, places)
        cuts = np.flatnonzero(np.diff(rows[a : a + step], prepend=-1))
        sums[rows[a : a + step][cuts]] += np.add.reduceat(cost, cuts, axis=0, dtype=float)
    return sums


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """The batches, as many together as have `size` bytes."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


class _Best:
    """The shortest code of each row so far: the language's place, its bits, and the sum of 2 ** (its bits - bits)."""

    def __init__(self, n: int):
        self.at, self.bits, self.sum = np.zeros(n, int), np.full(n, np.inf), np.zeros(n)

    def add(self, span: slice, bits: np.ndarray, first: int) -> None:
        """Code lengths of the languages from place `first` on."""
        old, low = self.bits[span], bits.min(1)
        new = np.minimum(old, low)
        self.at[span] = np.where(low < old, first + bits.argmin(1), self.at[span])
        # Before any language the sum is 0, and what it would be moved by is infinite.
        self.sum[span] *= np.exp2(np.clip(new - old, -1000, 0))
        self.sum[span] += np.exp2(np.clip(new[:, None] - bits, -1000, 0)).sum(1)
        self.bits[span] = new


def predict(docs: DataFrame, model: Counts) -> DataFrame:
    """doc_id, lang_pred and score (the language's share of 2 ** -bits over all languages) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.names, "und"], object)
        for group in _groups(batches, 0 if known.single else GROUP_BYTES):
            found = [_Best(batch.num_rows) for batch in group]
            first = 0
            for block, places in known.single or ((x, x.places()) for x in known.blocks()):
                for batch, best in zip(group, found, strict=True):
                    for part in text_slices(batch.column(1)):
                        span = slice(part.first, part.first + len(part))
                        best.add(span, _code_lengths(part, block, places), first)
                first += len(block.names)
            for batch, best in zip(group, found, strict=True):
                letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool) & (len(known.names) > 0)
                place = np.where(letters, best.at, len(known.names))
                score = np.where(letters, 1 / np.maximum(best.sum, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(names[place], pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"],
                )

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    schema = docs.select("doc_id", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return map_arrow(docs.select("doc_id", "text", has_letter.alias("letters")), run, schema)
