"""Vectorised reading of text columns: words, their hashes and windows of them, straight from Arrow buffers.

Words are maximal runs of bytes other than space and \\t \\n \\x0b \\x0c \\r, or, where a function is told so, of
letters and digits (every byte from 128 on counts as a letter). A word's hash is a 64-bit hash of its bytes with A-Z
lower-cased. Nothing here depends on the order or grouping of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text is read in slices of about so many bytes; a longer text is read in blocks cut at white space.
SLICE_BYTES = 2 << 20

#: At most so many rows are in a slice.
SLICE_ROWS = 4096

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_NO_LETTER = np.ones(256, bool)
_NO_LETTER[128:] = False
for _first, _last in ("09", "AZ", "az"):
    _NO_LETTER[ord(_first) : ord(_last) + 1] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit of 64-bit values over all output bits (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_VALUE = mix(_LOWER.astype(np.uint64) + np.uint64(1))


class _Powers:
    """Powers of the base and of its inverse, grown on demand and kept by the worker process."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_INVERSE, k, 1 << 64))])
        return self.up, self.down


_powers = _Powers()


@dataclass
class Slice:
    """Some rows of a text column: row numbers from `first`, bytes of all rows, and where each row begins and ends."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def text_slices(
    column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS
) -> Iterator[Slice]:
    """The rows of a string column in slices of at most `limit` bytes, or of one row. Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        to = min(to, at + rows)
        yield Slice(at, raw[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
        at = to


def word_bounds(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of all words; no word reaches over the end of a row."""
    space = np.ones(len(data) + 1, bool)
    space[:-1] = gaps[data]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    word = ~space
    begins = word[:-1].copy()
    begins[1:] &= space[:-2]
    begins[inner] = word[inner]
    ends = word[:-1] & space[1:]
    cut = inner[inner > 0] - 1
    ends[cut] = word[cut]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _totals(data: np.ndarray) -> np.ndarray:
    up, _ = _powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=total[1:])
    return total


def _hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _powers.upto(len(total))
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: Kinds of bytes in a word's shape: symbols, marks, digits, upper case, other letters.
_SYMBOLS, _MARKS, _DIGITS, _UPPER = b"#*$%&|<>=@_/\\", b"!?", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LENGTHS = np.array([3, 6, 10, 16])
SHAPES = 128


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A code below SHAPES for each word: its case, whether it has symbols, marks and digits, and its length."""

    def count(kind: bytes) -> np.ndarray:
        flag = np.zeros(256, np.int32)
        flag[list(kind)] = 1
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum(flag[data], out=total[1:])
        return total[ends] - total[starts]

    length, upper = ends - starts, count(_UPPER)
    case = np.where(upper == 0, 0, np.where((upper >= 2) & (2 * upper >= length), 2, 1))
    code = case * 2 + (count(_SYMBOLS) > 0)
    code = (code * 2 + (count(_MARKS) > 0)) * 2 + (count(_DIGITS) > 0)
    return (code * 5 + np.searchsorted(_LENGTHS, length, "right")).astype(np.uint8)


@dataclass
class Words:
    """The words of a slice: hashes and each row's bounds among them; if asked for, shapes, and for some numbers of
    bytes the hashes of the words' beginnings (of the whole word if it is shorter)."""

    hashes: np.ndarray
    bounds: np.ndarray
    shapes: np.ndarray | None = None
    beginnings: tuple[np.ndarray, ...] = ()


def words_of(part: Slice, letters_only: bool = False, shapes: bool = False, begin: tuple[int, ...] = ()) -> Words:
    """All words of a slice. A text far beyond the slice limit is read block by block."""
    gaps = _NO_LETTER if letters_only else _SPACE

    def read(data: np.ndarray, offsets: np.ndarray) -> tuple:
        starts, ends = word_bounds(data, offsets, gaps)
        total = _totals(data)
        found = [_hashes(total, starts, ends), *(_hashes(total, starts, np.minimum(starts + k, ends)) for k in begin)]
        return starts, found, _shapes(data, starts, ends) if shapes else None

    if len(part.data) <= 2 * SLICE_BYTES:
        starts, hashes, codes = read(part.data, part.offsets)
        return Words(hashes[0], np.searchsorted(starts, part.offsets), codes, tuple(hashes[1:]))
    found, at, size = [], 0, len(part.data)
    while at < size:
        to = min(size, at + SLICE_BYTES)
        while to < size and not (cuts := np.flatnonzero(gaps[part.data[at:to]])).size:
            to = min(size, to + SLICE_BYTES)
        if to < size:
            to = at + int(cuts[-1]) + 1
        block = part.data[at:to]
        found.append(read(block, np.array([0, len(block)])))
        at = to
    hashes = [np.concatenate(x) for x in zip(*(block[1] for block in found), strict=True)]
    codes = np.concatenate([x[2] for x in found]) if shapes else None
    return Words(hashes[0], np.array([0, len(hashes[0])]), codes, tuple(hashes[1:]))


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each element, given where each row's elements begin."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def window_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of `size` words within a row, and each row's bounds among them."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    if len(words) < size:
        return np.zeros(0, np.uint64), out
    n = len(words) - size + 1
    acc = np.zeros(n, np.uint64)
    for k in range(size):
        acc = mix(acc * np.uint64(_BASE) + words[k : k + n])
    starts = np.repeat(bounds[:-1] - out[:-1], counts) + np.arange(out[-1])
    return acc[starts], out


def sorted_sets(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct values in ascending order, and the rows' new bounds."""
    rows = rows_of(bounds)
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[keep], np.searchsorted(rows[keep], np.arange(len(bounds)))
