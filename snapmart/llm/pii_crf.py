"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

The fixed patterns find e-mail and IP addresses, card and telephone numbers, and always stay. The field looks at the
stretches of tokens with a digit or an `@`: every other character can only be outside a span. A stretch is cut into
atoms (runs of digits, runs of letters, single other characters), and every run of up to MAX_ATOMS atoms that could be
an entity is scored as a whole for each kind: its digits, separators, check digit, groups, ends and neighbours. Dynamic
programming over the atoms chooses boundaries and kinds together; atoms under a fixed span are left to it.

The weights maximise the conditional likelihood (forward and backward sums over all segmentations, gradient steps) of
the fixed spans on a bounded sample: at most SAMPLE texts, and of one text with more than LONGEST characters the stretches
in LONGEST / WINDOW of its windows, spread over the text by hash. Stretches are cut beside spans into parts of about
PART characters, first
reduced to their shapes and counted. Each is also shown with the check digit and the plus sign hidden, so that the model
doesn't only learn the patterns again. About a hundred weights are broadcast. Whole texts are searched, without a shuffle.

Null and empty texts have no spans. Ends are exclusive, places are code points. Repeated rows are searched alike.
Without any text to learn from only the fixed patterns are found. All work is linear in the length of a text.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import map_arrow

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 24
SAMPLE, LONGEST = 3000, 20_000
WINDOW, PART = 2000, 200

#: Gradient steps, their size, the pull of weights to zero, and the weight of an example with hidden features.
STEPS, RATE, DECAY, HIDDEN = 60, 0.5, 1e-3, 0.3

Span = tuple[int, str, int]  # start, kind, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins within a run of digits, as the run's first digit would have matched alike.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_TRIGGER = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]*")
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|.", re.DOTALL)


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@domain, anchored at each `@`: the longest local part before it that no match has used."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then kind."""
    found: list[tuple[int, int, int]] = [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 12 <= len(digits := _NO_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Runs of tokens with a digit or `@` that single spaces join."""
    start, end, low = -1, -1, 0
    at = _TRIGGER.search(text)
    while at:
        first = at.start()
        while first > low and not _SPACE.match(text, first - 1):
            first -= 1
        last = _TOKEN.match(text, at.start()).end()
        if start >= 0 and first == end + 1 and text[end] == " ":
            end = last
        else:
            if start >= 0:
                yield start, end
            start, end = first, last
        low = last
        at = _TRIGGER.search(text, last)
    if start >= 0:
        yield start, end


def features(kind: str, s: str, left: str, right: str) -> list[str]:
    """What a whole candidate span shows for a kind; `left` and `right` are the characters beside it."""
    digits = _NO_DIGIT.sub("", s)
    n = len(digits)
    out = [
        "bias",
        f"digits {next(b for b in (3, 6, 8, 11, 15, 16, 19, 10**9) if n <= b)}",
        f"dots {min(s.count('.'), 4)}",
        f"glued {(left.isalnum() or left in '@.+') and bool(left)} {right.isalnum() or right == '@'}",
        f"separators {''.join(sorted({c for c in s if c in ' -().'}))}",
    ]
    if kind == "email":
        domain = s.rpartition("@")[2]
        out += [f"ats {min(s.count('@'), 2)}", f"letters at the end {domain.rpartition('.')[2].isalpha()}"]
        out += [f"dot in domain {'.' in domain}", f"space {' ' in s}"]
    else:
        groups = [g for g in re.split(r"[^0-9]+", s) if g]
        out.append(f"groups {min(len(groups), 6)} longest {min(max(map(len, groups), default=0), 9)}")
        if kind == "ip":
            out.append(f"octets {len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
        elif kind == "card":
            out.append(f"check digit {12 <= n <= 19 and luhn(digits)}")
        else:
            out.append(f"plus {s[0] == '+'}")
    return [f"{kind} {f}" for f in out]


#: Features that are hidden in a share of the examples.
_HIDE = ("card check digit", "phone plus")


def candidates(text: str, atoms: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
    """Runs of atoms (first, one past the last) that may be an entity, with the kinds they may be."""
    for i, (a, _) in enumerate(atoms):
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        digits = ats = letters = dots = 0
        for j in range(i, min(len(atoms), i + MAX_ATOMS)):
            p, q = atoms[j]
            c = text[p]
            if c in "0123456789":
                digits += q - p
            elif c == "@":
                ats += 1
            elif c == ".":
                dots += 1
            elif c.isalnum():
                letters += 1
            elif c in " -+()_%":
                if c == " " and (letters or ats):
                    break
            else:
                break
            if digits > 24 or ats > 1:
                break
            if not c.isalnum():
                continue
            if ats:
                if dots:
                    yield i, j + 1, "email"
            elif not letters and digits >= 4:
                if dots == 3:
                    yield i, j + 1, "ip"
                if digits >= 7:
                    yield i, j + 1, "card"
                    yield i, j + 1, "phone"


def atoms_of(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _ATOM.finditer(text, start, end)]


def _beside(text: str, a: int, b: int) -> tuple[str, str]:
    return text[a - 1 : a], text[b : b + 1]


def _shape(text: str) -> str:
    return re.sub(r"[^\W\d_]", "a", text)


@dataclass(frozen=True)
class Model:
    """Weights of the features; a feature that is not there weighs nothing, and no weight means no added span."""

    weights: dict[str, float]

    def score(self, kind: str, s: str, left: str, right: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(kind, s, left, right))


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def expectations(n: int, segments: list[tuple[int, int, float]]) -> tuple[float, list[float]]:
    """Log of the sum over all segmentations of n atoms, and each segment's probability. An atom outside scores 0."""
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    starting: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (i, j, _) in enumerate(segments):
        ending[j].append(k)
        starting[i].append(k)
    before, after = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        total = before[j - 1]
        for k in ending[j]:
            total = _log_add(total, before[segments[k][0]] + segments[k][2])
        before[j] = total
    for i in range(n - 1, -1, -1):
        total = after[i + 1]
        for k in starting[i]:
            total = _log_add(total, after[segments[k][1]] + segments[k][2])
        after[i] = total
    return before[n], [math.exp(min(0.0, before[i] + s + after[j] - before[n])) for i, j, s in segments]


def best(n: int, segments: list[tuple[int, int, float]]) -> list[int]:
    """The segments of the best segmentation of n atoms, by dynamic programming; fewer and earlier ones among equals."""
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (_, j, _) in enumerate(segments):
        ending[j].append(k)
    top, chosen = [0.0] * (n + 1), [-1] * (n + 1)
    for j in range(1, n + 1):
        top[j] = top[j - 1]
        for k in ending[j]:
            if (value := top[segments[k][0]] + segments[k][2]) > top[j]:
                top[j], chosen[j] = value, k
    out, j = [], n
    while j:
        if chosen[j] < 0:
            j -= 1
        else:
            out.append(chosen[j])
            j = segments[chosen[j]][0]
    return out[::-1]


def train(examples: Counter) -> Model:
    """Weights from counted examples: (stretch with the characters beside it, fixed spans within it)."""
    names: dict[str, int] = {}
    rows = []
    for (left, text, right, spans), count in sorted(examples.items()):
        whole = left + text + right
        atoms = atoms_of(whole, len(left), len(left) + len(text))
        place = {a: k for k, (a, _) in enumerate(atoms)} | {b: k + 1 for k, (_, b) in enumerate(atoms)}
        gold = {(place.get(a + len(left)), place.get(b + len(left)), kind) for a, kind, b in spans}
        segments = list(candidates(whole, atoms))
        found = [
            features(kind, whole[atoms[i][0] : atoms[j - 1][1]], *_beside(whole, atoms[i][0], atoms[j - 1][1]))
            for i, j, kind in segments
        ]
        right_ones = np.array([s in gold for s in segments], float)
        for hide, weight in ((False, 1.0), (True, HIDDEN)):
            ids = [
                np.array([names.setdefault(f, len(names)) for f in fs if not (hide and f.startswith(_HIDE))], np.int64)
                for fs in found
            ]
            if ids:
                rows.append((len(atoms), segments, ids, right_ones, weight * count))
    w = np.zeros(len(names))
    total = sum(r[-1] for r in rows)
    size = np.zeros(len(names)) + 1e-6
    for _ in range(STEPS if rows else 0):
        gradient = -DECAY * w
        for n, segments, ids, right_ones, count in rows:
            scored = [(i, j, float(w[f].sum())) for (i, j, _), f in zip(segments, ids, strict=True)]
            _, chance = expectations(n, scored)
            for f, g in zip(ids, (right_ones - chance) * count / total, strict=True):
                if g:
                    gradient[f] += g
        size += gradient**2
        w += RATE * gradient / np.sqrt(size)
    return Model({name: float(w[k]) for name, k in names.items()})


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """Spans of the best segmentation of each stretch; none shares a character with a fixed span."""
    out: list[Span] = []
    if not model.weights:
        return out
    taken = sorted((a, b) for a, _, b in base)
    k = 0
    for start, end in stretches(text):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        pieces, at, m = [], start, k
        while m < len(taken) and taken[m][0] < end:
            if taken[m][0] > at:
                pieces.append((at, taken[m][0]))
            at = max(at, taken[m][1])
            m += 1
        if at < end:
            pieces.append((at, end))
        for a, b in pieces:
            if b - a < 5:
                continue
            atoms = atoms_of(text, a, b)
            segments, kinds = [], []
            for i, j, kind in candidates(text, atoms):
                p, q = atoms[i][0], atoms[j - 1][1]
                score = model.score(kind, text[p:q], *_beside(text, p, q))
                if score > 0:
                    segments.append((i, j, score))
                    kinds.append(kind)
            for s in best(len(atoms), segments):
                out.append((atoms[segments[s][0]][0], kinds[s], atoms[segments[s][1] - 1][1]))
    return out


_SPANS = "array<struct<kind:string,start:long,end:long>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _packed(spans: list[list[Span]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for a, k, b in s] for s in spans], _SPAN_TYPE)


def _parts(a: int, b: int, base: list[Span]) -> Iterator[tuple[int, int]]:
    """A stretch in parts of at most PART characters, or up to the end of the span that a cut would divide."""
    while b - a > PART:
        cut = a + PART
        for p, _, q in base:
            if p < cut < q:
                cut = p if p > a else q
        yield a, cut
        a = cut
    if b > a:
        yield a, b


def _windows(text: str, longest: int) -> set[int] | None:
    """The windows of a long text that are learned from: those with the least hashes, so that they spread over it."""
    if len(text) <= longest:
        return None
    own = zlib.crc32(text.encode("utf-8", "replace"))
    order = sorted(range(-(-len(text) // WINDOW)), key=lambda k: (zlib.crc32(f"{own}:{k}".encode()), k))
    return set(order[: max(1, longest // WINDOW)])


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE, longest: int = LONGEST) -> Model:
    """Weights from the fixed spans of a sample of the texts with a digit or `@`, chosen by the texts' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for value in batch.column(0).to_pylist():
                base, chosen = sorted(base_spans(value)), _windows(value, longest)
                begins = [p for p, _, _ in base]
                for first, last in stretches(value):
                    near = base[bisect_left(begins, first) : bisect_left(begins, last)]
                    for a, b in _parts(first, last, near):
                        if chosen is None or a // WINDOW in chosen:
                            inside = tuple((p - a, k, q - a) for p, k, q in near if a <= p and q <= b)
                            left, right = _beside(value, a, b)
                            found[_shape(left), _shape(value[a:b]), _shape(right), inside] += 1
            keys = [(x, t, y, list(spans)) for x, t, y, spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([key[i] for key in keys], pa.string()) for i in range(3)),
                    _packed([key[3] for key in keys]),
                    pa.array(list(found.values()), pa.int64()),
                ],
                names=["before", "stretch", "after", "spans", "n"],
            )

    value = F.col(text)
    texts = docs.where(value.rlike("[0-9@]"))
    texts = texts.select(value.alias("text"), F.xxhash64(value).alias("hash"))
    # The sample's largest hash first, from hashes alone: so no task gets more texts than are wanted.
    last = texts.select("hash").distinct().orderBy("hash").limit(sample).agg(F.max("hash")).first()[0]
    texts = texts.where(F.col("hash") <= F.lit(last)).groupBy("hash").agg(F.min("text").alias("text")).select("text")
    examples: Counter = Counter()
    schema = f"before string, stretch string, after string, spans {_SPANS}, n long"
    for r in map_arrow(texts, run, schema).collect():
        spans = tuple((s["start"], s["kind"], s["end"]) for s in r["spans"])
        examples[r["before"], r["stretch"], r["after"], spans] += r["n"]
    return train(examples)


def with_spans(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, base and added: arrays of (kind, start, end) by start, then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                base, added = [], []
                for value in rows.column(1):
                    value = value.as_py() or ""
                    base.append(base_spans(value))
                    added.append(added_spans(value, base[-1], shared.value))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), _packed(base), _packed(added)], names=["doc_id", "base", "added"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(rows, run, f"doc_id long, base {_SPANS}, added {_SPANS}")


def of_kind(spans: str, kind: str) -> Column:
    """Number of spans of a kind in an array column."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """kind:start:end of all spans by start, then kind, joined by commas."""
    order = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.array_position(order, s["kind"]).alias("place"),
                s["end"].alias("end"),
                s["kind"].alias("kind"),
            ),
        )
    )
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked_text(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by its first span's kind."""
    out, at = [], 0
    for a, kind, b in sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns, with the spans of the text replaced by their kinds. Null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, place = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                out = []
                for value in rows.column(place):
                    value = value.as_py()
                    if value and _TRIGGER.search(value):
                        base = base_spans(value)
                        value = masked_text(value, base + added_spans(value, base, shared.value))
                    out.append(value)
                columns = [*rows.columns]
                columns[place] = pa.array(out, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(docs, run, docs.schema)
