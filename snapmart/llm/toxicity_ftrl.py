"""Toxicity: logistic regression over hashed word n-grams and skip-grams, learned by FTRL-proximal.

A document's features are hashed single words, pairs of neighbours, pairs with one or two words between, and word
beginnings of a few bytes (words are runs of letters and digits, A-Z lower-cased); a feature that comes c times has
the value log2(1 + c). FTRL-proximal keeps a learning rate per coordinate,
and its L1 term holds every weight at zero that isn't worth it, so the model that is broadcast is a short list.

The model is fitted on a bounded sample: at most `per_class` labelled documents of each class that have a text, of which
at most `longest` characters are read, of longer texts in pieces that spread over the whole text (a text's features are
the only thing that grows with it). Their features go to one task, where the updates run one document after the other, in an order that depends on the rows alone; only the
sparse weights come back to the driver. The bias is then moved from the sample's class shares to those of all
labelled documents. Scoring reads every whole text once, without a shuffle.

Null and empty texts have no features and get the bias's probability. Repeated rows get the same score. Without any
labelled document of both classes every score is 0. Other columns are ignored; a score may not have the name of one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import CUT, label_sample, map_arrow, written
from snapmart.llm.text import Slice, Words, mix, rows_of, text_slices, words_of

BITS = 20

#: Distances between the two words of a pair: neighbours, and skip-grams.
PAIR_DISTANCES = (1, 2, 3)

#: Bytes of word beginnings, which stand for inflected and composed forms.
BEGINNINGS = (5, 7)

PER_CLASS = 2500
LONGEST = 20_000


@dataclass(frozen=True)
class Ftrl:
    """Step sizes and penalties: rate alpha / (beta + sqrt(sum of squared gradients)) for each coordinate."""

    alpha: float = 0.15
    beta: float = 1.0
    l1: float = 1.5
    l2: float = 0.5
    epochs: int = 4


@dataclass(frozen=True)
class Model:
    """Features with a weight, ascending, their weights, and the bias; at most 2 ** BITS entries."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def _read(part: Slice) -> Words:
    return words_of(part, letters_only=True, begin=BEGINNINGS)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashed features of all words, beginnings and pairs, with repeats."""
    shift = np.uint64(64 - BITS)
    rows = rows_of(words.bounds)
    at, found = [rows], [(mix(words.hashes) >> shift).astype(np.int32)]
    for size, hashes in zip(BEGINNINGS, words.beginnings, strict=True):
        at.append(rows)
        found.append((mix(hashes + np.uint64(size << 32)) >> shift).astype(np.int32))
    for distance in PAIR_DISTANCES:
        if len(rows) > distance:
            same = rows[distance:] == rows[:-distance]
            pair = mix(words.hashes[:-distance] * np.uint64(2 * distance + 1) + mix(words.hashes[distance:]))
            at.append(rows[:-distance][same])
            found.append((pair[same] >> shift).astype(np.int32))
    return np.concatenate(at), np.concatenate(found)


def _counted(rows: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows and features, with how often they come."""
    keys, counts = np.unique(rows.astype(np.int64) << BITS | found, return_counts=True)
    return keys >> BITS, (keys & ((1 << BITS) - 1)).astype(np.int32), counts.astype(np.uint32)


def _values(counts: np.ndarray) -> np.ndarray:
    return np.log2(1.0 + counts)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch.column(0)):
            rows, found, counts = _counted(*features(_read(part)))
            cuts = np.searchsorted(rows, np.arange(len(part) + 1))
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).slice(part.first, len(part)),
                    pa.array([found[a:b].astype("<i4").tobytes() for a, b in spans], pa.binary()),
                    pa.array([counts[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
                ],
                names=["y", "features", "counts"],
            )


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], how: Ftrl) -> tuple[np.ndarray, float]:
    """Weights and bias after one pass per epoch over the examples, in an order fixed by a seed."""
    z = np.zeros((1 << BITS) + 1)
    n = np.zeros((1 << BITS) + 1)  # the last coordinate is the bias
    last = np.array([1 << BITS])

    def weights(i: np.ndarray) -> np.ndarray:
        l1 = np.where(i == 1 << BITS, 0.0, how.l1)
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - l1, 0)
        return -shrunk / ((how.beta + np.sqrt(n[i])) / how.alpha + how.l2)

    order = np.random.default_rng(0)
    for _ in range(how.epochs):
        for k in order.permutation(len(examples)):
            found, counts, y = examples[k]
            i, x = np.concatenate([found, last]), np.concatenate([_values(counts), [1.0]])
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            grown = np.sqrt(n[i] + g * g)
            z[i] += g - (grown - np.sqrt(n[i])) / how.alpha * w
            n[i] += g * g
    w = weights(np.arange((1 << BITS) + 1))
    return w[:-1], float(w[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    per_class: int = PER_CLASS,
    longest: int = LONGEST,
    how: Ftrl = Ftrl(),
) -> Model:
    """A model of `label` (0 or 1, by doc_id in `labels`) from the texts of `docs`."""
    sample = label_sample(docs, labels, label, per_class, longest)
    rows = map_arrow(sample, _sample_features, "y int, features binary, counts binary")
    learned = map_arrow(written(rows, "sample").coalesce(1), _trained(how), _LEARNED).collect()  # one row
    if not learned:
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), -np.inf)
    found = learned[0]
    shares = {r[label]: r["count"] for r in labels.where(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    bias = found["bias"] + np.log(shares[1] / shares[0]) - np.log(found["ones"] / found["zeros"])
    features, weights = np.frombuffer(found["features"], "<i4"), np.frombuffer(found["weights"], "<f4")
    return Model(features.astype(np.int32), weights.astype(np.float32), float(bias))


_LEARNED = "features binary, weights binary, bias double, ones long, zeros long"


def _trained(how: Ftrl) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From the whole sample in one task: the features with a weight, and the bias. No row without both classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            y, found, counts = batch.columns
            rows += zip(y.to_pylist(), found.to_pylist(), counts.to_pylist(), strict=True)
        rows.sort()
        ones = sum(y for y, _, _ in rows)
        if not 0 < ones < len(rows):
            return
        weights, bias = train([(np.frombuffer(f, "<i4"), np.frombuffer(c, "<u4"), y) for y, f, c in rows], how)
        kept = np.flatnonzero(weights)
        cells = [kept.astype("<i4").tobytes(), weights[kept].astype("<f4").tobytes(), bias, ones, len(rows) - ones]
        names = ["features", "weights", "bias", "ones", "zeros"]
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], names=names)

    return run


def with_score(
    docs: DataFrame, model: Model, text: str = "text", score: str = "score", keep: Sequence[str] | None = None
) -> DataFrame:
    """All rows and columns of `docs`, or those named by `keep`, and the probability of the label.

    Python sends only what is kept back to Spark.
    """
    if score in docs.columns:
        raise ValueError(f"there is a column {score!r} already; name the score otherwise")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = list(docs.columns if keep is None else keep)
    kept = [docs.columns.index(c) for c in keep]
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS, np.float32)
        dense[shared.value.features] = shared.value.weights
        for batch in batches:
            out = np.empty(batch.num_rows)
            for part in text_slices(batch.column(place)):
                rows, found = features(_read(part))
                weighty = np.flatnonzero(dense[found])
                rows, found, counts = _counted(rows[weighty], found[weighty])
                total = np.bincount(rows, dense[found] * _values(counts), len(part)) + shared.value.bias
                with np.errstate(over="ignore"):
                    out[part.first : part.first + len(part)] = 1 / (1 + np.exp(-total))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(out)], names=[*keep, score])

    schema = docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(0.0).alias(score)).schema
    return map_arrow(docs, run, schema)


def predicted(score: Column, cut: float = CUT) -> Column:
    return (score >= cut).cast("int")
