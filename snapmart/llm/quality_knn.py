"""Quality classifier: nearest-neighbour voting among labelled documents in a latent-semantic space.

A document becomes the square roots of its shares of three kinds of terms: word shapes (case, symbols, digits, length),
hashed words, and windows of three words that repeat or not. The leading directions of the labelled documents' term
vectors are the latent space. At most `per_class` labelled documents of each class that have a text, whole,
are projected there and broadcast (2 * per_class * DIMENSIONS floats, about 1 MB). Every document is
compared with all of them by exact cosine products, a block of documents at a time, and the `neighbours` nearest vote
with their similarity as weight.

Null and empty texts are the zero vector: every similarity is 0, and the score is the labelled documents' mean label.
Repeated rows get the same score; equal similarities are settled by the order of the labelled vectors, which is fixed.
Without labelled documents every score is 0. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import label_sample, map_arrow
from snapmart.llm.text import SHAPES, Slice, rows_of, sorted_sets, text_slices, window_hashes, words_of

HASHED = 512
TERMS = SHAPES + HASHED + 2
DIMENSIONS = 48
NEIGHBOURS = 15
PER_CLASS = 2048

#: Lengths of the parts of a term vector: shapes, words, repetition.
SHAPE_WEIGHT, WORD_WEIGHT, REPEAT_WEIGHT = 1.0, 0.3, 1.0

#: Documents of a block of cosine products.
BLOCK = 512


@dataclass(frozen=True)
class Model:
    """Mean term vector, latent directions, unit vectors of the labelled documents, and their labels."""

    mean: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def terms(part: Slice) -> np.ndarray:
    """The term vectors of a slice's rows."""
    n = len(part)
    words = words_of(part, shapes=True)
    rows = rows_of(words.bounds)
    counts = np.maximum(np.diff(words.bounds), 1)[:, None]
    shapes = np.bincount(rows * SHAPES + words.shapes, minlength=n * SHAPES).reshape(n, SHAPES)
    hashed = (words.hashes >> np.uint64(32)).astype(np.int64) % HASHED
    hashed = np.bincount(rows * HASHED + hashed, minlength=n * HASHED).reshape(n, HASHED)
    windows, bounds = window_hashes(words.hashes, words.bounds, 3)
    total = np.diff(bounds)
    distinct = np.diff(sorted_sets(windows, bounds)[1])
    repeats = np.stack([distinct, total - distinct], 1) / np.maximum(total, 1)[:, None]
    return np.sqrt(
        np.concatenate(
            [SHAPE_WEIGHT**2 * shapes / counts, WORD_WEIGHT**2 * hashed / counts, REPEAT_WEIGHT**2 * repeats], 1
        )
    ).astype(np.float32)


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch.column(0)):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).slice(part.first, len(part)),
                    pa.array([x.tobytes() for x in terms(part)], pa.binary()),
                ],
                names=["y", "terms"],
            )


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Latent space and labelled vectors from the texts of `docs` that have a label (0 or 1) in `labels`."""
    sample = label_sample(docs, labels, label, per_class)
    rows = sorted((r["y"], bytes(r["terms"])) for r in map_arrow(sample, _sample_terms, "y int, terms binary").collect())
    x = np.frombuffer(b"".join(t for _, t in rows), np.float32).reshape(-1, TERMS)
    y = np.array([y for y, _ in rows], np.float32)
    if not len(y):
        return Model(np.zeros(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), y)
    mean = x.mean(0)
    # Directions of largest variance: the singular vectors, from the small matrix of the terms' products.
    values, vectors = np.linalg.eigh(((x - mean).T @ (x - mean)).astype(float))
    directions = vectors[:, np.argsort(-values, kind="stable")[:DIMENSIONS]].astype(np.float32)
    return Model(mean, directions, _unit((x - mean) @ directions), y)


def vote(x: np.ndarray, model: Model, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighted by similarity."""
    out = np.zeros(len(x))
    if not len(model.labels):
        return out
    k = min(neighbours, len(model.labels))
    for a in range(0, len(x), BLOCK):
        near = x[a : a + BLOCK] @ model.vectors.T
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        top.sort(axis=1)
        weight = np.maximum(np.take_along_axis(near, top, 1).astype(float), 0) ** 4
        total = weight.sum(1)
        votes = (weight * model.labels[top]).sum(1)
        out[a : a + BLOCK] = np.where(total > 0, votes / np.where(total > 0, total, 1), model.labels.mean())
    return np.clip(out, 0, 1)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 is likelier) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(batch.num_rows)
            for part in text_slices(batch.column(1)):
                known = shared.value
                x = terms(part)
                latent = _unit((x - known.mean) @ known.directions) * (x.any(1)[:, None])
                out[part.first : part.first + len(part)] = vote(latent, known)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["doc_id", "score"])

    schema = docs.select("doc_id", F.lit(0.0).alias("score")).schema
    return map_arrow(docs.select("doc_id", "text"), run, schema)
