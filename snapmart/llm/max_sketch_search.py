"""Ranked lexical search by hashed max-sketches: the ten (or k) highest-scoring documents of each query, exactly.

1. Every document becomes a row of an index: its number of terms, its distinct terms (64-bit hashes, ascending) with their
   occurrences, and a sketch. The sketch folds the terms on 2 ** SKETCH_BITS coordinates by hash and keeps on each the
   largest occurrence of a term there. As a term's impact in a document rises with its occurrences alone, that is the
   largest impact, whatever the rest of the corpus; only the coordinates in use are stored.
2. Queries are answered in blocks of QUERIES. A block's terms get their document frequencies by one count over the index,
   and its lookups are lists by coordinate: which queries have weight there, and how much.
3. Looking a sketch's coordinates up for all queries of the block at once gives an upper bound of the document's score
   for each query: a term can't weigh more than the largest impact on its coordinate.
4. A seeding pass scores of every batch of documents the k of largest bound. The k-th best of all these
   scores is the query's first threshold.
5. The final pass scores documents exactly in descending order of their bounds until the bound falls below the
   threshold, which rises to the k-th best score that the task has found. Each task returns at most k rows a query.

Terms are runs of letters and digits, where every character beyond ASCII counts as a letter and A-Z are lower-cased. With
N documents that have a term, L terms in all of them, n terms in a document, df documents with a term and tf occurrences, a
term's weight is floor(1000 * ln((2 * N + 2) / (2 * df + 1))), a document's m is 25 + (75 * n * N) div L, and a score sums
weight * ((1000000000 * tf) div (1000 * tf + 8 * m)) over the query's terms, repeats included. All sums are whole numbers
below 2 ** 53, so bounds in doubles are exact.

Null and empty texts have no terms and are never found; queries without terms, or without a document that scores above 0,
get no rows. Equal scores go by ascending id, null ids first. Rows that repeat an id are documents, or queries, of their
own. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import map_arrow, written
from snapmart.llm.text import mix, rows_of, text_slices, words_of

SKETCH_BITS = 14

#: Queries that are looked up at once.
QUERIES = 256

#: Documents whose bounds are computed at once.
_DOCUMENTS = 1024

#: A sketch's largest number; it stands for any number of occurrences from there on.
_MANY = 65535

_INDEX = "doc_id long, n long, terms binary, occurrences binary, places binary, largest binary"


def coordinate(terms: np.ndarray, bits: int) -> np.ndarray:
    return (mix(terms) >> np.uint64(64 - bits)).astype(np.int64)


def _counted(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, value), ascending, with their number."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    first = np.flatnonzero(new)
    return rows[first], values[first], np.diff(np.append(first, len(rows)))


def index(docs: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One row for each document that has a term; `largest` are the sketch's numbers at its coordinates `places`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(1)):
                words = words_of(part, letters_only=True)
                rows, terms, tf = _counted(rows_of(words.bounds), words.hashes)
                places = rows << bits | coordinate(terms, bits)
                order = np.argsort(places, kind="stable")
                begins = np.flatnonzero(np.diff(places[order], prepend=-1))
                largest = np.maximum.reduceat(np.minimum(tf, _MANY)[order], begins) if len(begins) else tf
                used = places[order][begins]
                n = np.diff(words.bounds)
                has = np.flatnonzero(n)
                cut = np.searchsorted(rows, np.arange(len(part) + 1))
                drawn = np.searchsorted(used >> bits, np.arange(len(part) + 1))
                low = (used & ((1 << bits) - 1)).astype("<u2")

                def packed(values: np.ndarray, bounds: np.ndarray, has=has) -> pa.Array:
                    return pa.array([values[bounds[k] : bounds[k + 1]].tobytes() for k in has], pa.binary())

                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)).take(pa.array(has)),
                        pa.array(n[has].astype(np.int64)),
                        packed(terms, cut),
                        packed(tf.astype("<u4"), cut),
                        packed(low, drawn),
                        packed(largest.astype("<u2"), drawn),
                    ],
                    names=["doc_id", "n", "terms", "occurrences", "places", "largest"],
                )

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _INDEX)


@dataclass(frozen=True)
class Block:
    """Some queries: their ids, distinct terms (ascending) and, by query, which terms with what repeats.

    `weights` come with the corpus' counts `documents` (N) and `length` (L). By coordinate, `lists` bounds the lookups in
    `who` (query) and `much` (sum of weights there).
    """

    ids: list
    terms: np.ndarray
    query: np.ndarray
    term: np.ndarray
    repeats: np.ndarray
    weights: np.ndarray
    documents: int
    length: int
    lists: np.ndarray
    who: np.ndarray
    much: np.ndarray

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 25 + 75 * n * self.documents // self.length
        return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _block(rows: list, spark_index: DataFrame, documents: int, length: int, bits: int = SKETCH_BITS) -> Block:
    texts = pa.array([r["text"] for r in rows], pa.large_string())
    found = [(words_of(p, letters_only=True), p.first) for p in text_slices(texts)]
    query = np.concatenate([rows_of(w.bounds) + first for w, first in found])
    query, hashes, repeats = _counted(query, np.concatenate([w.hashes for w, _ in found]))
    terms, term = np.unique(hashes, return_inverse=True)
    df = _document_frequencies(spark_index, terms)
    weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    at = coordinate(terms, bits)[term]
    keys, which = np.unique(at * len(rows) + query, return_inverse=True)
    much = np.bincount(which, weights[term] * repeats, len(keys))
    lists = np.searchsorted(keys // len(rows), np.arange((1 << bits) + 1))
    return Block([r["id"] for r in rows], terms, query, term, repeats, weights, documents, length, lists, keys % len(rows), much)


def _document_frequencies(spark_index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """In how many documents each of the terms is; every task counts its own, and their sums are one row a term."""
    shared = spark_index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        counts = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _DOCUMENTS):
                own = np.frombuffer(b"".join(batch.column(0).slice(at, _DOCUMENTS).to_pylist()), np.uint64)
                where = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
                counts += np.bincount(where[wanted[where] == own], minlength=len(wanted))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["term", "df"])

    out = np.zeros(len(terms), np.int64)
    if len(terms):
        for r in map_arrow(spark_index.select("terms"), run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
            out[r["term"]] = r["df"]
    return out


def bounds_of(block: Block, n: np.ndarray, places: list[bytes], largest: list[bytes]) -> np.ndarray:
    """An upper bound of the score of each document for each query."""
    sizes = np.array([len(p) // 2 for p in places])
    document = np.repeat(np.arange(len(places)), sizes)
    place = np.frombuffer(b"".join(places), "<u2").astype(np.int64)
    tf = np.frombuffer(b"".join(largest), "<u2").astype(np.int64)
    hit = np.flatnonzero(block.lists[place + 1] > block.lists[place])
    document, place, tf = document[hit], place[hit], tf[hit]
    impact = block.impact(tf, n[document])
    impact[tf == _MANY] = 1_000_000
    first, count = block.lists[place], block.lists[place + 1] - block.lists[place]
    at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
    cells = np.repeat(document, count) * len(block.ids) + block.who[at]
    total = np.bincount(cells, np.repeat(impact, count) * block.much[at], len(places) * len(block.ids))
    return total.reshape(len(places), len(block.ids))


def scorer(block: Block) -> Callable[[int, int, bytes, bytes], int]:
    """The exact score of a query (by number) for a document of n terms."""
    cut = np.searchsorted(block.query, np.arange(len(block.ids) + 1))
    own = [block.terms[block.term[a:b]] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    weight = [(block.weights[block.term[a:b]] * block.repeats[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def score(query: int, n: int, terms: bytes, occurrences: bytes) -> int:
        there, tf = np.frombuffer(terms, np.uint64), np.frombuffer(occurrences, "<u4")
        at = np.minimum(np.searchsorted(there, own[query]), len(there) - 1)
        both = np.flatnonzero(there[at] == own[query])
        return int((weight[query][both] * block.impact(tf[at[both]].astype(np.int64), np.int64(n))).sum())

    return score


def _searched(spark_index: DataFrame, block: Block, k: int, least: np.ndarray | None) -> DataFrame:
    """query, doc_id, score: of each task the best k documents of each query that reach its threshold `least`.

    Without thresholds only the k documents with the largest bounds of each batch are scored.
    """
    shared = spark_index.sparkSession.sparkContext.broadcast((block, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, least = shared.value
        score = scorer(block)
        floor = np.ones(len(block.ids)) if least is None else np.maximum(least, 1).astype(float)
        best: list[list[tuple]] = [[] for _ in block.ids]
        for batch in batches:
            for at in range(0, batch.num_rows, _DOCUMENTS):
                part = batch.slice(at, _DOCUMENTS)
                ids, n, terms, occurrences, places, largest = part.columns
                n = n.to_numpy()
                bounds = bounds_of(block, n, places.to_pylist(), largest.to_pylist())
                for q in np.flatnonzero((bounds >= floor).any(0)):
                    order = np.flatnonzero(bounds[:, q] >= floor[q])
                    order = order[np.argsort(-bounds[order, q], kind="stable")]
                    for d in order if least is not None else order[:k]:
                        if bounds[d, q] < floor[q]:
                            break
                        found = score(q, int(n[d]), terms[d].as_py(), occurrences[d].as_py())
                        if found > 0:
                            doc = ids[d].as_py()
                            best[q].append((-found, doc is not None, doc or 0))
                            best[q].sort()
                            del best[q][k:]
                            if len(best[q]) == k:
                                floor[q] = max(floor[q], -best[q][-1][0])
        rows = [(q, doc if known else None, -s) for q, own in enumerate(best) for s, known, doc in own]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "score"])

    return map_arrow(spark_index, run, "query long, doc_id long, score long")


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    query_id: str = "query_id",
    bits: int = SKETCH_BITS,
    at_once: int = QUERIES,
) -> DataFrame:
    """For every row of `queries` (query_id, text) the k best documents: query_id, rank, doc_id, score."""
    spark = docs.sparkSession
    indexed = written(index(docs, bits), "index")
    total = indexed.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    asked = queries.select(F.col(query_id).cast("long").alias("id"), "text")
    blocks = max(1, -(-asked.count() // at_once))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    out = spark.createDataFrame([], f"{query_id} long, rank int, doc_id long, score long")
    for number in range(blocks if total["documents"] else 0):
        rows = dealt.where(F.col("block") == number).collect()  # about `at_once` rows
        if not rows:
            continue
        block = _block(rows, indexed, total["documents"], total["length"], bits)
        place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        seeds = _searched(indexed, block, k, None).withColumn("rank", F.row_number().over(place))
        least = np.zeros(len(rows), np.int64)
        for r in seeds.where(F.col("rank") == k).collect():  # one row a query
            least[r["query"]] = r["score"]
        found = _searched(indexed, block, k, least).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, i) for q, i in enumerate(block.ids)], f"query long, {query_id} long")
        found = found.join(F.broadcast(names), "query").select(query_id, F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = out.unionByName(written(found, "found"))
    return out
