"""Approximate nearest neighbours: robust-pruned directed graphs, one per shard, searched by beams.

Equal vectors are one node with its smallest ids (no more than a result can show), so a vector that a third of all rows
share is one node of one shard. Nodes are dealt to shards of about SHARD_ROWS by the hash of the vector. Within a shard
points are inserted in batches: a greedy beam search from fixed entry points proposes neighbours, and relaxed distance
pruning keeps a neighbour only if no kept one is closer to it by the factor ALPHA, which leaves up to DEGREE diverse
edges; each edge is also offered in reverse. To search for the largest inner product, vectors get one more component
that makes all lengths equal, so that the nearest by distance is the one with the largest product.

Vectors of each length are dealt to shards of their own. A query is searched in every shard of its length, and its best results of all shards are ranked by the inner product of the original
vectors in double precision. A shard's queries come as a stream of batches, so a task holds one shard and one batch.

Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id. A vector's
neighbours are among the vectors of its own length. Equal scores are ranked by the smaller id. Rows that repeat an id count once, with the least of their vectors by its
components. A table with
fewer candidates than asked for gives all of them (small shards are compared whole). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import map_arrow, written

SHARD_ROWS = 4096
DEGREE = 28
ALPHA = 1.2
BUILD_BEAM, SEARCH_BEAM = 48, 72

#: Nodes expanded at once in a step of a beam, entry points of a shard, rows of a batch of searches.
WIDTH, ENTRIES, BATCH = 4, 8, 256

#: Shards of up to so many nodes are compared whole; candidates of a pruning.
WHOLE, PROPOSED = 256, 96


def _prune(x: np.ndarray, points: np.ndarray, proposed: np.ndarray) -> np.ndarray:
    """For each point, up to DEGREE diverse neighbours of the proposed (len(x) stands for none), nearest first."""
    none = len(x)
    proposed = np.where(proposed == points[:, None], none, proposed)
    proposed = np.sort(proposed, axis=1)
    proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = none
    wide = np.vstack([x, np.zeros((1, x.shape[1]), np.float32)])
    near = ((wide[proposed] - x[points][:, None]) ** 2).sum(2)
    near[proposed == none] = np.inf
    if proposed.shape[1] > PROPOSED:
        order = np.argpartition(near, PROPOSED, axis=1)[:, :PROPOSED]
        proposed, near = np.take_along_axis(proposed, order, 1), np.take_along_axis(near, order, 1)
    y = wide[proposed]
    squares = (y**2).sum(2)
    between = squares[:, :, None] + squares[:, None] - 2 * y @ y.transpose(0, 2, 1)
    alive, rows = np.isfinite(near), np.arange(len(points))
    out = np.full((len(points), DEGREE), none, np.int32)
    for k in range(DEGREE):
        pick = np.where(alive, near, np.inf).argmin(1)
        good = alive[rows, pick]
        if not good.any():
            break
        out[good, k] = proposed[rows, pick][good]
        alive &= ~(ALPHA**2 * between[rows, pick] <= near) | ~good[:, None]
        alive[rows, pick] = False
    return out


def _search(x: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> np.ndarray:
    """For each query the `beam` nodes with the largest products found, best first; len(x) stands for none."""
    none, m = len(x), len(queries)
    beam = max(beam, len(entries))
    wide = np.vstack([x, np.zeros((1, x.shape[1]), np.float32)])
    seen = np.zeros((m, none + 1), bool)
    seen[:, none] = True
    seen[:, entries] = True
    ids = np.full((m, beam), none, np.int64)
    ids[:, : len(entries)] = entries
    score = np.full((m, beam), -np.inf, np.float32)
    score[:, : len(entries)] = queries @ x[entries].T
    done = np.zeros((m, beam), bool)
    rows = np.arange(m)[:, None]
    while True:
        open_score = np.where(done, -np.inf, score)
        pick = np.argpartition(-open_score, WIDTH - 1, axis=1)[:, :WIDTH]
        usable = np.take_along_axis(open_score, pick, 1) > -np.inf
        if not usable.any():
            return np.take_along_axis(ids, np.argsort(-score, axis=1, kind="stable"), 1)
        done[rows, pick] = True
        nodes = np.where(usable, np.take_along_axis(ids, pick, 1), none)
        found = np.where((nodes < none)[:, :, None], edges[np.minimum(nodes, none - 1)], none).reshape(m, -1)
        found = np.sort(found, axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = none
        found = np.where(seen[rows, found], none, found)
        seen[rows, found] = True
        new = np.einsum("mkd,md->mk", wide[found], queries)
        new[found == none] = -np.inf
        ids, score = np.hstack([ids, found]), np.hstack([score, new])
        done = np.hstack([done, np.zeros(found.shape, bool)])
        best = np.argpartition(-score, beam - 1, axis=1)[:, :beam]
        ids, score, done = (np.take_along_axis(a, best, 1) for a in (ids, score, done))
        done |= score == -np.inf


def _entries(n: int) -> np.ndarray:
    return np.unique(np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int64))


def build_graph(vectors: np.ndarray) -> np.ndarray:
    """Edges (rows of DEGREE nodes; n stands for none) of a shard's distinct vectors, whose order must be arbitrary."""
    n = len(vectors)
    squares = (vectors**2).sum(1)
    x = np.hstack([vectors, np.sqrt(np.maximum(squares.max() - squares, 0))[:, None]]).astype(np.float32)
    edges = np.full((n, DEGREE), n, np.int32)
    entries = _entries(n)
    inserted = np.concatenate([entries, np.setdiff1d(np.arange(min(n, WHOLE)), entries)])
    for at in range(0, len(inserted), BATCH):
        block = inserted[at : at + BATCH]
        edges[block] = _prune(x, block, np.tile(inserted, (len(block), 1)))
    rest = np.setdiff1d(np.arange(n), inserted)
    for at in range(0, len(rest), BATCH):
        block = rest[at : at + BATCH]
        # The points' own products rank as their distances do: all have the same length.
        edges[block] = _prune(x, block, _search(x, edges, entries, x[block], BUILD_BEAM))
        sources = np.repeat(block, DEGREE)
        targets = edges[block].ravel()
        sources, targets = sources[targets < n], targets[targets < n]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        nodes, first, counts = np.unique(targets, return_index=True, return_counts=True)
        for a in range(0, len(nodes), BATCH):
            some, most = nodes[a : a + BATCH], counts[a : a + BATCH].max()
            offered = np.full((len(some), most), n, np.int64)
            for k, (f, c) in enumerate(zip(first[a : a + BATCH], counts[a : a + BATCH], strict=True)):
                offered[k, :c] = sources[f : f + c]
            edges[some] = _prune(x, some, np.hstack([edges[some], offered]))
    return edges


def _distinct(shown: int):
    """Per task, distinct vectors and their smallest ids; no more ids than a result can show, and one for the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[bytes, list[int]] = {}

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(ids), pa.binary()), pa.array(list(ids.values()), pa.list_(pa.int64()))],
                names=["vector", "ids"],
            )
            ids.clear()
            return out

        for batch in batches:
            flat = batch.column(1).flatten().to_numpy()
            ends = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy())
            for vec_id, vector in zip(batch.column(0).to_pylist(), np.split(flat, ends)[:-1], strict=True):
                key = (vector + 0.0).tobytes()  # -0.0 and 0.0 are one value
                ids[key] = _merged(ids.get(key, []), [vec_id], shown)
            if len(ids) >= 10_000:
                yield rows()
        if ids:
            yield rows()

    return run


def _merged(a: list[int], b: list[int], shown: int) -> list[int]:
    return sorted({*a, *b})[: shown + 1]


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector (array of double) of the rows that take part."""
    values = F.col("vector")
    return vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(
        F.col("vec_id").isNotNull()
        & F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(values, lambda v: v != 0)
    )


def build(vectors: DataFrame, shown: int = 20) -> DataFrame:
    """Index table of usable vectors: shard, node, vector, ids, edges."""
    distinct = written(map_arrow(vectors, _distinct(shown), "vector binary, ids array<long>"), "vectors")
    distinct = distinct.withColumn("size", F.length("vector"))
    dealing, shards = [], 0
    for row in distinct.groupBy("size").count().orderBy("size").collect():  # one row for each length
        own = -(-row["count"] // SHARD_ROWS)
        dealing.append((row["size"], shards, own))
        shards += own
    dealing = distinct.sparkSession.createDataFrame(dealing, "size int, first int, own int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, nodes in _by_shard(batches, shown):
            x = np.stack([np.frombuffer(v, np.float64) for v in nodes]).astype(np.float32)
            edges = build_graph(x)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(x), shard, np.int32)),
                    pa.array(np.arange(len(x), dtype=np.int32)),
                    pa.array(list(nodes), pa.binary()),
                    pa.array(list(nodes.values()), pa.list_(pa.int64())),
                    pa.array([e.tobytes() for e in edges], pa.binary()),
                ],
                names=["shard", "node", "vector", "ids", "edges"],
            )

    shard = F.col("first") + F.pmod(F.xxhash64("vector"), F.col("own")).cast("int")
    dealt = distinct.join(F.broadcast(dealing), "size").select(shard.alias("shard"), "vector", "ids")
    dealt = dealt.repartition(max(shards, 1), "shard").sortWithinPartitions("shard", F.xxhash64("vector", F.lit(1)), "vector")
    schema = "shard int, node int, vector binary, ids array<long>, edges binary"
    return written(map_arrow(dealt, run, schema), "index")


def _by_shard(batches: Iterator[pa.RecordBatch], shown: int) -> Iterator[tuple[int, dict[bytes, list[int]]]]:
    """Each shard's distinct vectors with their smallest ids, from rows in the order of their shards."""
    shard, nodes = None, {}
    for batch in batches:
        for s, vector, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if s != shard:
                if nodes:
                    yield shard, nodes
                shard, nodes = s, {}
            nodes[vector] = _merged(nodes.get(vector, []), ids, shown)
    if nodes:
        yield shard, nodes


def _results(
    x: np.ndarray, ids: list[list[int]], edges: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, shown: int
) -> Iterator[tuple[int, int, float]]:
    """The shard's best (query, candidate, score), `shown` for each query."""
    if len(x) <= WHOLE:
        found = np.tile(np.arange(len(x)), (len(queries), 1))
    else:
        found = _search(
            x.astype(np.float32), edges, _entries(len(x)), queries.astype(np.float32), max(SEARCH_BEAM, shown + 1)
        )
    for query_id, query, nodes in zip(query_ids.tolist(), queries, found, strict=True):
        nodes = nodes[nodes < len(x)]
        scores = (x[nodes] * query).sum(1)  # one product after the other: alike for every batch and shard
        rows = [
            (-score, vec_id)
            for score, node in zip(scores.tolist(), nodes.tolist(), strict=True)
            for vec_id in ids[node]
            if vec_id != query_id
        ]
        for score, vec_id in sorted(rows)[:shown]:
            yield query_id, vec_id, -score


def search(index: DataFrame, queries: DataFrame, shown: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's nearest; queries are usable vectors."""
    shards = index.agg(F.max("shard")).first()[0]
    shards = 0 if shards is None else shards + 1
    of_size = index.groupBy((F.length("vector") / 8).cast("int").alias("size")).agg(
        F.min("shard").alias("first"), F.max("shard").alias("last")
    )
    asked = (
        queries.withColumn("size", F.size("vector"))
        .join(F.broadcast(of_size), "size")
        .withColumn("shard", F.explode(F.sequence("first", "last")))
        .select(
            F.col("shard").cast("int").alias("shard"),
            F.lit(1).alias("kind"),
            F.col("vec_id").alias("place"),
            "vector",
            F.lit(None).cast("binary").alias("packed"),
            F.lit(None).cast("array<long>").alias("ids"),
            F.lit(None).cast("binary").alias("edges"),
        )
    )
    known = index.select(
        "shard",
        F.lit(0).alias("kind"),
        F.col("node").cast("long").alias("place"),
        F.lit(None).cast("array<double>").alias("vector"),
        F.col("vector").alias("packed"),
        "ids",
        "edges",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, graph = None, [], None
        for batch in batches:
            shard_of, kind = (batch.column(k).to_numpy() for k in (0, 1))
            cuts = np.flatnonzero(np.diff(shard_of) | np.diff(kind)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                rows = batch.slice(a, b - a)
                if shard_of[a] != shard:
                    shard, held, graph = shard_of[a], [], None
                if kind[a] == 0:
                    held.append(rows)
                    continue
                if graph is None:
                    nodes = pa.Table.from_batches(held)
                    x = np.frombuffer(b"".join(nodes.column("packed").to_pylist())).reshape(len(nodes), -1)
                    edges = np.frombuffer(b"".join(nodes.column("edges").to_pylist()), np.int32)
                    graph = x, nodes.column("ids").to_pylist(), edges.reshape(len(nodes), -1)
                    held = []
                vectors = rows.column(3).flatten().to_numpy().reshape(rows.num_rows, -1)
                places = rows.column(2).to_numpy()
                for at in range(0, rows.num_rows, BATCH):
                    found = list(_results(*graph, places[at : at + BATCH], vectors[at : at + BATCH], shown))
                    if found:
                        columns = [pa.array(c, t) for c, t in zip(zip(*found), _TYPES, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    both = known.unionByName(asked).repartition(max(shards, 1), "shard").sortWithinPartitions("shard", "kind", "place")
    found = map_arrow(both, run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= shown)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


_TYPES = (pa.int64(), pa.int64(), pa.float64())


def nearest(vectors: DataFrame, is_query: Column, shown: int = 20) -> DataFrame:
    """For the rows of `vectors` (vec_id, embedding) that are queries, their nearest other rows."""
    rows = _once(usable(vectors))
    asked = vectors.where(is_query).select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    return search(build(rows, shown), rows.join(asked, "vec_id", "left_semi"), shown)


def _once(rows: DataFrame) -> DataFrame:
    """One row for each id: of unequal vectors with the same id the least one, whatever the order of the rows."""
    twice = written(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated")
    if twice.isEmpty():
        return rows
    least = rows.join(twice, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return rows.join(twice, "vec_id", "left_anti").unionByName(least)
