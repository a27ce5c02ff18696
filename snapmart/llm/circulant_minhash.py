"""Near-duplicate documents by circulant MinHash: banding, exact Jaccard verification, connected components.

Two permutations of the 64-bit numbers make a whole signature: the first scatters the shingles, the second ranks them,
and coordinate k is the smallest rank of the scattered shingles shifted by k around the circle of 2 ** 64 places. So a
signature of any length needs two fixed permutations instead of one for each coordinate.

1. Every document becomes a class (hash of its shingle set; copies share it) with its set's size, the keys of its bands
   (BANDS hashes of ROWS coordinates each) and its tallies (how many of its shingles fall on each of TALLIES counters,
   modulo 16).
2. The classes that share a band's key are a bucket. Its leaders are the smallest and the largest class, found by an
   aggregate with a map-side part, so a bucket is never gathered; buckets of one class end here.
3. Round one verifies each class against the LEADERS leaders with which it shares most buckets: a few pairs a class, also
   in a group of any size. Linked classes become components.
4. Later rounds look at the buckets that still hold several components. Only classes outside a bucket's largest
   component ask, so a group of near copies costs its few strays, and large buckets are cut into blocks of at most PART
   by PART classes. In the JOINING rounds each component of a block names the pair that is closest by its tallies. The last
   round is complete: it verifies all pairs of different components that sizes and tallies allow. The sum of the
   tallies' differences never exceeds the sets' symmetric difference, so what they refuse is no link.
5. Links are confirmed on the full sets: 100 * intersection >= percent * union.

Two documents at similarity 0.8 share a bucket but for a chance of (1 - 0.8 ** 4) ** 40 = 7e-10; nothing is capped.
Lower limits of similarity ask for more bands (parameters).

Words are runs of other than white space with A-Z lower-cased, a shingle is `size` words, and a text with fewer words is
one shingle of all of them. Null texts and texts without words have no shingles, link with nothing and are components of
their own. Repeated rows are one class. Null ids never name a component unless it has no other; a row is kept if its
id is its component's (null ids of such components, too). Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import map_arrow, written
from snapmart.llm.components import components
from snapmart.llm.jaccard_join import reaches, shingle_sets
from snapmart.llm.text import mix, text_slices

BANDS = 40
ROWS = 4

#: Round one verifies so many leaders of a class.
LEADERS = 2

#: Rounds in which each component of a block names one pair.
JOINING = 1

#: Classes on either side of a block.
PART = 2000

TALLIES = 256

#: Shingles that are ranked at once, to stay within the processor's cache.
_BLOCK = 1 << 14

#: The first permutation is the product with an odd number, then `mix`; the second is `mix` alone.
_SCATTER = np.uint64(0xD6E8FEB86659FD93)

#: Buckets of class ids in the set that tells tasks which sets are asked for: a broadcast of at most 2 ** 20 bits.
_ASKED = 1 << 20

#: Up to so many asked classes their documents are picked by a broadcast of ids; beyond, tasks pick them by the set above.
_FEW = 10_000


def signatures(hashes: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """One row of `length` coordinates for each set of shingle hashes; sets are given by bounds and none is empty."""
    out = np.empty((len(bounds) - 1, length), np.uint64)
    first = 0
    while first < len(out):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + _BLOCK, "right")) - 1)
        places = mix(hashes[bounds[first] : bounds[last]] * _SCATTER)
        starts = bounds[first:last] - bounds[first]
        for k in range(length):
            out[first:last, k] = np.minimum.reduceat(mix(places + np.uint64(k)), starts)
        first = last
    return out


def band_keys(coordinates: np.ndarray, bands: int) -> np.ndarray:
    """A hash of each band's coordinates and of its number."""
    grouped = coordinates.reshape(len(coordinates), bands, -1)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), grouped.shape[:2])
    for k in range(grouped.shape[2]):
        keys = mix(keys * _SCATTER + grouped[:, :, k])
    return keys.astype(np.int64)


def tallies(hashes: np.ndarray) -> bytes:
    """How many shingles fall on each counter, modulo 16, two counters in a byte."""
    counts = np.bincount((hashes >> np.uint64(20)).astype(np.int64) % TALLIES, minlength=TALLIES) % 16
    return (counts[::2] | counts[1::2] << 4).astype(np.uint8).tobytes()


def _unpacked(column) -> np.ndarray:
    packed = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return np.concatenate([packed & 15, packed >> 4], axis=1).astype(np.int8)


def _least_difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many shingles the sets differ at least: distances modulo 16 never exceed the true ones."""
    apart = np.abs(x - y)
    return np.minimum(apart, 16 - apart).sum(1, dtype=np.int64)


def _possible(sizes: np.ndarray, difference: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of this sum of sizes that differ in so many shingles can have 100 * intersection >= percent * union."""
    return 100 * (sizes - difference) >= percent * (sizes + difference)


def _class_of(hashes: np.ndarray) -> int:
    """Signed 64-bit hash of a set."""
    total = mix(hashes + np.uint64(1)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total * _SCATTER + np.uint64(len(hashes)))[0].astype(np.int64))


def _profiles(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n, node (null without shingles), and for a class's first row in a task its keys and tallies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # classes of this task's input split
        for batch in batches:
            for part in text_slices(batch.column(1)):
                hashes, bounds = shingle_sets(part, size)
                nodes = [_class_of(hashes[a:b]) if b > a else None for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                fresh = []
                for k, node in enumerate(nodes):
                    if node is not None and node not in seen:
                        seen.add(node)
                        fresh.append(k)
                keys: list = [None] * len(nodes)
                signs: list = [None] * len(nodes)
                if fresh:
                    sizes = np.diff(bounds)[fresh]
                    wanted = np.repeat(np.isin(np.arange(len(nodes)), fresh), np.diff(bounds))
                    found = signatures(hashes[wanted], np.concatenate([[0], np.cumsum(sizes)]), bands * rows)
                    for k, own in zip(fresh, band_keys(found, bands), strict=True):
                        keys[k], signs[k] = own, tallies(hashes[bounds[k] : bounds[k + 1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array(nodes, pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(signs, pa.binary()),
                    ],
                    names=["doc_id", "n", "node", "keys", "tallies"],
                )

    schema = "doc_id long, n long, node long, keys array<long>, tallies binary"
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def _sizes_allow(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that sizes and tallies allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, n, m, x, y = batch.columns
                least = _least_difference(_unpacked(x), _unpacked(y))
                keep = pa.array(_possible(n.to_numpy() + m.to_numpy(), least, percent))
                yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    of = classes.select("node", "n", "tallies")
    both = pairs.join(of.toDF("a", "n", "x"), "a").join(of.toDF("b", "m", "y"), "b")
    both = both.where(_sizes_allow(F.col("n"), F.col("m"), percent)).select("a", "b", "n", "m", "x", "y")
    return map_arrow(both, run, "a long, b long")


def _sets(docs: DataFrame, nodes: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """node and full set of the given classes, cut anew from the texts without moving any.

    Of few classes only one document each is cut. Otherwise tasks know the asked classes by the bucket of their id, from
    a set of fixed size; a join drops what else falls there.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if nodes.count() <= _FEW:
        ids = F.broadcast(classes.join(nodes, "node").select(F.col("doc_id").alias("of")))
        docs = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("of")), "left_semi")
    bucket = F.pmod("node", F.lit(_ASKED)).cast("int").alias("bucket")
    asked = np.zeros(_ASKED, bool)
    asked[[r["bucket"] for r in nodes.select(bucket).distinct().collect()]] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = np.unpackbits(shared.value).view(bool), set()
        for batch in batches:
            for part in text_slices(batch.column(0)):
                hashes, bounds = shingle_sets(part, size)
                found = {}
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    node = _class_of(hashes[a:b]) if b > a else None
                    if node is not None and wanted[node % _ASKED] and node not in seen:
                        seen.add(node)
                        found[node] = hashes[a:b].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())],
                    names=["node", "hashes"],
                )

    found = map_arrow(docs.select("text"), run, "node long, hashes binary").join(nodes, "node", "left_semi")
    return found.groupBy("node").agg(F.first("hashes").alias("hashes"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = batch.columns
            near = [
                reaches(np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64), percent)
                for p, q in zip(x, y, strict=True)
            ]
            near = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(near), b.filter(near)], names=["a", "b"])

    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return map_arrow(both, run, "a long, b long")


def _leader_pairs(members: DataFrame) -> DataFrame:
    """(a, b), a < b: each class with those of its buckets' leaders that lead most of its buckets."""
    led = members.select("node", F.explode(F.array("low", "high")).alias("leader")).where("node <> leader")
    shared = led.groupBy("node", "leader").count()
    best = Window.partitionBy("node").orderBy(F.desc("count"), "leader")
    chosen = shared.withColumn("place", F.row_number().over(best)).where(F.col("place") <= LEADERS)
    return chosen.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _blocks(members: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of a later round: (key, kind, low, high) is a block, in which rows of different `side` and root meet.

    Kind 0 holds classes of the bucket's largest component (side 0) and others (side 1); kind 1 holds others alone, whose
    side is their part, or their place in a block of one part, where all meet.
    """
    rooted = members.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counted = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed = (
        counted.groupBy("key")
        .agg(F.sum("c").alias("all"), F.max(F.struct("c", "root")).alias("top"), F.count(F.lit(1)).alias("roots"))
        .where("roots > 1")
        .select(
            "key",
            F.col("top.root").alias("major"),
            F.ceil(F.col("top.c") / PART).cast("int").alias("majors"),
            F.ceil((F.col("all") - F.col("top.c")) / PART).cast("int").alias("others"),
        )
    )
    spread = F.xxhash64("node", "key")
    rows = rooted.join(mixed, "key").withColumn("is_major", F.col("root") == F.col("major"))
    rows = rows.withColumn("part", F.pmod(spread, F.when(F.col("is_major"), F.col("majors")).otherwise(F.col("others"))).cast("int"))

    def cell(kind: int, low: Column, high: Column, side: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), low.cast("int").alias("low"), high.cast("int").alias("high"), side.cast("int").alias("side")
        )

    part = F.col("part")
    upto_majors, upto_others = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("majors", "others"))
    of_major = F.transform(upto_others, lambda q: cell(0, part, q, F.lit(0)))
    of_other = F.concat(
        F.transform(upto_majors, lambda p: cell(0, p, part, F.lit(1))),
        F.transform(upto_others, lambda q: cell(1, F.least(part, q), F.greatest(part, q), part)),
    )
    cells = rows.select("key", "node", "root", F.explode(F.when(F.col("is_major"), of_major).otherwise(of_other)).alias("cell"))
    return cells.join(classes.select("node", "n", "tallies"), "node").select("key", "cell.*", "n", "node", "root", "tallies")


def _block_pairs(percent: int, closest: bool):
    """Pairs of different components that sizes and tallies allow, from rows sorted by block and size: all of them, or
    of each block's component the one whose tallies differ least for its size."""

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        kind, low, high, side, n, node, root = (
            table.column(c).to_numpy() for c in ("kind", "low", "high", "side", "n", "node", "root")
        )
        signs = _unpacked(table.column("tallies").combine_chunks())
        block = np.cumsum(_begins(table))
        _, component = np.unique(np.stack([block, root]), axis=1, return_inverse=True) if closest else (None, None)
        best = np.empty((0, 4))  # component, rank, i, j
        alone = (kind == 1) & (low == high)
        here, lag = np.arange(len(n)), 0
        while len(here):  # once a row and the one `lag` after it differ too much in size, so do all later ones
            lag += 1
            here = here[here + lag < len(n)]
            here = here[(block[here + lag] == block[here]) & (100 * n[here] >= percent * n[here + lag])]
            there = here + lag
            ask = (root[here] != root[there]) & (alone[here] | (side[here] != side[there]))
            a, b = here[ask], there[ask]
            for at in range(0, len(a), 8192):
                i, j = a[at : at + 8192], b[at : at + 8192]
                least = _least_difference(signs[i], signs[j])
                good = _possible(n[i] + n[j], least, percent)
                i, j, least = i[good], j[good], least[good]
                if closest:
                    best = _least_of_each(best, component[i], component[j], least / (n[i] + n[j]), i, j)
                elif len(i):
                    yield _ordered(node[i], node[j])
        if len(best):
            i, j = best[:, 2:].astype(np.int64).T
            yield _ordered(node[i], node[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            cut = int(np.flatnonzero(_begins(table))[-1])  # the last block may go on in the next batch
            if cut:
                yield from pairs(table.slice(0, cut).combine_chunks())
            held = table.slice(cut).to_batches()
        if held:
            yield from pairs(pa.Table.from_batches(held).combine_chunks())

    return run


def _least_of_each(best: np.ndarray, x: np.ndarray, y: np.ndarray, rank: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Each component's row (component, rank, i, j) of least rank, of those so far and of pairs of components x and y."""
    if not len(i):
        return best
    found = np.concatenate([best, np.stack([x, rank, i, j], 1), np.stack([y, rank, i, j], 1)])
    found = found[np.lexsort(found.T[::-1])]
    return found[np.append(True, found[1:, 0] != found[:-1, 0])]


def _ordered(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _begins(table: pa.Table) -> np.ndarray:
    """Where another block begins."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for name in ("key", "kind", "low", "high"):
        column = table.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return new


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def _with(before: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if before is None else before.unionByName(more)


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """For every row of `docs` (doc_id, text): doc_id, n_shingles, component_id and kept.

    component_id is the smallest doc_id that links reach; the row with that id is kept.
    """
    profiles = written(_profiles(docs, size, bands, rows), "signatures")
    classes = written(
        profiles.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n").alias("n"),
            F.first("keys", ignorenulls=True).alias("keys"),
            F.first("tallies", ignorenulls=True).alias("tallies"),
        ),
        "classes",
    )
    postings = classes.select(F.explode("keys").alias("key"), "node")
    leaders = postings.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = written(postings.join(leaders, "key"), "buckets")

    found = written(_likely(_leader_pairs(members), classes, percent), "pairs")
    tested, sets, links, roots = None, None, None, None
    for step in range(JOINING + 2):
        if step:
            blocks = _blocks(members, roots, classes).repartition("key", "kind", "low", "high")
            blocks = blocks.sortWithinPartitions("key", "kind", "low", "high", "n", "node")
            found = map_arrow(blocks, _block_pairs(percent, step <= JOINING), "a long, b long").distinct()
            found = written(found.join(tested, ["a", "b"], "left_anti"), "pairs")
            if found.isEmpty():
                continue
        asked = _ends(found) if sets is None else _ends(found).join(sets, "node", "left_anti")
        sets = _with(sets, written(_sets(docs, written(asked, "asked"), classes, size), "sets"))
        tested = _with(tested, found)
        links = _with(links, written(_verified(found, sets, percent), "links"))
        roots = components(links)

    found = classes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = found.join(names, "root").select("node", "component_id")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return profiles.select("doc_id", "n", "node").join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
