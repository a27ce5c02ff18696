"""N-gram Jaccard join by T-occurrence search: documents whose word shingle sets reach a Jaccard similarity.

Two sets of n and m shingles reach the similarity only if they share T = ceil(t * n) shingles of either set. As in
DivideSkip, the inverted lists of a document are divided by length: its T - 1 most frequent shingles are its long lists,
which are never merged, and the others, its short lists, must hold every partner at least once. The short lists are
merged in sorted order (Spark's external merge sort by shingle), and whatever meets there is probed against the
long ones by binary search until the required overlap is reached or out of reach.

1. All documents' shingles are counted in a sketch of 2 ** SKETCH_BITS counters. It is only used as the order from
   rare to frequent, the same for all documents, so its collisions cost time but no links. It is what is broadcast.
2. Every document becomes a class id (hash of its shingle set; copies share it), its set's size, a signature (counts of
   its shingles in SIGNATURE buckets, modulo 16) and its short lists. Copies within a task give no second set of lists.
3. Lists are merged; those with one class are dropped, and so are classes that no other of their list can reach by size
   and mark (the signature folded to MARKS counters, which travels with the lists). Lists that the sketch shows to be
   long are cut into parts by the classes' hash, so no task gets an unbounded list.
4. Round one tests, in each list, every class against the few before it in an order that differs from list to list: a
   number of pairs in proportion to the list's length. Signatures reject most pairs that are too far apart (the sum of
   the counts' differences never exceeds the sets' symmetric difference), and outlines, counts in about as many buckets
   as a set has shingles, reject nearly all others of these. Of the rest one pair of each class is tested on the whole
   sets, and then those between different components.
5. Round two is exact: in each list, and between the parts of a cut list, all pairs of classes in different components
   that sizes and signatures allow are tested. A pair within a component can't change it. So a group of thousands
   of near copies is joined by a few links a class, and no pair of different components is skipped. A list is
   taken as the pair's first, so the shingles from there on must reach the required overlap in both sets: that holds in
   the first list of every link, and elsewhere it would name a pair again or one that shares too little.

Words are runs of other than white space with A-Z lower-cased, a shingle is `size` words, and a text with fewer words is
one shingle of all of them. Shingles and classes are 64-bit hashes. Null texts and texts without words have no shingles,
link with nothing and are components of their own. Repeated rows are in one class. Null ids never name a component
unless it has no other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.llm.common import map_arrow, rows_with, rows_without, written
from snapmart.llm.components import components
from snapmart.llm.text import Slice, mix, sorted_sets, text_slices, window_hashes, words_of

SKETCH_BITS = 20

#: Counters of a signature, each modulo 16 in half a byte.
SIGNATURE = 512

#: Counters of a signature that is folded for a first test, where many are compared.
FOLDED = 128

#: Counters of a mark, in two numbers of 64 bits.
MARKS = 32

#: Counters of a sketch in one row of the shuffle that adds them.
_CHUNK = 4096

#: A list is cut into parts of about so many classes; round one tests so many neighbours of a class in a list.
LIST_PART = 20_000
NEIGHBOURS = 2

#: Texts are cut into words so many bytes at a time; their words and shingles take about fifty times that.
TEXT_BYTES = 1 << 19


def shingle_sets(part: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingle hashes, ascending, and the rows' bounds."""
    words = words_of(part)
    hashes, bounds = window_hashes(words.hashes, words.bounds, size)
    counts = np.diff(words.bounds)
    if ((counts > 0) & (counts < size)).any():
        rows = [np.repeat(np.arange(len(part)), np.diff(bounds))]
        found = [hashes]
        for few in range(1, size):
            whole = np.flatnonzero(counts == few)
            shorter, cuts = window_hashes(words.hashes, words.bounds, few)
            rows.append(whole)
            found.append(mix(shorter[cuts[whole]] + np.uint64(few)))
        rows, hashes = np.concatenate(rows), np.concatenate(found)
        order = np.argsort(rows, kind="stable")
        hashes, bounds = hashes[order], np.searchsorted(rows[order], np.arange(len(part) + 1))
    return sorted_sets(hashes, bounds)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def frequency_sketch(docs: DataFrame, size: int) -> np.ndarray:
    """How many documents' shingles fall on each counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for part in text_slices(batch.column(0), TEXT_BYTES):
                counts += np.bincount(_buckets(shingle_sets(part, size)[0]), minlength=len(counts))
        yield from rows(dict(enumerate(counts.reshape(-1, _CHUNK))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = _unpacked(counts.as_buffer()).astype(np.int64)
                sums[chunk] = sums[chunk] + counts if chunk in sums else counts
        yield from rows(sums)

    def rows(chunks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if chunks:
            packed = [_packed(np.minimum(c, 2**32 - 1).astype(np.uint32)) for c in chunks.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(chunks), pa.int32()), pa.array(packed, pa.binary())], names=["chunk", "counts"]
            )

    schema = "chunk int, counts binary"
    counted = map_arrow(docs.select("text"), count, schema).repartition("chunk")
    out = np.zeros(1 << SKETCH_BITS, np.uint32)
    for row in map_arrow(counted, add, schema).collect():  # one row for each chunk
        out[row["chunk"] * _CHUNK : (row["chunk"] + 1) * _CHUNK] = _unpacked(row["counts"])
    return out


def _packed(counts: np.ndarray) -> bytes:
    """Counters of a chunk; of few that are not 0 only these, as places and counts."""
    used = np.flatnonzero(counts)
    if 6 * len(used) >= counts.nbytes:
        return counts.tobytes()
    return used.astype(np.uint16).tobytes() + counts[used].tobytes()


def _unpacked(packed) -> np.ndarray:
    if len(packed) == 4 * _CHUNK:
        return np.frombuffer(packed, np.uint32)
    n = len(packed) // 6
    out = np.zeros(_CHUNK, np.uint32)
    out[np.frombuffer(packed, np.uint16, n)] = np.frombuffer(packed, np.uint32, n, 2 * n)
    return out


def _nibbles(counts: np.ndarray) -> np.ndarray:
    """Counters modulo 16, two in a byte."""
    counts = counts % 16
    return (counts[::2] | counts[1::2] << 4).astype(np.uint8)


def _class(hashes: np.ndarray) -> int:
    """Signed 64-bit hash of a set; never null, and no set's order matters."""
    total = mix(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return int(mix(np.array([total]))[0].astype(np.int64))


def _profiles(docs: DataFrame, size: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """doc_id, n, node (null without shingles), and for a class's first row in a task signature, mark and short lists."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # classes of this task's input split
        for batch in batches:
            for part in text_slices(batch.column(1), TEXT_BYTES):
                hashes, bounds = shingle_sets(part, size)
                often = shared.value[_buckets(hashes)]
                nodes, signatures, short, folded = [], [], [], []
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    own = hashes[a:b]
                    node = _class(own) if b > a else None
                    nodes.append(node)
                    if b == a or node in seen:
                        signatures.append(None)
                        short.append(None)
                        folded.append([None, None])
                        continue
                    seen.add(node)
                    counts = np.bincount((own & np.uint64(SIGNATURE - 1)).astype(np.int64), minlength=SIGNATURE)
                    signatures.append(_nibbles(counts).tobytes())
                    folded.append(_nibbles(counts.reshape(-1, MARKS).sum(0)).view(np.int64).tolist())
                    n = int(b - a)
                    rare = np.lexsort((own, often[a:b]))[: n - -(-percent * n // 100) + 1]
                    parts = np.maximum(often[a:b][rare].astype(np.int64) // LIST_PART, 1)
                    short.append(list(zip(own[rare].astype(np.int64).tolist(), parts.tolist(), strict=True)))
                lists = [None if s is None else [{"token": t, "parts": k} for t, k in s] for s in short]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array(nodes, pa.int64()),
                        pa.array(signatures, pa.binary()),
                        *(pa.array([m[k] for m in folded], pa.int64()) for k in range(2)),
                        pa.array(lists, pa.list_(pa.struct([("token", pa.int64()), ("parts", pa.int64())]))),
                    ],
                    names=["doc_id", "n", "node", "signature", "mark1", "mark2", "short"],
                )

    schema = "doc_id long, n long, node long, signature binary, mark1 long, mark2 long, short array<struct<token:long,parts:long>>"
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def _whole_lists(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Sorted rows in tables that never end within a list; a list is rows that agree in the first `keys` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for k in range(keys):
            column = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= column[1:] != column[:-1]
            if held and column[0] != held[-1].column(k)[held[-1].num_rows - 1].as_py():
                new[0] = True
        cuts = np.flatnonzero(new)
        if len(cuts):
            if held or cuts[-1]:
                yield pa.Table.from_batches([*held, batch.slice(0, cuts[-1])])
            held = [batch.slice(cuts[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _merged_lists(percent: int):
    """Lists without repeats, of the classes that another of the list can reach (all of a cut list's part), each class
    with those of the NEIGHBOURS just before it that it can reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_lists(batches, 2):
            token, part, parts, node, n, place, *folded = (
                _column(table, c) for c in ("token", "part", "parts", "node", "n", "place", "mark1", "mark2")
            )
            fresh = np.ones(len(token), bool)
            fresh[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1]) | (node[1:] != node[:-1])
            token, part, parts, node, n, place, *folded = (x[fresh] for x in (token, part, parts, node, n, place, *folded))
            begins = np.ones(len(token), bool)
            begins[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1])
            which = np.cumsum(begins)
            sizes = np.bincount(which)[which]
            some = np.flatnonzero((sizes > 1) | (parts > 1))
            token, part, parts, node, n, place, which, *folded = (
                x[some] for x in (token, part, parts, node, n, place, which, *folded)
            )
            marks = _split(np.stack(folded, 1).view(np.uint8))
            kept = np.flatnonzero((parts > 1) | _reachable(which, n, marks, percent))
            which, n, marks = which[kept], n[kept], marks[kept]
            before: list[list[int]] = [[] for _ in kept]
            for lag in range(1, NEIGHBOURS + 1):
                here = np.flatnonzero(which[lag:] == which[:-lag]) + lag
                for i in here[_allowed(n, marks, here, here - lag, percent)]:
                    before[i].append(int(node[kept[i - lag]]))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x[kept]) for x in (token, part, parts, node, place)), pa.array(before, pa.list_(pa.int64()))],
                names=["token", "part", "parts", "node", "place", "before"],
            )

    return run


def _allowed(n: np.ndarray, marks: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and marks allow the similarity."""
    near = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    for at in range(0, len(i), 1 << 16):
        block = slice(at, at + (1 << 16))
        near[block] &= ~_far(n[i[block]] + n[j[block]], _least_difference(marks[i[block]], marks[j[block]]), percent)
    return near


def _reachable(which: np.ndarray, n: np.ndarray, marks: np.ndarray, percent: int) -> np.ndarray:
    """Whether a class has another one in its list that sizes and marks allow; who has found one asks no more."""
    order = np.lexsort((n, which))
    which, n, marks = which[order], n[order], marks[order]
    found = np.zeros(len(n), bool)
    here, lag = np.arange(len(n)), 0
    while len(here):
        lag += 1
        here = here[here + lag < len(n)]
        here = here[(which[here + lag] == which[here]) & (100 * n[here] >= percent * n[here + lag])]
        ask = here[~(found[here] & found[here + lag])]
        good = ask[_allowed(n, marks, ask, ask + lag, percent)]
        found[good] = found[good + lag] = True
    out = np.zeros(len(n), bool)
    out[order] = found
    return out


def _far(sum_of_sizes: np.ndarray, difference: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes that differ in so many shingles miss 100 * intersection >= percent * union."""
    return 100 * (sum_of_sizes - difference) < percent * (sum_of_sizes + difference)


def _signatures(column) -> np.ndarray:
    return _split(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SIGNATURE // 2))


def _split(packed: np.ndarray) -> np.ndarray:
    return np.concatenate([packed & 15, packed >> 4], axis=1).astype(np.int8)


def _least_difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many shingles the sets differ at least: the counters' distances modulo 16 never exceed their true ones."""
    apart = np.abs(x - y)
    return np.minimum(apart, 16 - apart).sum(1, dtype=np.int64)


def _near_signatures(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that sizes and signatures allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, na, nb, sa, sb = batch.columns
                sums = na.to_numpy() + nb.to_numpy()
                least = _least_difference(_signatures(sa), _signatures(sb))
                keep = pa.array(~_far(sums, least, percent))
                yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    of = classes.select("node", "n", "signature")
    both = (
        pairs.join(of.toDF("a", "na", "sa"), "a")
        .join(of.toDF("b", "nb", "sb"), "b")
        .where(_sizes_allow(F.col("na"), F.col("nb"), percent))
        .select("a", "b", "na", "nb", "sa", "sb")
    )
    return map_arrow(both, run, "a long, b long")


def _sizes_allow(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _cross_pairs(percent: int):
    """In each list, the pairs of classes of different components that sizes, signatures and their places in this list
    allow (`_can_be_first`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_lists(batches, 3):
            token, low, high, n, node, root, part, place = (
                _column(table, c) for c in ("token", "low", "high", "n", "node", "root", "part", "place")
            )
            marks = _signatures(table.column("signature").combine_chunks())
            folded = marks.reshape(len(marks), -1, FOLDED).sum(1, dtype=np.int16).astype(np.int8) % 16
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            which = np.cumsum(new)
            active, lag = np.arange(len(token)), 0
            # Rows of a list ascend by size: once a row and the one `lag` after it are too far apart in size, all
            # later ones are.
            while len(active):
                lag += 1
                active = active[active + lag < len(token)]
                other = active + lag
                near = (which[other] == which[active]) & (100 * n[active] >= percent * n[other])
                active, other = active[near], other[near]
                # Rows of the same part of a cut list meet where both blocks are that part.
                apart = (root[active] != root[other]) & ((low[active] == high[active]) | (part[active] != part[other]))
                apart &= _can_be_first(n[active], n[other], place[active], place[other], percent)
                a, b = active[apart], other[apart]
                for at in range(0, len(a), 8192):
                    i, j = a[at : at + 8192], b[at : at + 8192]
                    for counters in (folded, marks):
                        good = ~_far(n[i] + n[j], _least_difference(counters[i], counters[j]), percent)
                        i, j = i[good], j[good]
                    if len(i):
                        x, y = node[i], node[j]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"]
                        )

    return run


def _can_be_first(n: np.ndarray, m: np.ndarray, p: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes n and m whose first common shingle, from rare to frequent, is at places p and q (from 0) can
    reach the similarity: what they share is not before these places."""
    return (100 + percent) * np.minimum(n - p, m - q) >= percent * (n + m)


def _outline(hashes: np.ndarray) -> bytes:
    """A set's size, and its counts modulo 16 in as many buckets as the next power of two from SIGNATURE on."""
    buckets = max(SIGNATURE, 1 << (len(hashes) - 1).bit_length())
    counts = np.bincount((hashes & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets) % 16
    halves = counts[: buckets // 2] | counts[buckets // 2 :] << 4
    return np.int64(len(hashes)).tobytes() + halves.astype(np.uint8).tobytes()


def outlines_allow(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets with these outlines, as bytes, can reach the similarity; the longer is folded to the shorter."""
    sizes = [int(o[:8].view(np.int64)[0]) for o in (x, y)]
    counts = [_split(o[None, 8:]) for o in (x, y)]
    width = min(c.shape[1] for c in counts)
    counts = [(c.reshape(-1, width).sum(0, dtype=np.int64) % 16).astype(np.int8)[None] for c in counts]
    return not _far(sum(sizes), int(_least_difference(*counts)[0]), percent)


def _whole(hashes: np.ndarray) -> bytes:
    return hashes.tobytes()


def _of_classes(docs: DataFrame, classes: DataFrame, nodes: DataFrame, size: int, form: Callable) -> DataFrame:
    """node and `form` of the set of the given classes, from the text of one document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(0), TEXT_BYTES):
                hashes, bounds = shingle_sets(part, size)
                sets = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_class(s) for s in sets], pa.int64()), pa.array([form(s) for s in sets], pa.binary())],
                    names=["node", "value"],
                )

    wanted = written(classes.join(nodes, "node", "left_semi").select("doc_id").distinct(), "wanted")
    texts = rows_with(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), F.col("doc_id"), wanted)
    found = map_arrow(texts.select("text"), run, "node long, value binary")
    return found.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("value").alias("value"))


def reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets reach the similarity: the smaller is probed in the larger by binary search, block by
    block, until the required overlap is there or can't be reached any more."""
    if len(x) > len(y):
        x, y = y, x
    need = -(-percent * (len(x) + len(y)) // (100 + percent))
    shared = 0
    for at in range(0, len(x), 512):
        probe = x[at : at + 512]
        places = np.minimum(np.searchsorted(y, probe), len(y) - 1)
        shared += int((y[places] == probe).sum())
        if shared >= need:
            return True
        if shared + len(x) - at - len(probe) < need:
            return False
    return shared >= need


def _passed(pairs: DataFrame, values: DataFrame, test: Callable[[np.ndarray, np.ndarray], bool], kind: type) -> DataFrame:
    """The pairs (a, b) of classes whose values, as arrays of `kind`, pass the test."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = batch.columns
            keep = [
                test(np.frombuffer(p.as_buffer(), kind), np.frombuffer(q.as_buffer(), kind))
                for p, q in zip(x, y, strict=True)
            ]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    both = pairs.join(values.toDF("a", "x"), "a").join(values.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return map_arrow(both, run, "a long, b long")


def _near_outlines(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """A written table of the pairs whose outlines allow the similarity."""
    outlines = written(_of_classes(docs, classes, _ends(pairs), size, _outline), "outlines")
    return written(_passed(pairs, outlines, partial(outlines_allow, percent=percent), np.uint8), "near")


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """A written table of the pairs whose whole sets reach the similarity."""
    sets = written(_of_classes(docs, classes, _ends(pairs), size, _whole), "sets")
    return written(_passed(pairs, sets, partial(reaches, percent=percent), np.uint64), "linked")


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose classes are in different components; a class without a root is one of its own."""
    both = pairs.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left")
    return both.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def join(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """For every row of `docs` (doc_id, text): doc_id, n_shingles and component_id.

    Documents link if 100 * intersection >= percent * union of their shingle sets; component_id is the smallest
    doc_id that links reach.
    """
    return _found(docs, size, percent).select("doc_id", "n_shingles", "component_id")


def _found(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The rows of the join with the class of their shingles and the root of its component, null without shingles."""
    profiles = written(_profiles(docs, size, percent, frequency_sketch(docs, size)), "profiles")
    classes = written(
        profiles.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n").alias("n"),
            F.first("signature", ignorenulls=True).alias("signature"),
        ),
        "classes",
    )
    postings = profiles.where(F.col("short").isNotNull()).select(
        "node", "n", "mark1", "mark2", F.posexplode("short").alias("place", "s")
    ).select(
        F.col("s.token").alias("token"),
        F.pmod(F.xxhash64("s.token", "node"), F.col("s.parts")).cast("int").alias("part"),
        F.col("s.parts").cast("int").alias("parts"),
        "node",
        "n",
        "place",
        "mark1",
        "mark2",
    )
    sorted_postings = postings.repartition("token", "part").sortWithinPartitions(
        "token", "part", F.xxhash64("token", "node"), "node"
    )
    lists = written(
        map_arrow(
            sorted_postings,
            _merged_lists(percent),
            "token long, part int, parts int, node long, place int, before array<long>",
        ),
        "lists",
    )

    def ordered(a: Column, b: Column) -> tuple[Column, Column]:
        return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")

    near = lists.select("node", F.explode("before").alias("other"))
    near = near.select(*ordered(F.col("node"), F.col("other"))).distinct()
    first = written(_near_signatures(near, classes, percent), "pairs")
    near = _near_outlines(docs, classes, first, size, percent)
    lead = near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = _linked(docs, classes, written(lead, "lead"), size, percent)
    roots = components(links)
    rest = written(_between(near, roots).join(lead, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        links = links.unionByName(_linked(docs, classes, rest, size, percent))
        roots = components(links)

    # Round two. Only lists that still hold several components matter.
    rooted = (
        lists.select("token", "part", "parts", "node", "place")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    mixed = rooted.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
    mixed = mixed.where(F.col("r1") < F.col("r2")).select("token")
    blocks = (
        rooted.join(mixed, "token", "left_semi")
        .join(classes.select("node", "n", "signature"), "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "token",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            "n",
            "node",
            "root",
            "part",
            "place",
            "signature",
        )
    )
    blocks = blocks.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high", "n", "node")
    second = map_arrow(blocks, _cross_pairs(percent), "a long, b long").distinct()
    second = written(second.join(first, ["a", "b"], "left_anti"), "pairs")
    if not second.isEmpty():
        near = _near_outlines(docs, classes, second, size, percent)
        roots = components(links.unionByName(_linked(docs, classes, near, size, percent)))

    found = classes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = found.join(names, "root").select("node", "root", "component_id")
    return profiles.join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "node",
        "root",
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def _with_class(docs: DataFrame, size: int) -> DataFrame:
    """All rows and columns of `docs`, and `__node`, the class of the row's shingles (null without any)."""
    place = docs.columns.index("text")
    names = [*docs.columns, "__node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = []
            for part in text_slices(batch.column(place), TEXT_BYTES):
                hashes, bounds = shingle_sets(part, size)
                nodes += [_class(hashes[a:b]) if b > a else None for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], names=names)

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField("__node", T.LongType())]))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents whose doc_id is the smallest of their component, with their own columns.

    Rows that repeat an id are decided one by one, by the class of their shingles: a row goes if its own component has a
    smaller id, and of an id's rows in one component, or without shingles, the one with the smallest text stays. Documents
    without an id all stay, as nothing tells them apart; documents without shingles link with nothing and stay.
    """
    found = _found(docs, size, percent)
    key = F.col("doc_id").cast("long")
    gone = written(found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "gone")
    twice = written(
        found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select(
            F.col("doc_id").alias("__twice")
        ),
        "repeated",
    )
    if twice.isEmpty():
        return rows_without(docs, key, gone)
    once = rows_without(docs, key, gone.unionByName(twice.toDF("doc_id")).distinct())
    stay = (
        found.join(twice, F.col("doc_id") == F.col("__twice"), "left_semi")
        .where(F.col("component_id") == F.col("doc_id"))
        .select(F.col("doc_id").alias("__id"), F.col("node").alias("__of"), F.col("root").alias("__root"))
        .distinct()
    )
    rows = _with_class(rows_with(docs, key, twice), size)
    rows = rows.join(stay, (key == F.col("__id")) & F.col("__node").eqNullSafe(F.col("__of")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = rows.groupBy("__id", "__root").agg(F.min_by(row, F.struct(F.col("text").isNull(), "text")).alias("row"))
    return once.unionByName(one.select("row.*"))
