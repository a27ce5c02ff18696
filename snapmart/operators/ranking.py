"""Ranks within a group, bounded or full, and previous-value columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snapmart.session import shared_dir

#: Rows of a piece of a full rank.
PIECE_ROWS = 1_000_000


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group. The limit is applied on the map side too
    (WindowGroupLimit), so a hot group sends ``n`` rows per task."""
    w = W.partitionBy(*group).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= n).drop("_place")


def _unused(df: DataFrame, name: str) -> str:
    """A name of a helper column that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def rank_pieces(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    tie: str,
    place: str,
    pieces: int | None = None,
    cuts_from: DataFrame | None = None,
) -> DataFrame:
    """The rows written in the order of ``rank_in_group``, each with its ``place``: the number of its piece above the
    lower 33 bits, its number in the piece below.

    Spark's range partitioning cuts the whole order (group, value, tie), so pieces are alike in size whatever a group
    or a run of equal values holds. Rows that agree in all three are cut along a hash of the row, and repeated rows by
    chance, which decides nothing but the piece of rows that can't be told apart. The rows are written, since the cuts
    come from a sample: both passes over them must see the same pieces.
    """
    rows = (df if cuts_from is None else cuts_from).count() if pieces is None else 0
    number = pieces or max(1, -(-rows // PIECE_ROWS))
    hashed = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    order = [F.col(f"`{g}`").asc_nulls_first() for g in group]
    order += [F.col(f"`{by}`").desc_nulls_last(), F.col(f"`{tie}`").asc_nulls_last()]
    own, chance = _unused(df, "_hash"), _unused(df, "_chance")
    spread = df.withColumn(own, F.xxhash64(*hashed)).withColumn(chance, F.rand(0))
    ordered = (
        spread.repartitionByRange(number, *order, own, chance)
        .sortWithinPartitions(*order, own)
        .drop(own, chance)
        .withColumn(place, F.monotonically_increasing_id())
    )
    folder = shared_dir(df.sparkSession, "ranked")
    ordered.write.parquet(folder)
    return df.sparkSession.read.schema(ordered.schema).parquet(folder)


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    tie: str,
    name: str = "rank",
    pieces: int | None = None,
    cuts_from: DataFrame | None = None,
) -> DataFrame:
    """Full ``row_number`` in each group by ``by`` descending (nulls last), then ``tie`` ascending (nulls last).

    A plain window would put a whole group into one task. Here the rows are moved once, into pieces of about
    ``PIECE_ROWS`` rows of the whole order (``rank_pieces``). A row's rank is its number among the group's rows in its
    piece plus the group's rows in earlier pieces; a group has one row of counts for each piece it reaches into, so
    these are no more than groups and pieces together, and Spark broadcasts them where their size allows it.

    The number of pieces is measured, from ``cuts_from`` if given (a relation with about as many rows whose count is
    cheaper), or set by ``pieces``; the ranks are exact for any. Rows with equal ``by`` and ``tie`` rank by a hash of
    the row. Any sortable types will do. A column ``name`` of the input is replaced; no other is touched.
    """
    place = _unused(df, "_place")
    ordered = rank_pieces(df, group, by, tie, place, pieces, cuts_from)
    piece, first, size, start = (_unused(df, c) for c in ("_piece", "_first", "_size", "_start"))
    ordered = ordered.withColumn(piece, F.shiftright(place, 33))
    sizes = ordered.groupBy(*[f"`{g}`" for g in group], piece).agg(F.min(place).alias(first), F.count("*").alias(size))
    earlier = W.partitionBy(*[f"`{g}`" for g in group]).orderBy(piece).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn(start, F.coalesce(F.sum(size).over(earlier), F.lit(0))).alias("s")
    same = [F.col(f"r.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in [*group, piece]]
    rank = (F.col(f"s.{start}") + F.col(f"r.{place}") - F.col(f"s.{first}") + 1).alias(name)
    kept = [F.col(f"r.`{c}`") for c in df.columns if c.lower() != name.lower()]
    return ordered.alias("r").join(starts, same).select(*kept, rank)


def with_previous(df: DataFrame, keys: Sequence[str], day: str, rank: str) -> DataFrame:
    """Previous rank, rank change, first-appearance flag and previous day for each key.

    ``df`` has one row per key and day, so a window partition is bounded by the number of days and
    not by the volume of data. One window serves all four columns. A positive change is a move up.
    """
    w = W.partitionBy(*keys).orderBy(F.col(day).asc_nulls_last())
    before = F.lag(rank).over(w)
    return (
        df.withColumn("_before", before)
        .withColumn(f"prev_{day}", F.lag(day).over(w))
        .withColumn(f"prev_{rank}", F.coalesce("_before", rank))
        .withColumn("rank_change", F.col(f"prev_{rank}") - F.col(rank))
        .withColumn("is_new_entry", F.col("_before").isNull())
        .drop("_before")
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Report of the first ``k`` rows (planned as TakeOrderedAndProject: ``k`` rows per task)."""
    return df.orderBy(*order).limit(k)
