"""Newest row per key, per key and day, and the newest batch of a table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import day_of, moment
from snapmart.operators.ranking import top_per_group


DAY = "snapshot_date"  # the day of a row's time; the partition column of a stored history
FAR_FUTURE = datetime(9999, 12, 31, 23, 59, 59, 999999)  # stands in for a null time, which counts as newest


def dated(df: DataFrame, at: str, day: str = DAY) -> DataFrame:
    """With the calendar day of ``at``. A stored history has it already, as its partition column, and
    filters on it prune the scan."""
    return df if day in df.columns else df.withColumn(day, day_of(at))


def _rows_at_newest_time(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Rows at the greatest time of their key. The join is on key and time, so a hot key's rows spread over the tasks."""
    names = [F.col(k).alias(f"_{k}") for k in keys]
    same_key = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    if DAY in df.columns:
        # The day takes part in the join, so only partitions that hold a newest row are read again
        # (dynamic partition pruning, which Spark plans for a filtered side).
        known = F.col("_newest") <= moment(FAR_FUTURE).cast(df.schema[at].dataType)
        newest = df.groupBy(*names).agg(F.max(at).alias("_newest")).where(known).withColumn("_day", day_of("_newest"))
        matches = [*same_key, F.col(at) == F.col("_newest"), F.col(DAY) == F.col("_day")]
        undated = df.where(F.col(DAY).isNull())
        return df.join(newest, matches, "left_semi").unionByName(undated)
    known = F.coalesce(F.col(at), moment(FAR_FUTURE).cast(df.schema[at].dataType))
    newest = df.groupBy(*names).agg(F.max(known).alias("_newest"))
    return df.join(newest, [*same_key, known == F.col("_newest")], "left_semi")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], at: str, ties: Sequence[str] = (), few_keys: bool = False
) -> DataFrame:
    """The row with the greatest ``at`` for each key; a null ``at`` counts as newest.

    Equal ``at`` values are decided by the greatest ``ties``. The rank limit is also applied on the
    map side (WindowGroupLimit), so every task sends at most one row per key and a hot key costs no
    more than a cold one. Columns that are not used later are pruned from the scan.

    ``few_keys`` chooses the form for keys that are far fewer than rows, with the same result: the newest
    times are aggregated first, from two columns, and only the rows at those times are ranked. Where
    AQE can send the newest times to every executor, the history is neither sorted nor shuffled.
    """
    if few_keys:
        df = _rows_at_newest_time(df, keys, at)
    order = [F.col(at).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in ties]]
    return top_per_group(df, keys, order, 1)


def latest_whole_rows(df: DataFrame, keys: Sequence[str], at: str, ties: Sequence[str] = ()) -> DataFrame:
    """Same rows as ``latest_per_key``, for a result that several branches of one query read.

    The newest row is aggregated as one value (also map-side), so no branch prunes columns from it:
    all branches have the same shuffle, and Spark scans and shuffles the history once for all.
    """
    payload = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(at).isNull(), F.col(at), *ties)
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*payload), order).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def latest_per_key_day(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    ties: Sequence[str] = (),
    day: str = DAY,
    whole_rows: bool = False,
) -> DataFrame:
    """The newest row for each key and calendar day of ``at``, with the day as a column.

    ``whole_rows`` chooses the form that several branches can share.
    """
    newest = latest_whole_rows if whole_rows else latest_per_key
    return newest(dated(df, at, day), [*keys, day], at, ties)


def latest_batch(df: DataFrame, at: str, day: str | None = None) -> DataFrame:
    """Rows stamped with the greatest ``at``; null stamps never match.

    ``day`` names the partition column of a history, if it has one: the scan is then pruned to the
    newest partition before the stamps are read.
    """
    if day is not None:
        df = df.where(F.col(day) == df.select(F.max(day)).scalar())
    return df.where(F.col(at) == df.select(F.max(at)).scalar())
