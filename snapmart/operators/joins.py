"""Equi-joins of the warehouse. Broadcasts are left to the size check of Catalyst and AQE
(``autoBroadcastJoinThreshold``); larger sides are shuffled, and AQE splits skewed partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import day_of
from snapmart.operators.latest import latest_per_key


def enrich(df: DataFrame, attributes: DataFrame, key: str) -> DataFrame:
    """Left join of 1:1 attributes; rows without attributes stay."""
    return df.join(attributes, on=[key], how="left")


def scoped(df: DataFrame, universe: DataFrame, key: str) -> DataFrame:
    """Rows whose key belongs to the universe, each once however often the universe repeats a key."""
    return df.join(universe.select(key), on=[key], how="left_semi")


def scoped_latest(
    df: DataFrame, universe: DataFrame, key: str, keys: Sequence[str], at: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Newest row per ``keys`` (``key`` is one of them) within the universe.

    The scope depends on the key alone, so it comes first: it is a filter on the map side wherever AQE
    finds the universe small enough to send, and a join whose skewed partitions it splits elsewhere.
    The rows are the same either way.
    """
    return latest_per_key(scoped(df, universe, key), keys, at, ties, few_keys=list(keys) == [key])


def join_same_day(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str) -> DataFrame:
    """Left join on the key and the calendar day of two timestamps, as a two-column equi-join."""
    dated = right.withColumn("_day", day_of(right_at))
    return left.withColumn("_day", day_of(left_at)).join(dated, on=[key, "_day"], how="left").drop("_day")


def rows_at_group_max(df: DataFrame, key: str, at: str) -> DataFrame:
    """All rows whose time equals the greatest time of their key; ties are kept.

    The maxima are one row per key after a map-side aggregate, and the join is on key and time, so
    the rows of a hot key spread over the tasks.
    """
    newest = df.groupBy(key).agg(F.max(at).alias(at))
    return df.join(newest, on=[key, at], how="inner").select(*df.columns)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys without a parent, with the number of child rows of each.

    Child rows are counted per key before the join, so a hot key reaches it as one row.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count("*").alias("child_rows"))
    parents = parent.select(F.col(parent_key).alias(child_key))
    return keys.join(parents, on=[child_key], how="left_anti")


def union_labelled(parts: Sequence[tuple[str, DataFrame]], label: str = "table_name") -> DataFrame:
    """UNION ALL of results by column name, each marked with its label."""
    marked = [df.select(F.lit(name).alias(label), "*") for name, df in parts]
    out = marked[0]
    for df in marked[1:]:
        out = out.unionByName(df)
    return out
