"""Aggregations used by checks and panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import day_of, percent_of


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_as: str = "row_count") -> DataFrame:
    """Key groups that hold more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_as)).where(F.col(count_as) > 1)


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return duplicate_keys(df.where(F.col(column).isNotNull()), [column])


def null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def missing_percent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null share of every column in one pass, as (column_name, missing_percent) rows.

    The share has two decimals and is null for an empty input.
    """
    row = df.agg(F.count("*").alias("_rows"), *[null_count(c).alias(f"_null_{c}") for c in columns])
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                percent_of(F.col(f"_null_{c}"), F.col("_rows"), 2).alias("missing_percent"),
            )
            for c in columns
        ]
    )
    return row.select(F.inline(pairs))


def counts_per_day(parts: Sequence[tuple[str, DataFrame, str]], day: str = "day") -> DataFrame:
    """Rows per day and table as one column per table; a day without rows is null, not zero.

    Each table is counted on its own (map-side) before the small counts meet in the pivot.
    """
    counted = [
        df.groupBy(day_of(at).alias(day)).agg(F.count("*").alias("n")).withColumn("metric", F.lit(name))
        for name, df, at in parts
    ]
    stacked = counted[0]
    for df in counted[1:]:
        stacked = stacked.unionByName(df)
    return stacked.groupBy(day).pivot("metric", [name for name, _, _ in parts]).agg(F.sum("n"))


def success_rate(df: DataFrame, key: str, success: Column) -> DataFrame:
    """Rows per key and the percentage of them that succeeded, one decimal."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("total_runs"), F.count_if(success).alias("_good"))
        .select(key, "total_runs", percent_of(F.col("_good"), F.col("total_runs"), 1).alias("success_rate_pct"))
    )


def joined_names(df: DataFrame, key: str, name: str, separator: str = ", ") -> DataFrame:
    """Sorted distinct names of each key as one text. Names come from a bounded list (check names),
    and are made distinct before the shuffle that collects them."""
    names = df.select(key, name).distinct()
    return names.groupBy(key).agg(
        F.count("*").alias("n_names"),
        F.concat_ws(separator, F.sort_array(F.collect_list(name))).alias("names"),
    )


def delimited_chunks(df: DataFrame, key: str, size: int = 500) -> DataFrame:
    """Distinct integer keys as comma-joined texts, one per key range of ``size``, so that no group
    holds more than ``size`` keys."""
    keys = df.select(key).distinct().withColumn("chunk", F.expr(f"`{key}` div {int(size)}"))
    return keys.groupBy("chunk").agg(
        F.count("*").alias("n_keys"),
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list(key)), lambda k: k.cast("string"))).alias("keys"),
    )
