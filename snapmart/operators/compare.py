"""Multiset comparison of relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows whose number of copies differs, with ``surplus`` = copies left - copies right.

    One shuffle with map-side sums: copies are added up before they travel, and nulls are equal.
    """
    columns = left.columns
    signed = left.withColumn("surplus", F.lit(1)).unionByName(
        right.select(*columns).withColumn("surplus", F.lit(-1))
    )
    return signed.groupBy(*columns).agg(F.sum("surplus").alias("surplus")).where(F.col("surplus") != 0)


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row, ``same``: whether both relations hold the same rows in any order."""
    if set(left.columns) != set(right.columns):
        return left.sparkSession.range(1).select(F.lit(False).alias("same"))
    return row_difference(left, right).agg((F.count("*") == 0).alias("same"))


def fingerprint_columns(df: DataFrame) -> list[Column]:
    """Row count ``n`` and order-free hash sum ``digest``, as aggregates."""
    digest = F.xxhash64(*sorted(df.columns)).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("n"), F.sum(digest).alias("digest")]


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and order-free hash sum: unequal fingerprints prove unequal relations."""
    return df.agg(*fingerprint_columns(df))


def same_fingerprint(left: DataFrame, right: DataFrame) -> bool:
    """Whether the fingerprints agree; both are computed in one job."""
    return fingerprint(left).union(fingerprint(right)).distinct().count() == 1
