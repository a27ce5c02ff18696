"""Nested records to flat columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _quoted(path: Sequence[str]) -> str:
    return ".".join(f"`{part}`" for part in path)


def _leaves(schema: StructType, path: tuple[str, ...], sep: str) -> list[Column]:
    out: list[Column] = []
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, StructType):
            out.extend(_leaves(field.dataType, here, sep))
        else:
            out.append(F.col(_quoted(here)).alias(sep.join(here)))
    return out


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every struct leaf as a column named by its path; lists and maps are left as they are."""
    return df.select(*_leaves(df.schema, (), sep))


def explode_list(df: DataFrame, column: str) -> DataFrame:
    """One row per list element; an empty or null list gives one row with null. Absent column: no-op."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.explode_outer(column))


def explode_flatten(df: DataFrame, column: str) -> DataFrame:
    """Explode a list of records; its fields get the list's name as prefix."""
    return flatten(explode_list(df, column))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*names)
