"""Query registry: name -> Spark query and, where SQL can say it, the SQL with the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given Parquet tables by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]


def _portable(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, T.DateType):
        column = column.cast("string")
    elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        text = column.cast("string")  # no formatting function: those go through the session's time zone
        fraction = F.rpad(F.substring(text, 21, 6), 6, "0")
        column = F.concat(F.substring(text, 1, 19), F.lit("."), fraction)
    elif isinstance(kind, (T.DecimalType, T.FloatType)):
        column = column.cast("double")
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        column = column.cast("bigint")
    return column.alias(field.name)


def portable(df: DataFrame) -> DataFrame:
    """Result types that compare the same way in every engine: text dates and times, bigint, double."""
    return df.select(*[_portable(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register ``function(tables) -> DataFrame`` under ``name``."""

    def add(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: portable(function(Tables(spark, folder)))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def ts_sql(expression: str) -> str:
    """SQL text of a timestamp as the registry shows it."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
