"""Landed JSON payloads: ``{"data": [...]}`` and ``{"data": {"<id>": {...}}}`` envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapmart.schemas import USD_FIELDS, USD_QUOTE_ID, USD_SYMBOL
from snapmart.session import shared_dir


def _data_or_error() -> Column:
    message = F.concat(F.lit("no 'data' key in "), F.col("_metadata.file_path"))
    return F.coalesce(F.col("data"), F.raise_error(message))


def _read(spark: SparkSession, paths: str | Sequence[str], data_type: str, whole_file: bool) -> DataFrame:
    return spark.read.schema(f"place bigint, data {data_type}").option("multiLine", whole_file).json(paths)


def read_envelope(
    spark: SparkSession, paths: str | Sequence[str], record: StructType, whole_file: bool = True
) -> DataFrame:
    """Records of the ``data`` array, with their place in the payload as ``_pos``: the position in the array, counted from
    the envelope's ``place`` if it has one (see ``placed``).

    A payload without ``data`` fails the query with its path. With ``whole_file`` a document may span
    lines (an API response, bounded by its request limit); otherwise each line is one envelope and
    files are split over tasks.
    """
    raw = _read(spark, paths, f"array<{record.simpleString()}>", whole_file)
    records = raw.select("place", F.posexplode(_data_or_error()).alias("_at", "_record"))
    return records.select((F.coalesce("place", F.lit(0).cast("bigint")) + F.col("_at")).alias("_pos"), "_record.*")


def placed(records: DataFrame, name: str = "place") -> DataFrame:
    """Records with their number in source order, from 0, over all files and tasks.

    The rows are written with their numbers within the task that read them, so that both passes see the same tasks.
    The running sums of the tasks' row counts, one row a task, are the places at which their numbers begin. No row is
    sorted or moved.
    """
    spark, copy = records.sparkSession, shared_dir(records.sparkSession, "placed")
    numbered = records.withColumn("_id", F.monotonically_increasing_id())
    numbered.write.parquet(copy)
    numbered = spark.read.schema(numbered.schema).parquet(copy)
    task, own = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = numbered.groupBy(task.alias("_task")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    joined = numbered.withColumn("_task", task).join(F.broadcast(starts), "_task")
    return joined.select(*[F.col(f"`{c}`") for c in records.columns], (F.col("_start") + own).alias(name))


def read_keyed_envelope(
    spark: SparkSession,
    paths: str | Sequence[str],
    record: StructType,
    whole_file: bool = True,
    required: bool = True,
) -> DataFrame:
    """Records of a ``data`` map, without their keys; a payload without ``data`` fails if it is required."""
    raw = _read(spark, paths, f"map<string,{record.simpleString()}>", whole_file)
    data = _data_or_error() if required else F.col("data")
    return raw.select(F.explode(F.map_values(data)).alias("_record")).select("_record.*")


def read_entity_payloads(
    spark: SparkSession, paths: Sequence[str], record: StructType, whole_file: bool = True
) -> DataFrame:
    """One data set from per-entity payloads ``{"data": {...}}``; payloads without data are skipped."""
    raw = _read(spark, list(paths), record.simpleString(), whole_file)
    found = raw.where(F.col("data").isNotNull()).select("data.*")
    if found.isEmpty():
        raise RuntimeError("no entity payload holds data")
    return found


def first_source_keys(candidates: Sequence[DataFrame | None], key: str = "id") -> DataFrame:
    """Keys of the first candidate that exists and is not empty, in the given order."""
    for df in candidates:
        if df is not None and not df.isEmpty():
            return df.select(key)
    raise RuntimeError("no source holds keys; land one of them first")


def read_if_landed(
    spark: SparkSession, path: str, record: StructType, keyed: bool = False, whole_file: bool = True
) -> DataFrame | None:
    """The records of a payload, or None when nothing was landed there."""
    try:
        return (read_keyed_envelope if keyed else read_envelope)(spark, path, record, whole_file)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def merge_keyed(batches: Sequence[DataFrame], key: str) -> DataFrame:
    """One row per key; a later batch overwrites an earlier one (columns of all batches are equal)."""
    numbered = [df.withColumn("_batch", F.lit(i)) for i, df in enumerate(batches)]
    stacked = numbered[0]
    for df in numbered[1:]:
        stacked = stacked.unionByName(df)
    payload = [c for c in batches[0].columns if c != key]
    merged = stacked.groupBy(key).agg(F.max_by(F.struct(*payload), "_batch").alias("_row"))
    return merged.select(key, *[f"_row.{c}" for c in payload])


def derive_quotes(listings: DataFrame, limit: int | None = None) -> DataFrame:
    """Quote records from listing records with a non-empty USD quote; with a ``limit``, from the first so many records of
    the payload in source order (of each, if several documents are read), before quotes are looked at.
    ``minted_market_cap`` comes from the record, the rest from the quote."""
    if limit is not None:
        listings = listings.where(F.col("_pos") < limit)
    usd = F.col("quote.USD")
    fields = [usd[name].alias(name) for name in USD_FIELDS]
    item = F.struct(
        F.lit(USD_QUOTE_ID).cast("bigint").alias("id"),
        F.lit(USD_SYMBOL).alias("symbol"),
        F.col("minted_market_cap"),
        *fields,
    )
    quoted = listings.where(F.coalesce(F.size(usd), F.lit(0)) > 0)
    return quoted.select(
        "id", "name", "symbol", "slug", F.lit(0).cast("smallint").alias("is_fiat"), F.array(item).alias("quote")
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(message)
    return df


def land_records(df: DataFrame, path: str) -> bool:
    """Land records as JSON Lines, one record per line (splittable); an empty set is not written."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").json(path)
    return True

