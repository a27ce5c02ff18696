"""What several operators of this subpackage share: written intermediate tables, folds, label samples."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import snapmart
from snapmart.session import shared_dir

#: A document is predicted to have a label from this score on.
CUT = 0.3


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as --py-files would; Spark hands the file out itself."""
    context = spark.sparkContext
    if getattr(context, "_snapmart_shipped", False):
        return
    root = Path(snapmart.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="snapmart-py-"), "snapmart_package.zip")  # read by the driver's file server only
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(path))
    context._snapmart_shipped = True


def map_arrow(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """`mapInArrow` with functions of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here, and lost executors cost no earlier work."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def finished_shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of each job as it ends, not when the driver next collects its garbage.

    For steps that write what they hand on; a plan that runs again, or a lost executor, makes its shuffles anew.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Words of 64 bits in a filter of ids.
FILTER_WORDS = 1 << 18


def _filtered(df: DataFrame, key: Column, ids: DataFrame) -> DataFrame:
    """`df` with `__maybe`: true for all rows whose key is in the first column of `ids`, and for few others.

    An id sets two bits of one word. The words are broadcast, so no row of `df` is moved; with more ids there are not
    more words, but more rows that pass.
    """

    def place(column: Column) -> tuple[Column, Column]:
        code = F.xxhash64(column)
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(code, F.lit(m)).cast("int")) for m in (61, 64)]
        return F.pmod(F.shiftrightunsigned(code, 24), F.lit(FILTER_WORDS)), bits[0].bitwiseOR(bits[1])

    word, bits = place(ids[ids.columns[0]])
    words = ids.select(word.alias("__word"), bits.alias("__bits")).groupBy("__word").agg(F.bit_or("__bits").alias("__bits"))
    word, bits = place(key)
    hit = F.coalesce(F.col("__bits").bitwiseAND(bits) == bits, F.lit(False))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.join(F.broadcast(words), word == F.col("__word"), "left").select(*columns, hit.alias("__maybe"))


def rows_with(df: DataFrame, key: Column, ids: DataFrame) -> DataFrame:
    """The rows of `df` whose key, null or not, is in the only column of `ids`; few others are moved to find them."""
    wanted = ids.toDF("__id")
    maybe = _filtered(df, key, wanted).where("__maybe").drop("__maybe")
    return maybe.join(wanted, key.eqNullSafe(F.col("__id")), "left_semi")


def rows_without(df: DataFrame, key: Column, ids: DataFrame) -> DataFrame:
    """The rows of `df` whose key is null or not in the only column of `ids`; few of them are moved to tell."""
    gone = ids.toDF("__id")
    asked = _filtered(df, key, gone)
    kept = asked.where("__maybe").drop("__maybe").join(gone, key == F.col("__id"), "left_anti")
    return asked.where(~F.col("__maybe")).drop("__maybe").unionByName(kept)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null ids fall in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


#: Characters of a piece of a long text that is learned from.
PIECE = 2000


def spread_pieces(text: Column, key: Column, longest: int) -> Column:
    """A text of up to `longest` characters whole; of a longer one pieces of PIECE characters, `longest` in all.

    The pieces are those with the least crc32 of `key` and their number, so they spread over the whole text. They come
    in the text's order, each on a line of its own; words at their ends are cut.
    """
    size = min(PIECE, longest)
    numbers = F.sequence(F.lit(0), F.floor((F.length(text) - 1) / size).cast("int"))
    own = key.cast("string")
    hashed = F.transform(
        numbers,
        lambda k: F.struct(F.crc32(F.concat_ws(":", own, k.cast("string")).cast("binary")).alias("h"), k.alias("k")),
    )
    chosen = F.array_sort(F.transform(F.slice(F.array_sort(hashed), 1, longest // size), lambda x: x["k"]))
    pieces = F.transform(chosen, lambda k: text.substr(k * size + 1, F.lit(size)))
    return F.when(F.length(text) <= longest, text).otherwise(F.array_join(pieces, "\n"))


def label_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, longest: int | None = None
) -> DataFrame:
    """At most `per_class` labelled documents of each class, as (text, y); of texts over `longest`, if given, pieces.

    Of the documents that have a text those with the smallest hashes of their text's row key are taken, so the choice
    depends on the rows alone. Null labels, null ids, texts without a label, and null and empty texts take no part; of
    rows that repeat an id one text is taken.
    """
    usable = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0))
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("y")
    )
    known = written(known.join(usable.select("doc_id").distinct(), "doc_id", "left_semi"), "labelled")
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id", "y"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    found = usable.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    if longest is not None:
        found = found.withColumn("text", spread_pieces(F.col("text"), F.col("doc_id"), longest))
    return found.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", "y")
