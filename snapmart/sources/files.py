"""CSV files with header, quoted multi-line text included. An empty value is null."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_OPTIONS = {
    "header": True,
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,  # the writer trims by default
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Replace ``path`` by CSV files with header. A file with quoted line breaks is read by one task,
    so the size of a file is bounded."""
    df.write.mode("overwrite").options(**_OPTIONS).option("maxRecordsPerFile", rows_per_file).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Typed read; a value that does not parse fails the query."""
    return spark.read.options(**_OPTIONS).option("mode", "FAILFAST").schema(schema).csv(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column of the header as text, for a load that casts by name."""
    return spark.read.options(**_OPTIONS).csv(path)


_LINES = "file string, block bigint, quotes bigint, line bigint, even bigint, odd bigint"


def read_csv_split(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The rows of ``read_csv`` (or, without a schema, of ``read_csv_text``) with large files read by several tasks.

    A line of a file begins a record if an even number of quotes stands before it in the file. So a first pass counts
    the quotes of each byte range that Spark cuts from a file, and notes its last record's first line for either parity;
    their running sums say, for every range, whether it begins inside quotes, and in which record. In a second pass each
    task cuts its range into records. Those that cross ranges, at most two a range, are put together by
    their first line's place. Lines end by ``\\n`` or ``\\r\\n``. What is summed and sent to all tasks is one row of about 80
    bytes for each range, that is 60 MB for 100 TB in ranges of 128 MB; lines stay in the tasks that read them, in order.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    ranged = lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for value, file, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                now = found.setdefault((file, block), [0, 0, -1, -1])  # quotes, lines, last first line if even, if odd
                now[2 + now[0] % 2] = now[1]
                now[0] += value.count('"')
                now[1] += 1
        rows = [(file, block, *now) for (file, block), now in found.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.string(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "quotes", "line", "even", "odd"]
        )

    # One row for each range; a file's ranges are few beside its lines.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.mapInArrow(measure, _LINES)
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    last = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))
    first = F.when(last >= 0, F.struct(F.col("block").alias("b"), last.alias("l")))
    ranges = ranges.withColumn("open", F.last(first, ignorenulls=True).over(before)).select("file", "block", "inside", "open")
    begun = ranged.join(F.broadcast(ranges), ["file", "block"]).select("value", "file", "block", "inside", "open.b", "open.l")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record", "whole", "file", "first_block", "first_line", "block"]
        at, line, quotes, held, place, fresh = None, 0, 0, [], None, False
        out: list[tuple] = []

        def close(whole: bool) -> None:
            if held:
                out.append(("\n".join(held), whole, at[0], *place, at[1]))
                held.clear()

        for batch in batches:
            for value, file, block, inside, b, l in zip(*(c.to_pylist() for c in batch.columns), strict=True):  # noqa: E741
                if (file, block) != at:
                    close(False)  # its end may be in the next range
                    at, line, quotes, place, fresh = (file, block), 0, inside, (b, l), False
                if quotes % 2 == 0:
                    close(fresh)
                    place, fresh = (block, line), True
                held.append(value)
                quotes, line = quotes + value.count('"'), line + 1
            kinds = [pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            out = []
        close(False)
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    pieces = begun.mapInArrow(cut, "record string, whole boolean, file string, first_block bigint, first_line bigint, block bigint")
    key = ["file", "first_block", "first_line"]
    parts = pieces.where("not whole").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"))
    joined = parts.select(F.array_join("parts.record", "\n").alias("record"), *key)
    records = pieces.where("whole").select("record", *key).unionByName(joined)
    records = records.where("first_block <> 0 or first_line <> 0")  # the header of each file
    record = F.regexp_replace("record", "\r$", "")
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _OPTIONS.items() if k not in ("header", "multiLine")}
    if schema is None:
        header = read_csv_text(spark, path).columns
        schema = StructType([StructField(name, StringType()) for name in header])
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    fields = F.from_csv(record, _ddl(schema), {**options, "mode": "FAILFAST"})
    return records.where(F.length(record) > 0).select(fields.alias("row")).select("row.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
