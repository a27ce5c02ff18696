"""Incremental ingest of landed files into the snapshot history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import moment
from snapmart.operators.compare import fingerprint
from snapmart.operators.history import SOURCE_SCHEMA, STAMP, add_rows, commit_part, taken_sources

Commit = Callable[[DataFrame, int], None]


def ingest_available(stream: DataFrame, commit: Commit, checkpoint: str) -> None:
    """Run ``commit`` on everything that has landed since the last call, then stop.

    The checkpoint remembers the files taken; the commits below keep what other batches brought and are
    the same when repeated, so a batch that is retried after a failure gives the same history. A commit that knows its
    sources by itself (``by_source``) gets each row's file.
    """
    if getattr(commit, "by_source", False):
        stream = with_source(stream)
    query = (
        stream.writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


SOURCE = "__source"  # identity of the file that brought a row


def with_source(files: DataFrame) -> DataFrame:
    """Rows of a file source with the identity of their file: its path, length and time of change."""
    identity = F.struct(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_size").alias("length"),
        F.unix_micros("_metadata.file_modification_time").alias("modified"),
    )
    return files.withColumn(SOURCE, identity)


def commit_days(path: str, at: str = STAMP) -> Commit:
    """Commit rows that carry their own time to the days they belong to, each source once.

    The history keeps a ledger of the sources whose rows it holds: files by path, length and time of change (see
    ``with_source``), or else the micro-batch by its number, count and hash sum. Rows of a source in the ledger are
    dropped, so a batch that is retried, a lost checkpoint or a second stream over the same files adds nothing, whatever
    the numbers of the micro-batches. Rows and ledger become visible in one step. A day may arrive in any number of
    batches; what is there is neither read nor written again. Rows without a time are a day of their own.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            if SOURCE not in batch.columns:
                whole = fingerprint(batch).first()
                identity = (f"batch {batch_id} {whole['digest']}", whole["n"], 0)
                sources = spark.createDataFrame([identity], SOURCE_SCHEMA)
            else:
                sources = batch.select(f"{SOURCE}.*").distinct()
            known = taken_sources(spark, path)
            again = sources.join(known, sources.columns, "left_semi")
            fresh = sources.join(known, sources.columns, "left_anti")
            rows = batch
            if not again.isEmpty():
                if SOURCE not in batch.columns:
                    return
                of = again.select(F.struct(*again.columns).alias(SOURCE))
                rows = batch.join(of, SOURCE, "left_anti")
            if not rows.isEmpty():
                add_rows(rows.drop(SOURCE), path, at, fresh)
        finally:
            batch.unpersist()

    commit.by_source = True
    return commit


def commit_runs(
    path: str, keys: list[str], run: str = "run_ts", prepare: Callable[[DataFrame], DataFrame] | None = None
) -> Commit:
    """Commit landed runs, oldest first. ``run`` holds the run time of each row; a micro-batch may hold
    several runs (their number is bounded by the landed folders, and only their times reach the
    driver), and a run may come in several. Unchanged runs are skipped, changed ones replace their
    day; a late run never replaces a later one of its day."""

    def commit(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for row in batch.select(run).distinct().orderBy(run).collect():
                rows = batch.where(F.col(run) == moment(row[run])).drop(run)
                commit_part(prepare(rows) if prepare else rows, path, row[run], keys)
        finally:
            batch.unpersist()

    return commit
