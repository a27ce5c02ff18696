"""Append-only snapshot history: one Parquet partition per calendar day of the run stamp, in versions."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapmart.functions import day_of, moment
from snapmart.operators.compare import fingerprint, fingerprint_columns, same_fingerprint, same_rows
from snapmart.operators.latest import DAY
from snapmart.operators.versions import (
    LEDGER,
    State,
    folders,
    new_name,
    read_state,
    remove_version,
    write_state,
    write_version,
)

STAMP = "inserted_at"


def stamp(batch: DataFrame, run_ts: datetime) -> DataFrame:
    """Mark the whole batch with one run time, to the second."""
    return batch.withColumn(STAMP, moment(run_ts.replace(microsecond=0)))


def backfill_stamp(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Stamp a relation that predates stamping; a stamped one is returned as it is."""
    return df if STAMP in df.columns else stamp(df, run_ts)


def append_by_name(history: DataFrame, batch: DataFrame) -> DataFrame:
    """UNION ALL aligned by column name; a column missing on one side is null there."""
    return history.unionByName(batch, allowMissingColumns=True)


def replace_same_day(history: DataFrame, batch: DataFrame, run_ts: datetime, at: str = STAMP) -> DataFrame:
    """History without the run's calendar day, plus the batch. (``replace_days`` is the written form.)"""
    day = F.lit(run_ts.date())
    kept = history.where(day_of(at).isNull() | (day_of(at) != day))
    return append_by_name(kept, batch)


def read_history(
    spark: SparkSession, path: str, schema: StructType | None = None, merge: bool = False
) -> DataFrame | None:
    """The stored history, or None before the first commit.

    Give the ``schema`` where it is known. ``merge`` reads the columns of every file instead, for a
    history whose columns have changed; without it they are taken from one file.
    """
    return _read_days(spark, path, stored_state(spark, path).days, schema, merge)


def stored_state(spark: SparkSession, path: str) -> State:
    return read_state(spark, path, DAY)


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """The days of a stored history, oldest first, from its state; no file of rows is opened."""
    return stored_state(spark, path).dates()


def _read_days(spark: SparkSession, path: str, days: dict[str, list[str]], schema=None, merge: bool = False) -> DataFrame | None:
    """The rows of some days' versions with their day; None if there are none."""
    found = None
    for part, base in zip(folders(path, DAY, days), (path, path), strict=True):
        if part:
            reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", merge)
            rows = reader.option("basePath", base).parquet(*part).drop("version")
            rows = rows.withColumn(DAY, F.col(DAY).cast("date"))
            found = rows if found is None else append_by_name(found, rows)
    return found


def stored_day(spark: SparkSession, path: str, day: date, state: State | None = None) -> DataFrame:
    state = state or stored_state(spark, path)
    return _read_days(spark, path, {day.isoformat(): state.days[day.isoformat()]}).drop(DAY)


def _newest_run(spark: SparkSession, path: str, state: State, before: datetime | None) -> tuple[date, datetime] | None:
    """Day and time of the newest run (before a time), from the state; the rows of a day are read only if its runs
    aren't known there."""
    for day in reversed(state.dates()):
        if before is not None and day > before.date():
            continue
        known = [datetime.fromisoformat(run) for run in state.runs if run.startswith(day.isoformat())]
        if not known:
            known = [r[0] for r in stored_day(spark, path, day, state).select(STAMP).distinct().collect() if r[0] is not None]
        earlier = [run for run in known if before is None or run < before]
        if earlier:
            return day, max(earlier)
    return None


def newest_batch(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the newest run with stamp and day: ``latest_batch`` of a stored history, without looking for it."""
    state = stored_state(spark, path)
    newest = _newest_run(spark, path, state, None)
    if newest is None:
        return None
    rows = _read_days(spark, path, {newest[0].isoformat(): state.days[newest[0].isoformat()]})
    return rows.where(F.col(STAMP) == moment(newest[1]))


def newest_snapshot(
    spark: SparkSession, path: str, before: datetime | None = None, state: State | None = None
) -> DataFrame | None:
    """The rows of the newest run (before a time) with the columns that run had; only its day is read."""
    state = state or stored_state(spark, path)
    newest = _newest_run(spark, path, state, before)
    if newest is None:
        return None
    day, run = newest
    return stored_day(spark, path, day, state).where(F.col(STAMP) == moment(run)).drop(STAMP)


def _replaced(state: State, days: list[str], version: str) -> None:
    """The days are that version only; what was known of their runs no longer holds."""
    for day in days:
        state.days[day] = [version]
        state.runs = {run: facts for run, facts in state.runs.items() if not run.startswith(day)}


def replace_days(stamped: DataFrame, path: str, at: str = STAMP) -> None:
    """Make the rows the only content of the days they hold; other days stay untouched.

    All days change at once, and only when all rows are written: a reader that is open keeps the old days, and a
    failure leaves them. Rows without a time are a day of their own. The rows may come from the history itself.
    """
    spark = stamped.sparkSession
    state = stored_state(spark, path)
    name = new_name(state)
    _replaced(state, write_version(stamped.withColumn(DAY, day_of(at)), path, name, DAY), name)
    write_state(spark, path, state)


def add_rows(rows: DataFrame, path: str, at: str = STAMP, sources: DataFrame | None = None) -> None:
    """Add rows to the days they belong to, without reading or writing what is there.

    ``sources`` (see ``taken_sources``) become known in the same step.
    """
    spark = rows.sparkSession
    state = stored_state(spark, path)
    name = new_name(state)
    for day in write_version(rows.withColumn(DAY, day_of(at)), path, name, DAY):
        state.days.setdefault(day, []).append(name)
        state.runs = {run: facts for run, facts in state.runs.items() if not run.startswith(day)}
    if sources is not None:
        if len(state.ledger) >= LEDGER_PARTS:  # few large parts instead of many small ones
            sources, state.ledger = sources.unionByName(_ledger(spark, path, state)), []
        sources.write.parquet(f"{path}/{LEDGER}/{name}")
        state.ledger.append(name)
    write_state(spark, path, state)


#: So many parts of the ledger are written before they are merged into one.
LEDGER_PARTS = 50

SOURCE_SCHEMA = "source string, length bigint, modified bigint"


def _ledger(spark: SparkSession, path: str, state: State) -> DataFrame:
    if not state.ledger:
        return spark.createDataFrame([], SOURCE_SCHEMA)
    return spark.read.schema(SOURCE_SCHEMA).parquet(*[f"{path}/{LEDGER}/{name}" for name in state.ledger])


def taken_sources(spark: SparkSession, path: str) -> DataFrame:
    """The sources (name, length, time of change) whose rows the history holds."""
    return _ledger(spark, path, stored_state(spark, path))


def unchanged(batch: DataFrame, last: DataFrame | None, keys: list[str]) -> bool:
    """Whether the batch equals the newest snapshot: same columns, same rows, any order.

    False without a snapshot, without declared keys or without their columns. A count and hash sum
    decide most unequal pairs; only equal ones are compared row by row.
    """
    if last is None or not keys or not set(keys) <= set(last.columns) or set(last.columns) != set(batch.columns):
        return False
    return same_fingerprint(batch, last) and same_rows(batch, last).first()["same"]


def _facts(batch: DataFrame) -> dict:
    """Columns, count and order-free hash sum of a run's rows, as the state keeps them."""
    return _named_facts(batch, fingerprint(batch).first().asDict())


def _named_facts(batch: DataFrame, found: dict) -> dict:
    columns = {f.name: f.dataType.simpleString() for f in sorted(batch.schema.fields, key=lambda f: f.name)}
    return {"columns": columns, "rows": found["n"], "digest": str(found["digest"])}


def _repeats_newest(batch: DataFrame, facts: dict, path: str, at: datetime, keys: list[str], state: State) -> bool:
    """Whether a run equals the newest one before it. One whose kept facts differ is unequal without being read."""
    spark = batch.sparkSession
    newest = _newest_run(spark, path, state, at)
    if newest is None:
        return False
    last = state.runs.get(newest[1].isoformat(), {})
    if last.get("columns") == facts["columns"] and (last["rows"], last["digest"]) != (facts["rows"], facts["digest"]):
        return False
    return unchanged(batch, newest_snapshot(spark, path, at, state), keys)


def _write_run(batch: DataFrame, path: str, at: datetime, name: str) -> tuple[dict, bool]:
    """Write a run as a version that no state names yet. Its facts, taken while it is written, and whether it has rows.

    A run is of one day, so no row is moved: each task writes what it has read.
    """
    seen = Observation()
    rows = stamp(batch.observe(seen, *fingerprint_columns(batch)), at).withColumn(DAY, day_of(STAMP))
    days = write_version(rows, path, name, DAY, rebalance=False)
    return _named_facts(batch, seen.get), bool(days)


def _commit_run(
    spark: SparkSession, facts: dict, path: str, at: datetime, state: State, name: str, any_rows: bool
) -> None:
    """The written run becomes its day's only content; what it replaced is remembered, in case its last part takes it
    back."""
    day, run = at.date().isoformat(), at.isoformat()
    first = state.runs.get(run, {})
    facts["over"] = first.get("over", state.days.get(day, []))
    facts["over_runs"] = first.get("over_runs", {k: v for k, v in state.runs.items() if k.startswith(day) and k != run})
    _replaced(state, [day], name)
    if not any_rows:
        state.days[day] = []  # a run without rows leaves its day empty
    state.days = {k: v for k, v in state.days.items() if v}
    state.runs[run] = facts
    write_state(spark, path, state)


def _is_later(spark: SparkSession, path: str, at: datetime, state: State) -> bool:
    """Whether the run's day holds a later run."""
    if at.date() not in state.dates():
        return False
    newest = _newest_run(spark, path, state, datetime.combine(at.date(), datetime.max.time()))
    return newest is not None and newest[0] == at.date() and newest[1] > at


def commit_snapshot(batch: DataFrame, path: str, run_ts: datetime, keys: list[str]) -> bool:
    """Add one run to the history; returns False when it repeats the newest snapshot.

    A run is compared with the newest one before its own time, so a retried or late run is judged as it
    was, or would have been, in its turn. An unchanged batch is skipped before the same-day rule is
    applied; a changed one replaces the run's calendar day, unless that already holds a later run.
    """
    return load_snapshot(batch, path, run_ts, keys)[0]


def load_snapshot(batch: DataFrame, path: str, run_ts: datetime, keys: list[str]) -> tuple[bool, int]:
    """``commit_snapshot``, and the batch's number of rows.

    The batch is computed once: its rows are written as a version while they are counted, and what was written is what
    is compared. A version that repeats the newest run is removed before any state names it.
    """
    spark, at = batch.sparkSession, run_ts.replace(microsecond=0)
    state = stored_state(spark, path)
    if _is_later(spark, path, at, state):
        return False, _facts(batch)["rows"]
    name = new_name(state)
    facts, any_rows = _write_run(batch, path, at, name)
    written = batch.limit(0)
    if any_rows:
        day = folders(path, DAY, {at.date().isoformat(): [name]})[0]
        written = spark.read.schema(batch.schema).parquet(*day)
    if _repeats_newest(written, facts, path, at, keys, state):
        remove_version(spark, path, name)
        return False, facts["rows"]
    _commit_run(spark, facts, path, at, state, name, any_rows)
    return True, facts["rows"]


def commit_part(batch: DataFrame, path: str, run_ts: datetime, keys: list[str]) -> bool:
    """Add a part of a run: rows of the same run that came before stay, unless the part holds their keys.

    A part that comes again changes nothing. What is compared is the run so far: a run whose parts together repeat the one
    before it is taken back, and its day is again what it was; a run that was skipped is remembered, so that a later part
    completes the unchanged rows instead of replacing them. Returns whether the history holds the run.
    """
    spark, at = batch.sparkSession, run_ts.replace(microsecond=0)
    state, run, known = stored_state(spark, path), at.isoformat(), None
    if _is_later(spark, path, at, state):
        return False
    if at.date() in state.dates():
        known = stored_day(spark, path, at.date(), state).where(F.col(STAMP) == moment(at)).drop(STAMP)
        known = None if known.isEmpty() else known
    stored = known is not None
    if known is None and run in state.skipped:
        known = newest_snapshot(spark, path, at, state)
    whole = batch
    if known is not None and keys and set(keys) <= set(known.columns):
        whole = append_by_name(known.join(batch.select(*keys), keys, "left_anti"), batch)
    elif known is not None:
        whole = append_by_name(known, batch).distinct()
    facts, undone = _facts(whole), _without_run(state, at)
    if not _repeats_newest(whole, facts, path, at, keys, undone):
        state.skipped = [r for r in state.skipped if r != run]
        name = new_name(state)
        _commit_run(spark, facts, path, at, state, name, _write_run(whole, path, at, name)[1])
        return True
    if stored or run not in state.skipped:
        undone.skipped = [*[r for r in state.skipped if r != run], run]
        write_state(spark, path, undone)
    return False


def _without_run(state: State, at: datetime) -> State:
    """The state as it would be if the run had not replaced its day."""
    day, run = at.date().isoformat(), at.isoformat()
    if run not in state.runs:
        return replace(state)
    own = state.runs[run]
    days = {**state.days, day: own.get("over", [])}
    runs = {k: v for k, v in state.runs.items() if k != run} | own.get("over_runs", {})
    return replace(state, days={k: v for k, v in days.items() if v}, runs=runs)


def adopt_unstamped(old: DataFrame, batch: DataFrame, path: str, run_ts: datetime) -> None:
    """One-time migration: keep an unstamped history by stamping it with this run, next to the batch."""
    replace_days(append_by_name(backfill_stamp(old, run_ts), stamp(batch, run_ts)), path)
