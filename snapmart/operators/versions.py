"""Versions of a stored history: what is written becomes visible as a unit, and open readers keep what they have.

A commit writes its rows to a folder of its own, ``version=<name>/snapshot_date=<day>``, and then one small state file
that names, for each day, the versions that make it up. Readers take the newest state. A commit that is killed leaves a
folder that no state names, and files of replaced versions stay until ``remove_unused`` takes them away, so neither a
reader that is open nor a failure sees half a day. The state grows with the days and runs of the history, not with its
rows. One writer at a time is expected; a second one that commits in between fails the slower one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

STATES = "_commits"
LEDGER = "_ledger"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # how Spark names the folder of rows without a day


@dataclass
class State:
    """Versions of each day, what is known of each run, runs that were skipped, and versions of the ledger."""

    number: int = 0
    days: dict[str, list[str]] = field(default_factory=dict)
    runs: dict[str, dict] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    ledger: list[str] = field(default_factory=list)

    def dates(self) -> list[date]:
        """The days, oldest first; rows without a day are in none."""
        return sorted(date.fromisoformat(day) for day in self.days if day != NO_DAY)

    def versions(self) -> set[str]:
        return {version for versions in self.days.values() for version in versions}


def file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = file_system(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(place)] if files.exists(place) else []


def _read_text(spark: SparkSession, path: str) -> str:
    files, place = file_system(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_state(spark: SparkSession, path: str, day_column: str) -> State:
    """The newest state. A history that was written without versions is one version without a name."""
    numbers = [int(name.removesuffix(".json")) for name in _names(spark, f"{path}/{STATES}") if name.endswith(".json")]
    if numbers:
        return State(**json.loads(_read_text(spark, f"{path}/{STATES}/{max(numbers):08d}.json")))
    days = [name.partition("=")[2] for name in _names(spark, path) if name.startswith(f"{day_column}=")]
    return State(days={day: [""] for day in days})


def write_state(spark: SparkSession, path: str, state: State) -> None:
    """Make a state the newest one; it is complete before it gets its name."""
    text = json.dumps({**vars(state), "number": state.number + 1})
    files, target = file_system(spark, f"{path}/{STATES}/{state.number + 1:08d}.json")
    _, draft = file_system(spark, f"{path}/{STATES}/draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise RuntimeError(f"another commit to {path} was faster; run this one again")
    state.number += 1


def new_name(state: State) -> str:
    return f"{state.number + 1:08d}-{uuid.uuid4().hex[:8]}"


def write_version(rows: DataFrame, path: str, name: str, day_column: str, rebalance: bool = True) -> list[str]:
    """Write rows, which have their day as a column, as a version, and return its days.

    The rebalance hint lets AQE cut a large day into several files and pack small days; rows of one day need no move.
    """
    folder = f"{path}/version={name}"
    rows = rows.hint("rebalance", day_column) if rebalance else rows
    rows.write.partitionBy(day_column).parquet(folder)
    return [n.partition("=")[2] for n in _names(rows.sparkSession, folder) if n.startswith(f"{day_column}=")]


def folders(path: str, day_column: str, days: dict[str, list[str]]) -> tuple[list[str], list[str]]:
    """The folders of some days: those in versions, and those that were written without."""
    own = [(v, f"{day_column}={day}") for day, versions in sorted(days.items()) for v in versions]
    return [f"{path}/version={v}/{day}" for v, day in own if v], [f"{path}/{day}" for v, day in own if not v]


def remove_version(spark: SparkSession, path: str, name: str) -> None:
    """Delete a version that no state names."""
    files, place = file_system(spark, f"{path}/version={name}")
    files.delete(place, True)


def remove_unused(spark: SparkSession, path: str, day_column: str, keep: Callable[[str], bool] = lambda name: False) -> list[str]:
    """Delete versions that the newest state doesn't name and that ``keep`` doesn't hold back; readers that opened an
    older state must be done, and no commit may be running. Returns the names of the deleted versions."""
    state = read_state(spark, path, day_column)
    needed = state.versions() | {v for run in state.runs.values() for v in run.get("over", ())}
    stored = [name.partition("=")[2] for name in _names(spark, path) if name.startswith("version=")]
    unused = [name for name in stored if name not in needed and not keep(name)]
    for name in unused:
        remove_version(spark, path, name)
    return unused
