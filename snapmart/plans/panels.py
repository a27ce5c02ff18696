"""Monitoring panels over the staging tables and a run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import hours_between, interval_hours, minutes_between, moment
from snapmart.operators.aggregates import counts_per_day, duplicate_keys, missing_percent, success_rate
from snapmart.operators.history import STAMP
from snapmart.operators.joins import rows_at_group_max, union_labelled
from snapmart.operators.latest import latest_batch
from snapmart.plans.quality import MARKET_CHECKS, WHOLE


@dataclass(frozen=True)
class Watched:
    """A table shown on the panels: its rows, stamp, key, allowed age and expected batch size.

    ``batched`` is false for a current-state table, which is checked as a whole.
    """

    df: DataFrame
    at: str = STAMP
    keys: tuple[str, ...] = ()
    sla_hours: int = 0
    expected: tuple[int, int] = (0, 0)
    batched: bool = True
    day: str | None = None

    def newest(self) -> DataFrame:
        return latest_batch(self.df, self.at, self.day) if self.batched else self.df


# Allowed age in hours and expected rows of the newest batch.
MARKET_SLA_HOURS = {"listings_latest": 48, "quotes": 48, "categories": 192, "category_details": 216}
MARKET_BATCH_ROWS = {
    "listings_latest": (480, 520),
    "quotes": (380, 420),
    "categories": (350, 400),
    "category_details": (13400, 16400),
}
MARKET_KEYS = {
    "listings_latest": ("id", "inserted_at"),
    "quotes": ("id", "quote_id", "inserted_at"),
    "categories": ("id", "inserted_at"),
    "category_details": ("id", "coins_id", "inserted_at"),
}

def allowed_missing(table: str) -> dict[str, int]:
    """Allowed missing percentage per column: the limits of the table's checks on all its rows."""
    kinds = ("missing_count", "missing_percent_below")
    checks = [c for c in MARKET_CHECKS[table] if c.kind in kinds and c.partition == WHOLE]
    return {c.columns[0]: int(c.limit) for c in checks}


def market_watch(tables: Mapping[str, DataFrame], day: str | None = None) -> dict[str, Watched]:
    """The four stamped staging tables with their fixed limits."""
    return {
        name: Watched(tables[name], STAMP, MARKET_KEYS[name], hours, MARKET_BATCH_ROWS[name], True, day)
        for name, hours in MARKET_SLA_HOURS.items()
    }


def _status(good: Column, bad_word: str) -> Column:
    return F.when(good, "OK").otherwise(bad_word).alias("status")


def freshness(watched: Mapping[str, Watched]) -> DataFrame:
    return union_labelled([(n, w.df.agg(F.max(w.at).alias("last_inserted"))) for n, w in watched.items()])


def freshness_sla(watched: Mapping[str, Watched], as_of: datetime) -> DataFrame:
    """Age of each table against its limit. An empty table shows OK: its age is unknown, and the row
    count checks report it."""
    now = moment(as_of)
    newest = union_labelled(
        [
            (n, w.df.agg(F.max(w.at).alias("last_inserted")).withColumn("sla_hours", F.lit(w.sla_hours)))
            for n, w in watched.items()
        ]
    )
    late = now - F.col("last_inserted") > interval_hours(F.col("sla_hours"))
    return newest.select(
        "table_name",
        "last_inserted",
        F.round(hours_between(now, F.col("last_inserted")).cast("decimal(20,6)"), 1).cast("double").alias(
            "hours_since_update"
        ),
        "sla_hours",
        F.when(late, "STALE").otherwise("OK").alias("status"),
    )


def duplicate_status(watched: Mapping[str, Watched]) -> DataFrame:
    """Duplicate key groups in the newest batch of each table."""
    counts = union_labelled(
        [
            (n, duplicate_keys(w.newest(), w.keys).agg(F.count("*").alias("duplicate_groups")))
            for n, w in watched.items()
        ]
    )
    return counts.withColumn("status", _status(F.col("duplicate_groups") == 0, "FAIL"))


def missing_status(parts: Sequence[tuple[str, DataFrame, Mapping[str, int]]]) -> DataFrame:
    """Missing percentage per column against the allowed one; one pass per table.

    Fails only above the limit; an empty input has no percentage and shows OK.
    """
    shares = []
    for table, df, allowed in parts:
        percent = F.create_map(*[F.lit(x) for pair in allowed.items() for x in pair])
        rows = missing_percent(df, list(allowed)).withColumn("threshold_percent", percent[F.col("column_name")])
        shares.append((table, rows))
    above = F.col("missing_percent") > F.col("threshold_percent")
    return union_labelled(shares).withColumn("status", F.when(above, "FAIL").otherwise("OK"))


def market_missing_status(tables: Mapping[str, DataFrame], day: str | None = None) -> DataFrame:
    """The missing-value panel of the staging tables; ``info`` is current-state and read as a whole."""
    return missing_status(
        [
            (n, tables[n] if n == "info" else latest_batch(tables[n], STAMP, day), allowed_missing(n))
            for n in MARKET_CHECKS
        ]
    )


def rows_per_day(
    watched: Mapping[str, Watched], since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Rows of each table by day, within the panel's time range (both ends belong to it) if one is given.

    The range is also a filter on a stored history's day, so only its partitions are read.
    """

    def ranged(watch: Watched) -> DataFrame:
        rows = watch.df
        for end, after in ((since, True), (until, False)):
            if end is not None:
                rows = rows.where(F.col(watch.at) >= moment(end) if after else F.col(watch.at) <= moment(end))
                if watch.day is not None:
                    day = F.lit(end.date())
                    rows = rows.where(F.col(watch.day) >= day if after else F.col(watch.day) <= day)
        return rows

    return counts_per_day([(name, ranged(watch), watch.at) for name, watch in watched.items()])


def batch_size_status(watched: Mapping[str, Watched]) -> DataFrame:
    """Rows of the newest batch against the expected range."""
    counts = union_labelled(
        [
            (
                n,
                w.newest()
                .agg(F.count("*").alias("row_count"))
                .withColumn("expected_min", F.lit(w.expected[0]))
                .withColumn("expected_max", F.lit(w.expected[1])),
            )
            for n, w in watched.items()
        ]
    )
    inside = F.col("row_count").between(F.col("expected_min"), F.col("expected_max"))
    return counts.withColumn("status", _status(inside, "OUT OF RANGE"))


def latest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of each job with its duration; runs that started together are all shown."""
    newest = rows_at_group_max(runs.select("job_id", "state", "start_date", "end_date"), "job_id", "start_date")
    minutes = minutes_between(F.col("end_date"), F.col("start_date")).cast("decimal(20,6)")
    return newest.withColumn("duration_minutes", F.round(minutes, 1).cast("double"))


def run_success(runs: DataFrame, first: datetime, last: datetime) -> DataFrame:
    inside = runs.where(
        F.col("start_date").between(moment(first), moment(last))
    )
    return success_rate(inside, "job_id", F.col("state") == "success")
