"""Snapshot history and streaming ingest."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from snapmart.catalog.registry import Tables, query, ts_sql
from snapmart.functions import day_of, moment
from snapmart.operators.compare import same_rows
from snapmart.operators.history import (
    append_by_name,
    backfill_stamp,
    commit_snapshot,
    read_history,
    replace_days,
    replace_same_day,
)
from snapmart.operators.joins import union_labelled
from snapmart.session import shared_dir
from snapmart.streaming.ingest import commit_days, commit_runs, ingest_available

LAST_RUN = datetime(2024, 1, 30, 12, 0, 0)  # a run on the last day of the event history


@query(
    "snapshot_equal",
    """
WITH changed AS (
  SELECT * REPLACE (CASE WHEN o_orderkey = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders
)
SELECT 'reordered' AS pair, NOT EXISTS (SELECT * FROM orders EXCEPT ALL SELECT * FROM orders) AS same
UNION ALL
SELECT 'changed', NOT EXISTS (SELECT * FROM orders EXCEPT ALL SELECT * FROM changed)
              AND NOT EXISTS (SELECT * FROM changed EXCEPT ALL SELECT * FROM orders)""",
)
def snapshot_equal(t: Tables):
    orders = t["orders"]
    price = F.col("o_totalprice")
    changed = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 1, price + 1).otherwise(price))
    reordered = orders.repartition(F.col("o_custkey"))
    return union_labelled(
        [("reordered", same_rows(orders, reordered)), ("changed", same_rows(orders, changed))], label="pair"
    )


COUNT_SQL = """
SELECT ts::DATE::VARCHAR AS day, event_type, count(*) AS n FROM events
{where} GROUP BY ALL"""
REPLACED = "WHERE ts::DATE <> DATE '2024-01-30' OR event_type = 'purchase'"


def count_by_day(df):
    return df.groupBy(day_of("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))


def rerun_of_last_day(t: Tables):
    return t["events"].where(day_of("ts") == F.lit(LAST_RUN.date())).where("event_type = 'purchase'")


@query("same_day_replace", COUNT_SQL.format(where=REPLACED))
def same_day_replace(t: Tables):
    return count_by_day(replace_same_day(t["events"], rerun_of_last_day(t), LAST_RUN, at="ts"))


@query("same_day_commit", COUNT_SQL.format(where=REPLACED))
def same_day_commit(t: Tables):
    path = shared_dir(t.spark, "history")
    replace_days(t["events"], path, "ts")
    replace_days(rerun_of_last_day(t), path, "ts")
    return count_by_day(read_history(t.spark, path))


@query(
    "snapshot_commits",
    """
SELECT stamp AS inserted_at, count(*) AS n_rows, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total
FROM (
  SELECT '2024-03-01 06:00:00.000000' AS stamp, o_totalprice FROM orders
  UNION ALL
  SELECT '2024-03-03 09:30:00.000000', o_totalprice + 1 FROM orders
) GROUP BY stamp""",
)
def snapshot_commits(t: Tables):
    """Four runs: first load, an unchanged run (skipped), a changed run, a second change the same day."""
    path = shared_dir(t.spark, "runs")
    orders = t["orders"].withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    raised = [orders.withColumn("o_totalprice", (F.col("o_totalprice") + n).cast("decimal(18,2)")) for n in (1, 2)]
    keys = ["o_orderkey"]
    commit_snapshot(orders, path, datetime(2024, 3, 1, 6), keys)
    commit_snapshot(orders.repartition(3), path, datetime(2024, 3, 2, 6), keys)
    commit_snapshot(raised[1], path, datetime(2024, 3, 3, 6), keys)
    commit_snapshot(raised[0], path, datetime(2024, 3, 3, 9, 30), keys)
    history = read_history(t.spark, path)
    return history.groupBy("inserted_at").agg(F.count("*").alias("n_rows"), F.sum("o_totalprice").alias("total"))


@query(
    "append_by_name",
    """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def append(t: Tables):
    history = t["customer"].selectExpr("c_custkey id", "c_name name", "c_acctbal balance", "c_mktsegment segment")
    batch = t["supplier"].selectExpr("s_acctbal balance", "s_suppkey id", "s_name name")
    return append_by_name(history, batch)


@query(
    "history_backfill",
    f"""
SELECT c_custkey AS id, c_name AS name, '2024-01-30 12:00:00.000000' AS inserted_at FROM customer
UNION ALL
SELECT user_id, event_type, {ts_sql("ts")} FROM events""",
)
def history_backfill(t: Tables):
    unstamped = t["customer"].selectExpr("c_custkey id", "c_name name")
    stamped = t["events"].selectExpr("user_id id", "event_type name", "ts inserted_at")
    return append_by_name(backfill_stamp(unstamped, LAST_RUN), backfill_stamp(stamped, LAST_RUN))


@query("stream_ingest", COUNT_SQL.format(where=""))
def stream_ingest(t: Tables):
    path = shared_dir(t.spark, "stream-history")
    # The glob makes a single file a valid stream source, as a folder of part files is.
    stream = t.spark.readStream.schema(t["events"].schema).parquet(f"{t.folder}/events.parquet*")
    ingest_available(stream, commit_days(path, "ts"), shared_dir(t.spark, "stream-checkpoint"))
    return count_by_day(read_history(t.spark, path))


@query(
    "stream_runs",
    """
SELECT event_id, user_id, value, '2024-03-0' || (event_id % 3 + 1) || ' 06:00:00.000000' AS inserted_at FROM events""",
)
def stream_runs(t: Tables):
    """Three runs in four micro-batches: a run in two parts, a late run, one that repeats another, and a retried batch."""
    path = shared_dir(t.spark, "stream-runs")
    third = F.col("event_id") % 3
    run = F.make_timestamp_ntz(F.lit(2024), F.lit(3), (third + 1).cast("int"), F.lit(6), F.lit(0), F.lit(0))
    events = t["events"].select("event_id", "user_id", "value", run.alias("run_ts"))
    first, second, last = (events.where(third == k) for k in range(3))
    half = F.col("event_id") % 2 == 0
    repeated = last.withColumn("run_ts", moment(datetime(2024, 3, 4, 6)))
    commit = commit_runs(path, ["event_id"])
    commit(first.unionByName(last.where(half)), 0)
    for _ in range(2):
        commit(second.unionByName(last.where(~half)), 1)
    commit(repeated, 2)
    return read_history(t.spark, path).select("event_id", "user_id", "value", "inserted_at")


ALL_EVENTS = """
SELECT event_id, user_id, event_type, value, CASE WHEN event_type <> 'error' THEN {ts} END AS ts FROM events"""
EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value", "ts")


def landed_events(t: Tables) -> str:
    """All events as files of two folders; errors have lost their time."""
    landing = shared_dir(t.spark, "landing")
    events = t["events"].withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts"))).select(*EVENT_COLUMNS)
    for k in range(2):
        events.where(F.col("event_id") % 2 == k).write.parquet(f"{landing}/{k}")
    return landing


@query("stream_exactly_once", ALL_EVENTS.format(ts=ts_sql("ts")))
def stream_exactly_once(t: Tables):
    """Two streams into one history, then one over both folders whose checkpoint is new: every row once, with its time."""
    landing, path = landed_events(t), shared_dir(t.spark, "stream-history")
    schema = t.spark.read.parquet(f"{landing}/0").schema
    for folder in ("0", "1", "*"):
        stream = t.spark.readStream.schema(schema).parquet(f"{landing}/{folder}")
        ingest_available(stream, commit_days(path, "ts"), shared_dir(t.spark, "stream-checkpoint"))
    return read_history(t.spark, path).select(*EVENT_COLUMNS)


@query(
    "same_day_contents",
    f"""
SELECT event_id, user_id, event_type, value, {ts_sql("ts")} AS ts FROM events {REPLACED}""",
)
def same_day_contents(t: Tables):
    """The day of a rerun holds its rows only; it is read while another load of the day fails to become visible."""
    path = shared_dir(t.spark, "history")
    replace_days(t["events"], path, "ts")
    replace_days(rerun_of_last_day(t), path, "ts")
    found = read_history(t.spark, path).select(*EVENT_COLUMNS)
    replace_days(t["events"].where("event_type = 'error'"), path, "ts")  # readers that are open keep what they have
    return found


@query(
    "split_runs",
    """
SELECT o_orderkey, o_totalprice::DOUBLE AS o_totalprice, '2024-03-01 06:00:00.000000' AS inserted_at FROM orders
UNION ALL
SELECT o_orderkey, (o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END)::DOUBLE,
       '2024-03-03 06:00:00.000000' FROM orders""",
)
def split_runs(t: Tables):
    """Three runs in two parts each: the first, one that repeats it and is taken back, and one whose second part differs."""
    path = shared_dir(t.spark, "split-runs")
    orders = t["orders"].select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    even = F.col("o_orderkey") % 2 == 0
    raised = orders.withColumn("o_totalprice", (F.col("o_totalprice") + 1).cast("decimal(18,2)"))
    for day, second in ((1, orders), (2, orders), (3, raised)):
        run = moment(datetime(2024, 3, day, 6))
        commit = commit_runs(path, ["o_orderkey"])
        commit(orders.where(~even).withColumn("run_ts", run), 0)
        commit(second.where(even).withColumn("run_ts", run), 1)
    return read_history(t.spark, path).select("o_orderkey", "o_totalprice", "inserted_at")
