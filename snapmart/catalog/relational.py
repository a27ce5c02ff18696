"""Filters, joins, aggregates, windows, top-k and set operations over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from snapmart.catalog.registry import Tables, query, ts_sql
from snapmart.functions import day_of, moment, money, ratio
from snapmart.operators.aggregates import counts_per_day, delimited_chunks, duplicate_keys, joined_names
from snapmart.operators.joins import enrich, join_same_day, orphans, rows_at_group_max, scoped, union_labelled
from snapmart.operators.latest import latest_batch, latest_per_key, latest_per_key_day
from snapmart.operators.ranking import rank_in_group, top_k, top_per_group
from snapmart.plans.panels import Watched, rows_per_day

EVENT_COLUMNS = f"event_id, {ts_sql('ts')} AS ts, user_id, event_type, value, props"


@query(
    "latest_per_key",
    f"""
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice,
       {ts_sql("l_shipdate")} AS l_shipdate
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey
  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1""",
)
def latest_line(t: Tables):
    lines = t["lineitem"].select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    ties = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    return latest_per_key(lines, ["l_partkey", "l_suppkey"], "l_shipdate", ties)


@query(
    "latest_per_key_single",
    f"""
SELECT {EVENT_COLUMNS} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_event(t: Tables):
    return latest_per_key(t["events"], ["user_id"], "ts", ["event_id"])


@query(
    "latest_per_key_day",
    f"""
SELECT ts::DATE::VARCHAR AS snapshot_date, {EVENT_COLUMNS} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_event_of_day(t: Tables):
    return latest_per_key_day(t["events"], ["user_id"], "ts", ["event_id"])


@query(
    "latest_batch",
    """
SELECT o_orderkey, o_custkey, o_orderdate::DATE::VARCHAR AS day FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def newest_orders(t: Tables):
    return latest_batch(t["orders"], "o_orderdate").select("o_orderkey", "o_custkey", day_of("o_orderdate").alias("day"))


@query(
    "filter_predicates",
    """
SELECT d.doc_id, lang, n_chars, quality::BIGINT AS quality, toxic::BIGINT AS toxic, quality IS NULL AS unlabelled, n_chars >= 1000 AS is_long
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE (quality IS NULL AND n_chars BETWEEN 100 AND 5000) OR (quality IS NOT NULL AND toxic = 0 AND n_chars >= 100)""",
)
def filter_predicates(t: Tables):
    joined = enrich(t["documents"].select("doc_id", "lang", "n_chars"), t["labels"], "doc_id")
    known = F.col("quality").isNotNull()
    kept = joined.where(
        (~known & F.col("n_chars").between(100, 5000)) | (known & (F.col("toxic") == 0) & (F.col("n_chars") >= 100))
    )
    return kept.select("*", F.col("quality").isNull().alias("unlabelled"), (F.col("n_chars") >= 1000).alias("is_long"))


@query(
    "left_enrich",
    """
SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def left_enrich(t: Tables):
    customers = t["customer"].select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    return enrich(customers, t["nation"], "n_nationkey").withColumnRenamed("n_nationkey", "c_nationkey")


@query(
    "scope_inner",
    """
SELECT event_id, user_id, event_type, value FROM events
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def scope_inner(t: Tables):
    builders = t["customer"].where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    return scoped(t["events"].select("event_id", "user_id", "event_type", "value"), builders, "user_id")


@query(
    "latest_pair_join",
    f"""
WITH o AS (SELECT o_custkey AS user_id, o_orderkey, o_orderdate FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
     e AS (SELECT user_id, event_id, ts FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, o_orderkey, event_id, {ts_sql("greatest(o_orderdate, ts)")} AS seen_at FROM o LEFT JOIN e USING (user_id)""",
)
def latest_pair_join(t: Tables):
    orders = t["orders"].select(F.col("o_custkey").alias("user_id"), "o_orderkey", "o_orderdate")
    events = t["events"].select("user_id", "event_id", "ts")
    newest_order = latest_per_key(orders, ["user_id"], "o_orderdate", ["o_orderkey"])
    newest_event = latest_per_key(events, ["user_id"], "ts", ["event_id"])
    return enrich(newest_order, newest_event, "user_id").select(
        "user_id", "o_orderkey", "event_id", F.greatest("o_orderdate", "ts").alias("seen_at")
    )


@query(
    "daily_join",
    f"""
WITH d AS (SELECT user_id, event_id, ts FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1),
     p AS (SELECT user_id, event_id AS purchase_id, ts AS bought_at, value FROM events WHERE event_type = 'purchase'
           QUALIFY row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1)
SELECT d.user_id, event_id, {ts_sql("ts")} AS ts, purchase_id, {ts_sql("bought_at")} AS bought_at, value
FROM d LEFT JOIN p ON p.user_id = d.user_id AND bought_at::DATE = ts::DATE""",
)
def daily_join(t: Tables):
    events = t["events"].select("user_id", "event_id", "ts")
    bought = t["events"].where("event_type = 'purchase'").selectExpr("user_id", "event_id purchase_id", "ts bought_at", "value")
    daily = latest_per_key_day(events, ["user_id"], "ts", ["event_id"]).drop("snapshot_date")
    purchases = latest_per_key_day(bought, ["user_id"], "bought_at", ["purchase_id"]).drop("snapshot_date")
    return join_same_day(daily, purchases, "user_id", "ts", "bought_at")


@query(
    "join_using",
    """
SELECT p_brand, count(*) AS n_lines, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand""",
)
def join_using(t: Tables):
    """Line items are summed per part before the join, so that a hot part reaches it as one row."""
    per_part = (
        t["lineitem"]
        .groupBy(F.col("l_partkey").alias("partkey"))
        .agg(F.count("*").alias("n"), F.sum(money("l_extendedprice")).alias("total"))
    )
    parts = t["part"].select(F.col("p_partkey").alias("partkey"), "p_brand")
    return per_part.join(parts, on=["partkey"]).groupBy("p_brand").agg(
        F.sum("n").alias("n_lines"), F.sum("total").alias("total")
    )


@query(
    "latest_by_max_join",
    """
SELECT o_custkey, o_orderkey, o_orderdate::DATE::VARCHAR AS day FROM orders
JOIN (SELECT o_custkey, max(o_orderdate) AS newest FROM orders GROUP BY o_custkey) m USING (o_custkey)
WHERE o_orderdate = newest""",
)
def latest_by_max_join(t: Tables):
    orders = t["orders"].select("o_custkey", "o_orderkey", "o_orderdate")
    newest = rows_at_group_max(orders, "o_custkey", "o_orderdate")
    return newest.select("o_custkey", "o_orderkey", day_of("o_orderdate").alias("day"))


@query(
    "fk_orphans",
    """
SELECT 'documents' AS child, d.doc_id AS key, count(*) AS child_rows FROM documents d
WHERE d.doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY ALL
UNION ALL
SELECT 'lineitem', l_orderkey, count(*) FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY ALL""",
)
def fk_orphans(t: Tables):
    settled = t["orders"].where("o_orderstatus <> 'P'")
    unlabelled = orphans(t["documents"], "doc_id", t["labels"], "doc_id").withColumnRenamed("doc_id", "key")
    open_lines = orphans(t["lineitem"], "l_orderkey", settled, "o_orderkey").withColumnRenamed("l_orderkey", "key")
    return union_labelled([("documents", unlabelled), ("lineitem", open_lines)], label="child")


@query(
    "filtered_agg",
    """
SELECT ts::DATE::VARCHAR AS day, max(value) FILTER (WHERE user_id = 1) AS lead_value,
       (sum(value::DECIMAL(18,2)) FILTER (WHERE event_type = 'purchase'))::DOUBLE AS bought,
       count(*) FILTER (WHERE event_type = 'error') AS n_errors, min(value) AS low, max(value) AS high,
       sum(value::DECIMAL(18,2))::DOUBLE / count(value) AS mean_value
FROM events GROUP BY ALL""",
)
def filtered_agg(t: Tables):
    kind, value = F.col("event_type"), F.col("value")
    return t["events"].groupBy(day_of("ts").alias("day")).agg(
        F.max(F.when(F.col("user_id") == 1, value)).alias("lead_value"),
        F.sum(F.when(kind == "purchase", money("value"))).alias("bought"),
        F.count_if(kind == "error").alias("n_errors"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        ratio(F.sum(money("value")), F.count("value")).alias("mean_value"),
    )


@query(
    "row_count_per_day",
    """
WITH counts AS (
  SELECT ts::DATE AS day, 'events' AS metric, count(*) AS n FROM events GROUP BY ALL
  UNION ALL SELECT o_orderdate::DATE, 'orders', count(*) FROM orders GROUP BY ALL
  UNION ALL SELECT l_shipdate::DATE, 'lineitem', count(*) FROM lineitem GROUP BY ALL
)
SELECT day::VARCHAR AS day, max(CASE WHEN metric = 'events' THEN n END) AS events,
       max(CASE WHEN metric = 'orders' THEN n END) AS orders, max(CASE WHEN metric = 'lineitem' THEN n END) AS lineitem
FROM counts GROUP BY day""",
)
def row_count_per_day(t: Tables):
    return counts_per_day(
        [("events", t["events"], "ts"), ("orders", t["orders"], "o_orderdate"), ("lineitem", t["lineitem"], "l_shipdate")]
    )


@query(
    "row_count_in_range",
    """
WITH counts AS (
  SELECT ts::DATE AS day, 'events' AS metric, count(*) AS n FROM events
  WHERE ts BETWEEN TIMESTAMP '1996-07-01 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00' GROUP BY ALL
  UNION ALL SELECT o_orderdate::DATE, 'orders', count(*) FROM orders
  WHERE o_orderdate BETWEEN TIMESTAMP '1996-07-01 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00' GROUP BY ALL
)
SELECT day::VARCHAR AS day, max(CASE WHEN metric = 'events' THEN n END) AS events,
       max(CASE WHEN metric = 'orders' THEN n END) AS orders
FROM counts GROUP BY day""",
)
def row_count_in_range(t: Tables):
    """The rows-per-day panel within a time range."""
    watched = {"events": Watched(t["events"], "ts"), "orders": Watched(t["orders"], "o_orderdate")}
    return rows_per_day(watched, datetime(1996, 7, 1), datetime(2024, 1, 20, 12))


@query(
    "duplicate_keys",
    """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_line_keys(t: Tables):
    return duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])


RANKED_SQL = """
SELECT day::VARCHAR AS snapshot_date, user_id, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY value DESC NULLS LAST, user_id) AS rank FROM (
    SELECT user_id, ts::DATE AS day, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1))"""


def daily_values(t: Tables):
    events = t["events"].select("user_id", "ts", "event_id", "value")
    daily = latest_per_key_day(events, ["user_id"], "ts", ["event_id"])
    return daily.select("snapshot_date", "user_id", "value")


@query("rank_in_day", RANKED_SQL)
def rank_in_day(t: Tables):
    return rank_in_group(daily_values(t), ["snapshot_date"], "value", "user_id", cuts_from=t["events"])


@query("top_in_day", f"SELECT snapshot_date, user_id, value FROM ({RANKED_SQL}) WHERE rank <= 10")
def top_in_day(t: Tables):
    order = [F.col("value").desc_nulls_last(), F.col("user_id")]
    return top_per_group(daily_values(t), ["snapshot_date"], order, 10)


@query(
    "top_k",
    """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
)
def top_orders(t: Tables):
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    return top_k(orders, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")], 100)


ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


@query(
    "union_labelled",
    "\nUNION ALL\n".join(f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}" for name in ALL_TABLES),
)
def table_counts(t: Tables):
    return union_labelled([(name, t[name].agg(F.count("*").alias("n"))) for name in ALL_TABLES])


@query(
    "joined_names",
    """
SELECT p_brand, count(*) AS n_names, string_agg(p_type, ', ' ORDER BY p_type) AS names
FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY p_brand""",
)
def types_of_brand(t: Tables):
    return joined_names(t["part"], "p_brand", "p_type")


@query(
    "key_chunks",
    """
SELECT (o_orderkey // 500) AS chunk, count(*) AS n_keys, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS keys
FROM orders GROUP BY ALL""",
)
def key_chunks(t: Tables):
    return delimited_chunks(t["orders"], "o_orderkey", 500)


@query(
    "event_window",
    f"""
SELECT {EVENT_COLUMNS} FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12' AND event_type = 'purchase'""",
)
def event_window(t: Tables):
    first, last = (moment(datetime(2024, 1, d)) for d in (10, 12))
    return t["events"].where(F.col("ts").between(first, last)).where("event_type = 'purchase'")
