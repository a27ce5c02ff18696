"""Scalar functions over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from snapmart.catalog.registry import Tables, query, ts_sql
from snapmart.functions import cut_text, day_of, day_text, escape_markup, minutes_between, moment, money, ratio, within_days
from snapmart.operators.joins import enrich

ORDERS_AS_OF = datetime(2001, 8, 1)


@query(
    "fn_casts",
    """
SELECT o_orderkey::VARCHAR AS key_text, o_totalprice::DECIMAL(30,4)::DOUBLE AS price,
       left(o_orderpriority, 1)::BIGINT AS priority, o_orderdate::DATE::VARCHAR AS day,
       (o_orderstatus = 'F') AS is_closed, o_custkey::BIGINT AS customer,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS ordered_at, (o_custkey <> 0) AS has_customer
FROM orders""",
)
def fn_casts(t: Tables):
    return t["orders"].select(
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("decimal(30,4)").alias("price"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        day_of("o_orderdate").alias("day"),
        (F.col("o_orderstatus") == "F").alias("is_closed"),
        F.col("o_custkey").cast("string").cast("bigint").alias("customer"),
        F.col("o_orderdate").cast("string").cast("timestamp_ntz").alias("ordered_at"),
        F.col("o_custkey").cast("boolean").alias("has_customer"),
    )


@query(
    "fn_conditional",
    """
SELECT d.doc_id, coalesce(quality, -1)::BIGINT AS quality_or, nullif(toxic, 0)::BIGINT AS toxic_or_null,
       greatest(quality, toxic)::BIGINT AS worst,
       CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE 'other' END AS verdict
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def fn_conditional(t: Tables):
    joined = enrich(t["documents"].select("doc_id"), t["labels"], "doc_id")
    return joined.select(
        "doc_id",
        F.coalesce("quality", F.lit(-1)).alias("quality_or"),
        F.nullif("toxic", F.lit(0)).alias("toxic_or_null"),
        F.greatest("quality", "toxic").alias("worst"),
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("other").alias("verdict"),
    )


@query(
    "fn_math",
    """
SELECT event_id, round(value::DECIMAL(18,2) * 0.125, 2)::DOUBLE AS eighth,
       (value::DECIMAL(18,2) + user_id)::DOUBLE AS raised, (value::DECIMAL(18,2) - user_id)::DOUBLE AS lowered,
       value / nullif(user_id::DOUBLE, 0) AS per_user, (-value) AS negated,
       round(-(value::DECIMAL(18,2)) * 0.5, 1)::DOUBLE AS half_down
FROM events""",
)
def fn_math(t: Tables):
    value = money("value")
    return t["events"].select(
        "event_id",
        F.round(value * F.lit("0.125").cast("decimal(4,3)"), 2).alias("eighth"),
        (value + F.col("user_id")).alias("raised"),
        (value - F.col("user_id")).alias("lowered"),
        ratio("value", "user_id").alias("per_user"),
        (-F.col("value")).alias("negated"),
        F.round(-value * F.lit("0.5").cast("decimal(2,1)"), 1).alias("half_down"),
    )


@query(
    "fn_datetime",
    f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_text, o_orderdate::DATE::VARCHAR AS day,
       o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 90 DAY AS is_recent,
       date_trunc('day', o_orderdate)::DATE::VARCHAR AS day_start,
       {ts_sql("o_orderdate + to_hours(left(o_orderpriority, 1)::INT)")} AS due_at,
       (epoch_us(TIMESTAMP '2001-08-01') - epoch_us(o_orderdate)) / 60000000.0 AS minutes_old
FROM orders""",
)
def fn_datetime(t: Tables):
    ordered = F.col("o_orderdate")
    as_of = moment(ORDERS_AS_OF)
    hours = F.substring("o_orderpriority", 1, 1).cast("int")
    return t["orders"].select(
        "o_orderkey",
        day_text("o_orderdate").alias("day_text"),
        day_of("o_orderdate").alias("day"),
        within_days("o_orderdate", ORDERS_AS_OF, 90).alias("is_recent"),
        day_of("o_orderdate").alias("day_start"),
        (ordered + F.make_interval(hours=hours)).alias("due_at"),
        minutes_between(as_of, ordered).alias("minutes_old"),
    )


@query(
    "fn_string",
    """
SELECT doc_id,
       replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'),
               '''', '&#x27;') AS escaped,
       left(text, 300) AS alert_line, concat_ws(',', doc_id::VARCHAR, lang, source) AS joined
FROM documents""",
)
def fn_string(t: Tables):
    return t["documents"].select(
        "doc_id",
        escape_markup("text").alias("escaped"),
        cut_text("text").alias("alert_line"),
        F.concat_ws(",", F.col("doc_id").cast("string"), "lang", "source").alias("joined"),
    )
