"""Sources and nested records."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapmart.catalog.registry import Tables, query, ts_sql
from snapmart.operators.nested import drop_columns, explode_flatten, explode_list, flatten
from snapmart.session import shared_dir
from snapmart.sources.files import read_csv, read_csv_split, write_csv
from snapmart.sources.payloads import (
    derive_quotes,
    first_source_keys,
    land_records,
    merge_keyed,
    read_envelope,
    read_keyed_envelope,
)
from snapmart.sources.tables import conform, replace_table

ORDER_RECORD = "id BIGINT, customer BIGINT, status STRING, total DOUBLE, priority STRING"


def order_records(t: Tables):
    return t["orders"].select(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("customer"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total"),
            F.col("o_orderpriority").alias("priority"),
        ).alias("record")
    )


ORDER_RECORD_SQL = """
SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS total,
       o_orderpriority AS priority
FROM orders"""


@query("envelope_read", ORDER_RECORD_SQL)
def envelope_read(t: Tables):
    path = shared_dir(t.spark, "envelopes")
    land_records(order_records(t).select(F.array("record").alias("data")), path)
    return read_envelope(t.spark, path, StructType.fromDDL(ORDER_RECORD), whole_file=False).drop("_pos")


@query("keyed_envelope_read", ORDER_RECORD_SQL)
def keyed_envelope_read(t: Tables):
    path = shared_dir(t.spark, "keyed")
    keyed = order_records(t).select(F.create_map(F.col("record.id").cast("string"), F.col("record")).alias("data"))
    land_records(keyed, path)
    return read_keyed_envelope(t.spark, path, StructType.fromDDL(ORDER_RECORD), whole_file=False)


@query("json_extract", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_extract(t: Tables):
    return t["events"].select("event_id", F.from_json("props", "k INT").alias("p")).select("event_id", "p.k")


@query("map_values", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def map_values(t: Tables):
    props = F.map_values(F.from_json("props", "MAP<STRING, INT>"))
    return t["events"].select("event_id", F.explode(props).alias("k"))


@query("first_source_keys", "SELECT DISTINCT user_id FROM events")
def first_keys(t: Tables):
    missing = None
    empty = t["events"].where("event_type = 'none'")
    return first_source_keys([missing, empty, t["events"]], "user_id").distinct()


@query(
    "keyed_merge",
    """
SELECT s_suppkey AS id, s_name AS name, s_nationkey::BIGINT AS nation, s_acctbal AS balance FROM supplier
UNION ALL
SELECT c_custkey, c_name, c_nationkey::BIGINT, c_acctbal FROM customer
WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def keyed_merge(t: Tables):
    first = t["customer"].selectExpr("c_custkey id", "c_name name", "c_nationkey nation", "c_acctbal balance")
    second = t["supplier"].selectExpr("s_suppkey id", "s_name name", "s_nationkey nation", "s_acctbal balance")
    return merge_keyed([first, second], "id")


@query(
    "derive_quotes",
    """
SELECT o_orderkey AS id, 'Order#' || o_orderkey AS name, 'O' || o_orderkey AS symbol,
       'order-' || o_orderkey AS slug, 0::BIGINT AS is_fiat, 2781::BIGINT AS quote_id, 'USD' AS quote_symbol,
       o_totalprice AS quote_price, o_custkey::DOUBLE AS quote_minted_market_cap, NULL::DOUBLE AS quote_tvl
FROM orders WHERE o_orderstatus <> 'P'""",
)
def derived_quotes(t: Tables):
    usd = F.when(
        F.col("o_orderstatus") != "P",
        F.create_map(F.lit("price"), F.col("o_totalprice").cast("string"), F.lit("tvl"), F.lit(None).cast("string")),
    )
    listings = t["orders"].select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Order#"), "o_orderkey").alias("name"),
        F.concat(F.lit("O"), "o_orderkey").alias("symbol"),
        F.concat(F.lit("order-"), "o_orderkey").alias("slug"),
        F.col("o_custkey").cast("string").alias("minted_market_cap"),
        F.struct(usd.alias("USD")).alias("quote"),
    )
    flat = explode_flatten(derive_quotes(listings, limit=None), "quote")
    return flat.select(
        "id", "name", "symbol", "slug", "is_fiat", "quote_id", "quote_symbol",
        *[F.col(c).cast("double").alias(c) for c in ("quote_price", "quote_minted_market_cap", "quote_tvl")],
    )


@query("csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(t: Tables):
    documents = t["documents"].select("doc_id", "text", "lang", "source", "n_chars")
    path = shared_dir(t.spark, "csv")
    write_csv(documents, path)
    return read_csv(t.spark, path, documents.schema)


@query("csv_split", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_split(t: Tables):
    """The same with files that several tasks read, each a range of bytes that may begin inside a text."""
    documents = t["documents"].select("doc_id", "text", "lang", "source", "n_chars")
    path = shared_dir(t.spark, "csv")
    write_csv(documents, path)
    return read_csv_split(t.spark, path, documents.schema)


@query(
    "staging_load",
    """
SELECT p_partkey AS id, p_name AS name, p_brand AS symbol, p_size::BIGINT AS num_market_pairs,
       p_retailprice AS total_supply
FROM part""",
)
def staging_load(t: Tables):
    declared = StructType.fromDDL(
        "id BIGINT, name VARCHAR(100), symbol VARCHAR(20), num_market_pairs INT, total_supply DECIMAL(30,4)"
    )
    source = t["part"].selectExpr(
        "cast(p_partkey as string) id", "p_name name", "p_brand symbol", "p_type not_declared",
        "cast(p_size as string) num_market_pairs", "cast(p_retailprice as string) total_supply",
    )
    root = shared_dir(t.spark, "staging")
    return replace_table(conform(source, declared), "parts_" + root.rsplit("-", 1)[1], root)


@query(
    "flatten_struct",
    """
SELECT o_orderkey AS record_id, o_totalprice AS record_price_total, o_custkey AS record_buyer_id,
       o_orderstatus AS record_buyer_state_status, o_orderpriority AS record_buyer_state_priority
FROM orders""",
)
def flatten_struct(t: Tables):
    state = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_totalprice").alias("total")).alias("price"),
        F.struct(F.col("o_custkey").alias("id"), state.alias("state")).alias("buyer"),
    )
    return flatten(t["orders"].select(record.alias("record")))


@query(
    "explode_outer",
    r"""
WITH lists AS (SELECT doc_id, regexp_extract_all(text, '[0-9]+') AS number FROM documents)
SELECT doc_id, unnest(CASE WHEN len(number) > 0 THEN number ELSE [NULL] END) AS number FROM lists""",
)
def explode_outer(t: Tables):
    """All runs of digits of each text; a text without any stays as one row."""
    numbers = F.regexp_extract_all("text", F.lit("([0-9]+)"))
    return explode_list(t["documents"].select("doc_id", numbers.alias("number")), "number")


@query(
    "explode_flatten",
    """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, 'quantity' AS measure_kind, l_quantity AS measure_amount
FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber::BIGINT, 'discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber::BIGINT, 'tax', l_tax FROM lineitem""",
)
def explode_and_flatten(t: Tables):
    measures = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(f"l_{kind}").alias("amount"))
            for kind in ("quantity", "discount", "tax")
        ]
    )
    return explode_flatten(t["lineitem"].select("l_orderkey", "l_linenumber", measures.alias("measure")), "measure")


@query(
    "drop_columns",
    "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part",
)
def dropped(t: Tables):
    return drop_columns(t["part"], ["p_type", "p_size", "no_such_column"])


@query(
    "stage_project",
    f"""
SELECT o_orderkey AS coin_id, o_custkey::VARCHAR AS owner, (o_orderstatus = 'F') AS is_closed,
       o_totalprice AS price, {ts_sql("o_orderdate")} AS date_added_at, o_orderdate::DATE::VARCHAR AS added_on
FROM orders""",
)
def stage_project(t: Tables):
    return t["orders"].select(
        F.col("o_orderkey").alias("coin_id"),
        F.col("o_custkey").cast("string").alias("owner"),
        (F.col("o_orderstatus") == "F").alias("is_closed"),
        F.col("o_totalprice").cast("decimal(30,10)").alias("price"),
        F.col("o_orderdate").alias("date_added_at"),
        F.col("o_orderdate").cast("date").alias("added_on"),
    )
