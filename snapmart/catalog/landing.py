"""The given tables landed as payloads, loaded through the refresh, and read back from the warehouse."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.catalog.market import DIM_COINS_SQL
from snapmart.catalog.registry import Tables, query, ts_sql
from snapmart.catalog.roles import COIN_INFO, COIN_MAP, EVENTS_WITH_AMOUNT
from snapmart.operators.history import read_history
from snapmart.operators.latest import latest_per_key
from snapmart.plans import core
from snapmart.plans.refresh import Layout, declare_warehouse, land_lines, land_quotes, load_dataset, run_pipeline
from snapmart.plans.staging import staged
from snapmart.schemas import DATASETS, record_schema
from snapmart.session import shared_dir
from snapmart.sources.payloads import read_entity_payloads

RUN = datetime(2024, 2, 1, 6)


def new_layout(t: Tables) -> Layout:
    root = shared_dir(t.spark, "market")
    return Layout(f"{root}/landing", f"{root}/warehouse", lines=frozenset(DATASETS))


@query("landed_dim_coins", DIM_COINS_SQL)
def landed_dim_coins(t: Tables):
    """Coin dimension from landed array and keyed payloads."""
    layout = new_layout(t)
    land_lines(t["supplier"].selectExpr(*COIN_MAP), layout, "map")
    land_lines(t["part"].selectExpr(*COIN_INFO), layout, "info")
    for name in ("map", "info"):
        load_dataset(t.spark, layout, DATASETS[name], RUN)
    stg_map, stg_info = (staged(t.spark.table(f"staging_layer.{name}"), name) for name in ("map", "info"))
    return core.coins(stg_map, stg_info)


@query(
    "landed_quotes",
    """
SELECT user_id AS coin_id, 'User ' || user_id AS coin_name, false AS is_fiat, 2781::BIGINT AS quote_currency_id,
       'USD' AS quote_currency_symbol, value AS price, (value::DECIMAL(18,2) * 1000)::DOUBLE AS market_cap,
       (value::DECIMAL(18,2) * 3)::DOUBLE AS minted_market_cap, NULL::DOUBLE AS tvl,
       '2024-02-01 06:00:00.000000' AS inserted_at
FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
WHERE event_type <> 'error'""",
)
def landed_quotes(t: Tables):
    """Quotes derived from landed listings; the newest event of each user is its listing, errors have no quote."""
    layout = new_layout(t)
    newest = latest_per_key(t["events"], ["user_id"], "ts", ["event_id"]).selectExpr(*EVENTS_WITH_AMOUNT)
    listings = newest.selectExpr(
        "user_id as id",
        "'User ' || user_id as name",
        "'U' || user_id as symbol",
        "'user-' || user_id as slug",
        "v * 3 as minted_market_cap",
        """named_struct('USD', if(event_type = 'error', null,
             map('price', cast(v as string), 'market_cap', cast(v * 1000 as string)))) as quote""",
    )
    land_lines(listings, layout, "listings_latest")
    land_quotes(t.spark, layout)
    load_dataset(t.spark, layout, DATASETS["quotes"], RUN)
    quotes = staged(read_history(t.spark, layout.history("quotes")), "quotes")
    return quotes.select(
        "coin_id", "coin_name", "is_fiat", "quote_currency_id", "quote_currency_symbol", "price", "market_cap",
        "minted_market_cap", "tvl", "inserted_at",
    )


LOADED = "'2024-02-01 06:00:00.000000' AS inserted_at"


def loaded(t: Tables, name: str, records: DataFrame) -> DataFrame:
    """The staging model of records that were landed and loaded."""
    layout = new_layout(t)
    land_lines(records, layout, name)
    load_dataset(t.spark, layout, DATASETS[name], RUN)
    return staged(read_history(t.spark, layout.history(name)), name)


@query(
    "landed_categories",
    f"""
SELECT o_orderkey::VARCHAR AS category_id, o_orderpriority AS category_name, o_orderstatus AS category_title,
       o_custkey::BIGINT AS num_tokens, o_totalprice AS market_cap, {LOADED} FROM orders""",
)
def landed_categories(t: Tables):
    """Orders as category records."""
    records = t["orders"].selectExpr(
        "cast(o_orderkey as string) id",
        "o_orderpriority name",
        "o_orderstatus title",
        "cast(o_custkey as string) num_tokens",
        "cast(o_totalprice as string) market_cap",
    )
    found = loaded(t, "categories", records)
    return found.select("category_id", "category_name", "category_title", "num_tokens", "market_cap", "inserted_at")


@query(
    "landed_category_details",
    f"""
WITH coins AS (
  SELECT *, unnest(CASE WHEN l_returnflag = 'N' THEN [NULL] ELSE [l_partkey, l_suppkey + 1000000] END) AS coin_id
  FROM lineitem)
SELECT l_orderkey || '-' || l_linenumber AS category_id, l_linestatus AS category_name, coin_id::BIGINT AS coin_id,
       l_extendedprice AS market_cap, {LOADED} FROM coins""",
)
def landed_category_details(t: Tables):
    """Line items as category records with a list of two coins, or an empty one, which stays as one row."""
    records = t["lineitem"].selectExpr(
        "concat(l_orderkey, '-', l_linenumber) id",
        "l_linestatus name",
        "cast(l_extendedprice as string) market_cap",
        """if(l_returnflag = 'N', array(), array(
             named_struct('id', bigint(l_partkey)), named_struct('id', bigint(l_suppkey + 1000000)))) coins""",
    )
    found = loaded(t, "category_details", records)
    return found.select("category_id", "category_name", "coin_id", "market_cap", "inserted_at")


@query(
    "landed_listings",
    f"""
SELECT o_orderkey AS coin_id, o_orderstatus = 'F' AS is_infinite_supply, o_totalprice AS circulating_supply,
       {ts_sql("o_orderdate")} AS date_added_at, o_custkey::BIGINT AS cmc_rank, {LOADED} FROM orders""",
)
def landed_listings(t: Tables):
    """Orders as listing records; fields without a column are null."""
    records = t["orders"].selectExpr(
        "o_orderkey id",
        "o_orderstatus = 'F' infinite_supply",
        "cast(o_totalprice as string) circulating_supply",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") date_added",
        "cast(o_custkey as string) cmc_rank",
    )
    found = loaded(t, "listings_latest", records)
    return found.select(
        "coin_id", "is_infinite_supply", "circulating_supply", "date_added_at", "cmc_rank", "inserted_at"
    )


def event_listings(t: Tables) -> DataFrame:
    """Every event as a listing; errors have no quote."""
    return t["events"].selectExpr(*EVENTS_WITH_AMOUNT).selectExpr(
        "event_id as id",
        "'User ' || user_id as name",
        "'U' || user_id as symbol",
        "cast(event_id % 5000 as string) as cmc_rank",
        """named_struct('USD', if(event_type = 'error', null,
             map('price', cast(v as string), 'market_cap', cast(v * 1000 as string)))) as quote""",
    )


def named_layout(t: Tables) -> Layout:
    """A warehouse whose namespaces no other query has."""
    layout = new_layout(t)
    return replace(layout, prefix=f"q{layout.warehouse.rsplit('/', 2)[-2].rsplit('-', 1)[-1]}_")


@query(
    "published_models",
    """
WITH prices AS (SELECT event_id, value, event_type FROM events)
SELECT s_suppkey AS coin_id, s_name AS coin_name, value AS price, (value::DECIMAL(18,2) * 1000)::DOUBLE AS market_cap,
       CASE WHEN event_id IS NOT NULL THEN event_id % 5000 END AS cmc_rank, '2024-02-01' AS snapshot_date
FROM (SELECT * FROM supplier) LEFT JOIN prices ON event_id = s_suppkey
WHERE event_id IS NOT NULL AND event_type <> 'error'""",
)
def published_models(t: Tables):
    """Events landed as listings and suppliers as coins; then a session that knows only the names of the catalog asks."""
    layout = named_layout(t)
    declare_warehouse(t.spark, layout)
    land_lines(t["supplier"].selectExpr(*COIN_MAP), layout, "map")
    land_lines(t["part"].selectExpr(*COIN_INFO), layout, "info")
    land_lines(event_listings(t), layout, "listings_latest")
    run_pipeline(t.spark, layout, None, RUN)
    other = t.spark.newSession()
    explorer, quotes = (other.table(layout.model(name)) for name in ("vw_coin_explorer", "stg_quotes"))
    found = explorer.where("price is not null").join(quotes.select("coin_id", "snapshot_date"), "coin_id")
    return found.select("coin_id", "coin_name", "price", "market_cap", "cmc_rank", "snapshot_date")


@query(
    "pipeline_counts",
    """
SELECT 'map' AS dataset, count(*) AS row_count, false AS failed FROM supplier
UNION ALL SELECT 'info', count(*), false FROM part
UNION ALL SELECT 'listings_latest', count(*), false FROM events
UNION ALL SELECT 'quotes', count(*), false FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'categories', NULL, true
UNION ALL SELECT 'category_details', sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 2 END)::BIGINT, false FROM lineitem""",
)
def pipeline_counts(t: Tables):
    """A whole run over all data sets, with one whose values don't fit their types."""
    layout = named_layout(t)
    land_lines(t["supplier"].selectExpr(*COIN_MAP), layout, "map")
    land_lines(t["part"].selectExpr(*COIN_INFO), layout, "info")
    land_lines(event_listings(t), layout, "listings_latest")
    bad = t["orders"].selectExpr("cast(o_orderkey as string) id", "if(o_orderkey % 7 = 0, 'many', '1') num_tokens")
    land_lines(bad, layout, "categories")
    details = t["lineitem"].selectExpr(
        "concat(l_orderkey, '-', l_linenumber) id",
        """if(l_returnflag = 'N', array(), array(
             named_struct('id', bigint(l_partkey)), named_struct('id', bigint(l_suppkey + 1000000)))) coins""",
    )
    land_lines(details, layout, "category_details")
    report = run_pipeline(t.spark, layout, None, RUN)
    return report.select("dataset", "row_count", F.col("error").isNotNull().alias("failed"))


@query(
    "entity_payloads",
    """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS title FROM customer WHERE c_acctbal >= 0""",
)
def entity_payloads(t: Tables):
    """Customers landed as one payload each, a file to a group of customers; those in debt answer without data."""
    root = shared_dir(t.spark, "entities")
    record = F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("title"))
    answer = t["customer"].select(F.when(F.col("c_acctbal") >= 0, record).alias("data"), (F.col("c_custkey") % 4).alias("shard"))
    answer.write.partitionBy("shard").option("ignoreNullFields", True).json(root)
    paths = [f"{root}/shard={k}" for k in range(4)]
    found = read_entity_payloads(t.spark, paths, record_schema("categories"), whole_file=False)
    return found.select(F.col("id").cast("bigint").alias("id"), "name", "title")


@query(
    "limited_quotes",
    """
SELECT event_id AS id, 'User ' || user_id AS name, (value::DECIMAL(18,2) * 1000)::DOUBLE AS market_cap
FROM (SELECT * FROM events ORDER BY event_id LIMIT 700) WHERE event_type <> 'error'""",
)
def limited_quotes(t: Tables):
    """Quotes of the first 700 listings in the order in which all events were landed, one line each."""
    layout = new_layout(t)
    land_lines(event_listings(t).orderBy("id"), layout, "listings_latest")
    land_quotes(t.spark, layout, limit=700)
    load_dataset(t.spark, layout, DATASETS["quotes"], RUN)
    return read_history(t.spark, layout.history("quotes")).selectExpr("id", "name", "quote_market_cap as market_cap")
