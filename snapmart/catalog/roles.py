"""The given tables in the roles of the six staging tables.

coins = suppliers, coin info = parts (by the same numbers), listings and quotes = events (the user is
the coin, the number in ``props`` the rank), categories and their members = line items (the supplier is
the category, the part the coin, the ship date the run). Every role takes its whole table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from snapmart.catalog.registry import Tables
from snapmart.plans.refresh import Models
from snapmart.sources.tables import conform, staging_schema

AS_OF = datetime(2024, 2, 3)

# Amounts are exact two-decimal numbers; k is the number in ``props``.
EVENTS_WITH_AMOUNT = ("*", "cast(value as decimal(18,2)) as v", "from_json(props, 'k INT').k as k")
LINES_WITH_AMOUNT = ("*", "cast(l_extendedprice as decimal(18,2)) as price", "cast(l_suppkey as string) as sector")

LISTINGS = (
    "user_id as id",
    "case when event_type = 'view' then true when event_type <> 'click' then false end as infinite_supply",
    "v as circulating_supply",
    "v * 2 as total_supply",
    "case when event_type <> 'signup' then k end as max_supply",
    "ts - make_dt_interval(k * 3) as date_added",
    "k as num_market_pairs",
    "k as cmc_rank",
    "ts as last_updated",
    "null as tvl_ratio",
    "null as self_reported_circulating_supply",
    "null as self_reported_market_cap",
    "v * 3 as minted_market_cap",
    "ts as inserted_at",
)
QUOTES = (
    "user_id as id",
    "'User ' || user_id as name",
    "'U' || user_id as symbol",
    "'user-' || user_id as slug",
    "0 as is_fiat",
    "2781 as quote_id",
    "'USD' as quote_symbol",
    "v as quote_price",
    "v * k as quote_volume_24h",
    "v - k as quote_volume_change_24h",
    "v * 10 as quote_cex_volume_24h",
    "v * k as quote_dex_volume_24h",
    "k - 50 as quote_percent_change_1h",
    "v - k as quote_percent_change_24h",
    "case when event_type <> 'purchase' then k - 50 end as quote_percent_change_7d",
    "k as quote_percent_change_30d",
    "k * 2 as quote_percent_change_60d",
    "k * 3 as quote_percent_change_90d",
    "case when event_type <> 'error' then v * 1000 end as quote_market_cap",
    "v / 100 as quote_market_cap_dominance",
    "v * 1500 as quote_fully_diluted_market_cap",
    "v * 3 as quote_minted_market_cap",
    "case when event_type <> 'view' then k end as quote_tvl",
    "ts as quote_last_updated",
    "ts as inserted_at",
)
CATEGORIES = (
    "sector as id",
    "'Sector ' || sector as name",
    "'Sector no. ' || sector as title",
    "null as description",
    "price as volume",
    "cast(l_quantity as decimal(18,2)) as num_tokens",
    "cast(l_discount as decimal(18,2)) as avg_price_change",
    "price * 10 as market_cap",
    "case when l_returnflag <> 'R' then cast(l_tax as decimal(18,2)) end as market_cap_change",
    "cast(l_tax as decimal(18,2)) as volume_change",
    "l_shipdate as last_updated",
    "l_shipdate as inserted_at",
)
COIN_MAP = (
    "s_suppkey as id",
    "s_name as name",
    "'S' || s_suppkey as symbol",
    "'supplier-' || s_suppkey as slug",
    "if(s_acctbal > 0, 1, 0) as is_active",
    "null as first_historical_data",
    "null as last_historical_data",
)
COIN_INFO = (
    "p_partkey as id",
    "p_type as category",
    "p_name as description",
    "p_brand as logo",
    "case when p_size > 5 then timestamp_ntz'2020-01-01' + make_dt_interval(p_size) end as date_launched",
)


# Staging table -> given table, columns added to it, and its columns as staging columns.
ROLES = {
    "listings_latest": ("events", EVENTS_WITH_AMOUNT, LISTINGS),
    "quotes": ("events", EVENTS_WITH_AMOUNT, QUOTES),
    "categories": ("lineitem", LINES_WITH_AMOUNT, CATEGORIES),
    "category_details": ("lineitem", LINES_WITH_AMOUNT, (*CATEGORIES, "l_partkey as coins_id")),
    "map": ("supplier", ("*",), COIN_MAP),
    "info": ("part", ("*",), COIN_INFO),
}


class StagingRoles(dict):
    """The staging tables with their declared types, each declared when it is first asked for."""

    def __init__(self, t: Tables):
        super().__init__()
        self._given = t

    def __missing__(self, name: str) -> DataFrame:
        table, added, columns = ROLES[name]
        self[name] = conform(self._given[table].selectExpr(*added).selectExpr(*columns), staging_schema(name))
        return self[name]


def staging_roles(t: Tables) -> StagingRoles:
    return StagingRoles(t)


def models(t: Tables) -> Models:
    return Models(staging_roles(t), AS_OF)


# The staging tables in SQL, as far as the declared checks read them. Columns that are always filled
# in their role are stood in for by the key.
CHECKED_SQL = """
st_events AS (
  SELECT user_id AS id, ts AS inserted_at, event_type, json_extract_string(props, '$.k')::INT AS k FROM events
), st_listings_latest AS (
  SELECT id, inserted_at, CASE WHEN event_type <> 'click' THEN id END AS infinite_supply,
         CASE WHEN event_type <> 'signup' THEN k END AS max_supply, NULL::INT AS tvl_ratio,
         NULL::INT AS self_reported_circulating_supply, NULL::INT AS self_reported_market_cap
  FROM st_events
), st_quotes AS (
  SELECT id, inserted_at, 2781 AS quote_id, CASE WHEN event_type <> 'purchase' THEN k END AS quote_percent_change_7d,
         CASE WHEN event_type <> 'error' THEN k END AS quote_market_cap,
         CASE WHEN event_type <> 'view' THEN k END AS quote_tvl
  FROM st_events
), st_category_details AS (
  SELECT l_suppkey AS id, l_partkey AS coins_id, l_shipdate AS inserted_at, l_extendedprice AS volume,
         l_extendedprice::DECIMAL(18,2) * 10 AS market_cap, l_quantity AS num_tokens,
         CASE WHEN l_returnflag <> 'R' THEN l_tax END AS market_cap_change
  FROM lineitem
), st_categories AS (SELECT * EXCLUDE (coins_id) FROM st_category_details
), st_info AS (
  SELECT p_partkey AS id, CASE WHEN p_size > 5 THEN p_size END AS date_launched FROM part
)"""
CHECKED_COLUMNS = {
    "listings_latest": (
        "id",
        "inserted_at",
        "infinite_supply",
        "max_supply",
        "tvl_ratio",
        "self_reported_circulating_supply",
        "self_reported_market_cap",
    ),
    "quotes": ("id", "inserted_at", "quote_id", "quote_percent_change_7d", "quote_market_cap", "quote_tvl"),
    "category_details": ("id", "coins_id", "inserted_at", "volume", "market_cap", "num_tokens", "market_cap_change"),
    "categories": ("id", "inserted_at", "volume", "market_cap", "num_tokens", "market_cap_change"),
    "info": ("id", "date_launched"),
}

# The same roles in SQL. Amounts are exact decimals until a ratio is formed.
STAGING_SQL = """
ev AS (
  SELECT *, json_extract_string(props, '$.k')::INT AS k, value::DECIMAL(18,2) AS v FROM events
), listings AS (
  SELECT user_id AS coin_id,
         CASE WHEN event_type = 'view' THEN true WHEN event_type <> 'click' THEN false END AS is_infinite_supply,
         v AS circulating_supply, v * 2 AS total_supply,
         CASE WHEN event_type <> 'signup' THEN k END AS max_supply,
         ts - to_days(k * 3) AS date_added_at, k AS num_market_pairs, k AS cmc_rank, v * 3 AS minted_market_cap,
         ts AS inserted_at, ts::DATE AS day
  FROM ev
), quotes AS (
  SELECT user_id AS coin_id, 'User ' || user_id AS coin_name, 'U' || user_id AS coin_symbol, v AS price,
         v * k AS volume_24h, v - k AS volume_change_24h_pct, v * 10 AS cex_volume_24h, v * k AS dex_volume_24h,
         k - 50 AS percent_change_1h, v - k AS percent_change_24h,
         CASE WHEN event_type <> 'purchase' THEN k - 50 END AS percent_change_7d, k AS percent_change_30d,
         k * 2 AS percent_change_60d, k * 3 AS percent_change_90d,
         CASE WHEN event_type <> 'error' THEN v * 1000 END AS market_cap,
         v::DECIMAL(20,6) * 0.01 AS market_cap_dominance_pct, v * 1500 AS fully_diluted_market_cap,
         CASE WHEN event_type <> 'view' THEN k END AS tvl, ts AS inserted_at, ts::DATE AS day
  FROM ev
), dim_coins AS (
  SELECT s_suppkey AS coin_id, s_name AS coin_name, 'S' || s_suppkey AS coin_symbol,
         'supplier-' || s_suppkey AS coin_slug, s_acctbal > 0 AS is_active, p_type AS coin_category,
         p_name AS coin_description, p_brand AS logo_url,
         CASE WHEN p_size > 5 THEN TIMESTAMP '2020-01-01' + to_days(p_size) END AS date_launched_at
  FROM supplier LEFT JOIN part ON p_partkey = s_suppkey
), dim_categories AS (
  SELECT l_suppkey::VARCHAR AS category_id, 'Sector ' || l_suppkey AS category_name,
         'Sector no. ' || l_suppkey AS category_title, l_extendedprice AS volume_24h,
         l_quantity::BIGINT AS num_tokens, l_discount AS avg_price_change_pct,
         (l_extendedprice::DECIMAL(18,2) * 10)::DOUBLE AS market_cap,
         CASE WHEN l_returnflag <> 'R' THEN l_tax END AS market_cap_change_pct, l_tax AS volume_change_pct,
         l_shipdate AS inserted_at
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_extendedprice DESC) = 1
), bridge AS (
  SELECT l_suppkey::VARCHAR AS category_id, l_partkey AS coin_id, max(l_shipdate) AS inserted_at
  FROM lineitem WHERE l_partkey IN (SELECT coin_id FROM dim_coins) GROUP BY ALL
), fact AS (
  SELECT l.* EXCLUDE (inserted_at, day), q.* EXCLUDE (coin_id, coin_name, coin_symbol, inserted_at, day),
         greatest(l.inserted_at, q.inserted_at) AS inserted_at
  FROM (SELECT * FROM listings
        QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY inserted_at DESC) = 1) l
  SEMI JOIN dim_coins USING (coin_id)
  LEFT JOIN (SELECT * FROM quotes
             QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY inserted_at DESC) = 1) q
  ON q.coin_id = l.coin_id
), daily_quotes AS (
  SELECT * FROM quotes
  QUALIFY row_number() OVER (PARTITION BY coin_id, day ORDER BY inserted_at DESC) = 1
), daily_listings AS (
  SELECT * FROM listings
  QUALIFY row_number() OVER (PARTITION BY coin_id, day ORDER BY inserted_at DESC) = 1
)"""

OVERVIEW_SQL = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY market_cap DESC NULLS LAST, coin_id) AS place
  FROM daily_quotes
), overview AS (
  SELECT day::VARCHAR AS snapshot_date,
         sum(market_cap)::DOUBLE AS total_market_cap, sum(volume_24h)::DOUBLE AS total_volume_24h,
         sum(cex_volume_24h)::DOUBLE AS total_cex_volume_24h, sum(dex_volume_24h)::DOUBLE AS total_dex_volume_24h,
         sum(dex_volume_24h)::DOUBLE / nullif((sum(cex_volume_24h) + sum(dex_volume_24h))::DOUBLE, 0)
           AS dex_volume_share,
         max(CASE WHEN coin_id = 1 THEN market_cap_dominance_pct END)::DOUBLE AS btc_dominance_pct,
         sum(CASE WHEN place <= 10 THEN market_cap END)::DOUBLE / nullif(sum(market_cap)::DOUBLE, 0)
           AS top10_market_cap_share,
         count(*) AS num_coins
  FROM ranked GROUP BY day
)"""

EXPLORER_SQL = """
explorer AS (
  SELECT f.coin_id, coin_name, coin_symbol, coin_slug, logo_url, cmc_rank::BIGINT AS cmc_rank,
         price::DOUBLE AS price, percent_change_1h::DOUBLE AS percent_change_1h,
         percent_change_24h::DOUBLE AS percent_change_24h, percent_change_7d::DOUBLE AS percent_change_7d,
         percent_change_30d::DOUBLE AS percent_change_30d, percent_change_60d::DOUBLE AS percent_change_60d,
         percent_change_90d::DOUBLE AS percent_change_90d, market_cap::DOUBLE AS market_cap,
         market_cap_dominance_pct::DOUBLE AS market_cap_dominance_pct, volume_24h::DOUBLE AS volume_24h,
         volume_change_24h_pct::DOUBLE AS volume_change_24h_pct, cex_volume_24h::DOUBLE AS cex_volume_24h,
         dex_volume_24h::DOUBLE AS dex_volume_24h, fully_diluted_market_cap::DOUBLE AS fully_diluted_market_cap,
         fully_diluted_market_cap::DOUBLE / nullif(market_cap::DOUBLE, 0) AS fdv_mc_ratio,
         circulating_supply::DOUBLE AS circulating_supply, total_supply::DOUBLE AS total_supply,
         max_supply::DOUBLE AS max_supply, is_infinite_supply,
         CASE WHEN is_infinite_supply THEN NULL
              ELSE circulating_supply::DOUBLE / nullif(max_supply::DOUBLE, 0) END AS supply_utilization,
         tvl::DOUBLE AS tvl, NULL::DOUBLE AS tvl_ratio,
         market_cap::DOUBLE / nullif(tvl::DOUBLE, 0) AS mc_tvl_ratio, num_market_pairs::BIGINT AS num_market_pairs,
         date_added_at, date_added_at >= TIMESTAMP '2024-02-03' - INTERVAL 90 DAY AS is_new_coin_90d,
         inserted_at AS last_updated_at
  FROM fact f LEFT JOIN dim_coins d ON d.coin_id = f.coin_id
)"""

SECTORS_SQL = """
sectors AS (
  SELECT category_id, any_value(category_name) AS category_name, any_value(category_title) AS category_title,
         count(*) AS num_coins, sum(f.market_cap)::DOUBLE AS market_cap, sum(f.volume_24h)::DOUBLE AS volume_24h,
         sum(percent_change_24h)::DOUBLE / nullif(count(percent_change_24h), 0) AS avg_change_24h_pct,
         sum(percent_change_7d)::DOUBLE / nullif(count(percent_change_7d), 0) AS avg_change_7d_pct,
         sum(percent_change_30d)::DOUBLE / nullif(count(percent_change_30d), 0) AS avg_change_30d_pct,
         sum(tvl)::DOUBLE AS tvl, sum(f.market_cap)::DOUBLE / nullif(sum(tvl)::DOUBLE, 0) AS mc_tvl_ratio
  FROM bridge b JOIN fact f ON f.coin_id = b.coin_id JOIN dim_categories c USING (category_id)
  GROUP BY category_id
)"""

MOMENTUM_SQL = """
moves AS (
  SELECT *, lag(cmc_rank) OVER seen AS before, lag(day) OVER seen AS day_before
  FROM daily_listings WINDOW seen AS (PARTITION BY coin_id ORDER BY day)
), momentum AS (
  SELECT m.day::VARCHAR AS snapshot_date, m.coin_id, coalesce(d.coin_name, q.coin_name) AS coin_name,
         coalesce(d.coin_symbol, q.coin_symbol) AS coin_symbol, m.cmc_rank::BIGINT AS cmc_rank,
         coalesce(before, m.cmc_rank)::BIGINT AS prev_cmc_rank,
         (coalesce(before, m.cmc_rank) - m.cmc_rank)::BIGINT AS rank_change, before IS NULL AS is_new_entry,
         day_before::VARCHAR AS prev_snapshot_date, price::DOUBLE AS price, market_cap::DOUBLE AS market_cap,
         volume_24h::DOUBLE AS volume_24h, percent_change_24h::DOUBLE AS percent_change_24h, date_added_at
  FROM moves m LEFT JOIN daily_quotes q ON q.coin_id = m.coin_id AND q.day = m.day
  LEFT JOIN dim_coins d ON d.coin_id = m.coin_id
)"""


def market_sql(select: str, *parts: str) -> str:
    return f"WITH {', '.join([STAGING_SQL, *parts])}\n{select}"
