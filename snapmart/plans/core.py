"""Star schema: two dimensions, the current-state fact and the category bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.operators.joins import enrich, scoped_latest
from snapmart.operators.latest import DAY, latest_per_key

# Output columns of the models, in order.
DIM_COINS = (
    "coin_id", "coin_name", "coin_symbol", "coin_slug", "is_active", "first_historical_data_at",
    "last_historical_data_at", "coin_category", "coin_description", "logo_url", "date_launched_at",
)
DIM_CATEGORIES = (
    "category_id", "category_name", "category_title", "category_description", "volume_24h", "num_tokens",
    "avg_price_change_pct", "market_cap", "market_cap_change_pct", "volume_change_pct", "last_updated_at",
    "inserted_at",
)
BRIDGE = ("category_id", "coin_id", "last_updated_at", "inserted_at")
FACT_FROM_LISTINGS = (
    "coin_id", "is_infinite_supply", "circulating_supply", "total_supply", "max_supply", "date_added_at",
    "num_market_pairs", "cmc_rank", "tvl_ratio", "self_reported_circulating_supply",
    "self_reported_market_cap", "minted_market_cap",
)
FACT_FROM_QUOTES = (
    "price", "volume_24h", "volume_change_24h_pct", "cex_volume_24h", "dex_volume_24h", "percent_change_1h",
    "percent_change_24h", "percent_change_7d", "percent_change_30d", "percent_change_60d",
    "percent_change_90d", "market_cap", "market_cap_dominance_pct", "fully_diluted_market_cap", "tvl",
)
FACT = (*FACT_FROM_LISTINGS, *FACT_FROM_QUOTES, "last_updated_at", "inserted_at")


def rows_of(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and the day of a stored history."""
    return df.select(*columns, *[c for c in df.columns if c == DAY])


def coins(stg_map: DataFrame, stg_info: DataFrame) -> DataFrame:
    """Coin dimension: every mapped coin, with its info where there is one."""
    return enrich(stg_map, stg_info, "coin_id").select(*DIM_COINS)


def categories(stg_categories: DataFrame) -> DataFrame:
    """Category dimension: the newest row per category."""
    rows = rows_of(stg_categories, *DIM_CATEGORIES)
    ties = ["last_updated_at", "market_cap", "volume_24h"]
    newest = latest_per_key(rows, ["category_id"], "inserted_at", ties, few_keys=True)
    return newest.select(*DIM_CATEGORIES)


def tracked_coins(stg_map: DataFrame) -> DataFrame:
    """The coin universe: the keys of the coin dimension."""
    return stg_map.select("coin_id")


def bridge(stg_category_details: DataFrame, tracked: DataFrame) -> DataFrame:
    """Category-coin pairs of tracked coins, newest row per pair."""
    rows = rows_of(stg_category_details, *BRIDGE)
    pair = ["category_id", "coin_id"]
    return scoped_latest(rows, tracked, "coin_id", pair, "inserted_at", ties=["last_updated_at"]).select(*BRIDGE)


def coin_market(stg_listings: DataFrame, stg_quotes: DataFrame, tracked: DataFrame) -> DataFrame:
    """Fact: the newest listing of each tracked coin, with its newest quote where there is one.

    Times are the later one of listing and quote. Each history is reduced to one row per coin
    before it meets the other, so that join has no hot keys.
    """
    times = ("last_updated_at", "inserted_at")
    listing_rows = rows_of(stg_listings, *FACT_FROM_LISTINGS, *times)
    quote_rows = rows_of(stg_quotes, "coin_id", *FACT_FROM_QUOTES, *times)

    def newest(rows: DataFrame, last_tie: str) -> DataFrame:
        return scoped_latest(rows, tracked, "coin_id", ["coin_id"], "inserted_at", ["last_updated_at", last_tie])

    listing, quote = newest(listing_rows, "cmc_rank").alias("l"), newest(quote_rows, "market_cap").alias("q")
    return listing.join(quote, on=["coin_id"], how="left").select(
        "coin_id",
        *[F.col(f"l.{c}") for c in FACT_FROM_LISTINGS[1:]],
        *[F.col(f"q.{c}") for c in FACT_FROM_QUOTES],
        *[F.greatest(f"l.{c}", f"q.{c}").alias(c) for c in times],
    )
