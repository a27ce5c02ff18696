"""Staging models: renamed and typed columns of the staging tables, nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame

from snapmart.operators.latest import DAY

# The select list of each staging model. A 0/1 number becomes a boolean.
COLUMNS = {
    "listings_latest": (
        "cast(id as bigint) as coin_id",
        "cast(infinite_supply as boolean) as is_infinite_supply",
        "circulating_supply as circulating_supply",
        "total_supply as total_supply",
        "max_supply as max_supply",
        "cast(date_added as timestamp_ntz) as date_added_at",
        "cast(num_market_pairs as int) as num_market_pairs",
        "cast(cmc_rank as int) as cmc_rank",
        "cast(last_updated as timestamp_ntz) as last_updated_at",
        "tvl_ratio as tvl_ratio",
        "self_reported_circulating_supply as self_reported_circulating_supply",
        "self_reported_market_cap as self_reported_market_cap",
        "minted_market_cap as minted_market_cap",
        "cast(inserted_at as timestamp_ntz) as inserted_at",
    ),
    "quotes": (
        "cast(id as bigint) as coin_id",
        "cast(name as string) as coin_name",
        "cast(symbol as string) as coin_symbol",
        "cast(slug as string) as coin_slug",
        "is_fiat = 1 as is_fiat",
        "cast(quote_id as bigint) as quote_currency_id",
        "cast(quote_symbol as string) as quote_currency_symbol",
        "quote_price as price",
        "quote_volume_24h as volume_24h",
        "quote_volume_change_24h as volume_change_24h_pct",
        "quote_cex_volume_24h as cex_volume_24h",
        "quote_dex_volume_24h as dex_volume_24h",
        "quote_percent_change_1h as percent_change_1h",
        "quote_percent_change_24h as percent_change_24h",
        "quote_percent_change_7d as percent_change_7d",
        "quote_percent_change_30d as percent_change_30d",
        "quote_percent_change_60d as percent_change_60d",
        "quote_percent_change_90d as percent_change_90d",
        "quote_market_cap as market_cap",
        "quote_market_cap_dominance as market_cap_dominance_pct",
        "quote_fully_diluted_market_cap as fully_diluted_market_cap",
        "quote_minted_market_cap as minted_market_cap",
        "quote_tvl as tvl",
        "cast(quote_last_updated as timestamp_ntz) as last_updated_at",
        "cast(inserted_at as timestamp_ntz) as inserted_at",
    ),
    "categories": (
        "cast(id as string) as category_id",
        "cast(name as string) as category_name",
        "cast(title as string) as category_title",
        "cast(description as string) as category_description",
        "volume as volume_24h",
        "cast(num_tokens as int) as num_tokens",
        "avg_price_change as avg_price_change_pct",
        "market_cap as market_cap",
        "market_cap_change as market_cap_change_pct",
        "volume_change as volume_change_pct",
        "cast(last_updated as timestamp_ntz) as last_updated_at",
        "cast(inserted_at as timestamp_ntz) as inserted_at",
    ),
    "category_details": (
        "cast(id as string) as category_id",
        "cast(name as string) as category_name",
        "cast(title as string) as category_title",
        "cast(description as string) as category_description",
        "volume as volume_24h",
        "cast(num_tokens as int) as num_tokens",
        "cast(last_updated as timestamp_ntz) as last_updated_at",
        "avg_price_change as avg_price_change_pct",
        "market_cap as market_cap",
        "market_cap_change as market_cap_change_pct",
        "volume_change as volume_change_pct",
        "cast(coins_id as bigint) as coin_id",
        "cast(inserted_at as timestamp_ntz) as inserted_at",
    ),
    "map": (
        "cast(id as bigint) as coin_id",
        "cast(name as string) as coin_name",
        "cast(symbol as string) as coin_symbol",
        "cast(slug as string) as coin_slug",
        "is_active = 1 as is_active",
        "cast(first_historical_data as timestamp_ntz) as first_historical_data_at",
        "cast(last_historical_data as timestamp_ntz) as last_historical_data_at",
    ),
    "info": (
        "cast(id as bigint) as coin_id",
        "cast(category as string) as coin_category",
        "cast(description as string) as coin_description",
        "cast(logo as string) as logo_url",
        "cast(date_launched as timestamp_ntz) as date_launched_at",
    ),
}


def staged(df: DataFrame, name: str) -> DataFrame:
    """The staging model of one table. Decimal columns keep their declared precision.

    The partition column of a stored history is carried along, so that marts can prune by day.
    """
    return df.selectExpr(*COLUMNS[name], *[c for c in df.columns if c == DAY])
