"""Marts over the star schema and the staging history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import day_of, ratio, within_days
from snapmart.operators.joins import enrich, scoped_latest
from snapmart.operators.latest import DAY, dated, latest_per_key, latest_per_key_day
from snapmart.operators.ranking import top_per_group, with_previous
from snapmart.plans.core import rows_of

LEAD_COIN = 1  # fixed value: the coin whose dominance is reported
TOP_COINS = 10  # fixed value: the coins of the top share
NEW_COIN_DAYS = 90  # fixed value: age limit of a new coin


def market_overview_daily(stg_quotes: DataFrame) -> DataFrame:
    """Whole-market totals per day over the newest quote of each coin and day.

    Day totals are a plain aggregate. The top coins of a day come from a bounded rank, so a day is
    never gathered in one task; both small results meet on the day. The two branches share one scan
    and shuffle of the history.
    """
    amounts = ("market_cap", "volume_24h", "cex_volume_24h", "dex_volume_24h")
    rows = rows_of(
        stg_quotes, "coin_id", "inserted_at", "last_updated_at", "market_cap_dominance_pct", *amounts
    )
    ties = ["last_updated_at", "market_cap"]
    daily = latest_per_key_day(rows, ["coin_id"], "inserted_at", ties, whole_rows=True)
    totals = daily.groupBy(DAY).agg(
        *[F.sum(c).alias(f"total_{c}") for c in amounts],
        F.max(F.when(F.col("coin_id") == LEAD_COIN, F.col("market_cap_dominance_pct"))).alias("btc_dominance_pct"),
        F.count("*").alias("num_coins"),
    )
    leaders = top_per_group(daily, [DAY], [F.col("market_cap").desc_nulls_last(), F.col("coin_id")], TOP_COINS)
    top = leaders.groupBy(F.col(DAY).alias("_day")).agg(F.sum("market_cap").alias("_top"))
    both = F.col("total_cex_volume_24h") + F.col("total_dex_volume_24h")
    return totals.join(top, F.col(DAY).eqNullSafe(F.col("_day")), "left").select(
        DAY,
        *[f"total_{c}" for c in amounts],
        ratio("total_dex_volume_24h", both).alias("dex_volume_share"),
        "btc_dominance_pct",
        ratio("_top", "total_market_cap").alias("top10_market_cap_share"),
        "num_coins",
    )


def coin_explorer(fact: DataFrame, dim_coins: DataFrame, as_of: datetime) -> DataFrame:
    """Current state per coin with names and ratios."""
    names = dim_coins.select("coin_id", "coin_name", "coin_symbol", "coin_slug", "logo_url")
    utilization = F.when(F.col("is_infinite_supply"), F.lit(None).cast("double")).otherwise(
        ratio("circulating_supply", "max_supply")
    )
    return enrich(fact, names, "coin_id").select(
        "coin_id", "coin_name", "coin_symbol", "coin_slug", "logo_url", "cmc_rank", "price",
        "percent_change_1h", "percent_change_24h", "percent_change_7d", "percent_change_30d",
        "percent_change_60d", "percent_change_90d", "market_cap", "market_cap_dominance_pct", "volume_24h",
        "volume_change_24h_pct", "cex_volume_24h", "dex_volume_24h", "fully_diluted_market_cap",
        ratio("fully_diluted_market_cap", "market_cap").alias("fdv_mc_ratio"),
        "circulating_supply", "total_supply", "max_supply", "is_infinite_supply",
        utilization.alias("supply_utilization"),
        "tvl", "tvl_ratio",
        ratio("market_cap", "tvl").alias("mc_tvl_ratio"),
        "num_market_pairs", "date_added_at",
        within_days("date_added_at", as_of, NEW_COIN_DAYS).alias("is_new_coin_90d"),
        "last_updated_at",
    )


def sector_performance(bridge: DataFrame, fact: DataFrame, dim_categories: DataFrame) -> DataFrame:
    """Aggregates per category over its tracked coins; a category without any is absent.

    The bridge is aggregated per category before the category names are joined, so a category that
    holds a large part of the pairs is combined on the map side.
    """
    changes = ("24h", "7d", "30d")
    measures = fact.select(
        "coin_id", "market_cap", "volume_24h", "tvl", *[f"percent_change_{p}" for p in changes]
    )
    sums = (
        bridge.select("category_id", "coin_id")
        .join(measures, on=["coin_id"])
        .groupBy("category_id")
        .agg(
            F.count("*").alias("num_coins"),
            F.sum("market_cap").alias("market_cap"),
            F.sum("volume_24h").alias("volume_24h"),
            *[
                ratio(F.sum(f"percent_change_{p}"), F.count(f"percent_change_{p}")).alias(f"avg_change_{p}_pct")
                for p in changes
            ],
            F.sum("tvl").alias("tvl"),
        )
    )
    names = dim_categories.select("category_id", "category_name", "category_title")
    return sums.join(names, on=["category_id"]).select(
        "category_id", "category_name", "category_title", "num_coins", "market_cap", "volume_24h",
        *[f"avg_change_{p}_pct" for p in changes],
        "tvl",
        ratio("market_cap", "tvl").alias("mc_tvl_ratio"),
    )


LISTING_COLUMNS = ("coin_id", "inserted_at", "cmc_rank", "date_added_at", "last_updated_at")
LISTING_TIES = ("last_updated_at", "cmc_rank")
QUOTE_COLUMNS = ("coin_name", "coin_symbol", "price", "market_cap", "volume_24h", "percent_change_24h")
QUOTE_TIES = ("last_updated_at", "market_cap")
MOMENTUM_COLUMNS = (
    "cmc_rank", "prev_cmc_rank", "rank_change", "is_new_entry", f"prev_{DAY}", "price", "market_cap", "volume_24h",
    "percent_change_24h", "date_added_at",
)


def _named(moves: DataFrame, dim_coins: DataFrame) -> DataFrame:
    """Names from the dimension, or from the day's quote for coins it does not hold yet."""
    names = dim_coins.select("coin_id", "coin_name", "coin_symbol").alias("d")
    return moves.alias("q").join(names, on=["coin_id"], how="left").select(
        DAY,
        "coin_id",
        F.coalesce("d.coin_name", "q.coin_name").alias("coin_name"),
        F.coalesce("d.coin_symbol", "q.coin_symbol").alias("coin_symbol"),
        *MOMENTUM_COLUMNS,
    )


def coin_momentum_daily(stg_listings: DataFrame, stg_quotes: DataFrame, dim_coins: DataFrame) -> DataFrame:
    """Rank movement per coin and day against the coin's previous appearance."""
    listing_rows = rows_of(stg_listings, *LISTING_COLUMNS)
    quote_rows = rows_of(stg_quotes, "coin_id", "inserted_at", "last_updated_at", *QUOTE_COLUMNS)
    listed = latest_per_key_day(listing_rows, ["coin_id"], "inserted_at", LISTING_TIES)
    quoted = latest_per_key_day(quote_rows, ["coin_id"], "inserted_at", QUOTE_TIES)
    # Both sides are hash-partitioned by coin and day already, so this join adds no shuffle.
    priced = listed.join(quoted.drop("inserted_at", "last_updated_at"), on=["coin_id", DAY], how="left")
    return _named(with_previous(priced, ["coin_id"], DAY, "cmc_rank"), dim_coins)


def coin_momentum_latest(stg_listings: DataFrame, stg_quotes: DataFrame, dim_coins: DataFrame) -> DataFrame:
    """The newest day of ``coin_momentum_daily``, without ranking the days before it.

    A coin's previous appearance is its newest row before that day, and only the coins of the newest day
    are looked for in the earlier history.
    """
    listings = dated(rows_of(stg_listings, *LISTING_COLUMNS), "inserted_at")
    quotes = dated(rows_of(stg_quotes, "coin_id", "inserted_at", "last_updated_at", *QUOTE_COLUMNS), "inserted_at")
    day, newest = F.col(DAY), listings.select(F.max(DAY)).scalar()
    listed = latest_per_key(listings.where(day == newest), ["coin_id"], "inserted_at", LISTING_TIES)
    quoted = latest_per_key(quotes.where(day == newest), ["coin_id"], "inserted_at", QUOTE_TIES)
    earlier = listings.where(day < newest)
    if DAY not in stg_listings.columns:
        earlier = earlier.drop(DAY)  # only a stored day prunes partitions
    seen = scoped_latest(earlier, listed, "coin_id", ["coin_id"], "inserted_at", LISTING_TIES)
    previous = seen.select("coin_id", F.col("cmc_rank").alias("_before"), day_of("inserted_at").alias(f"prev_{DAY}"))
    rank, before = F.col("cmc_rank"), F.col("_before")
    moves = (
        listed.join(quoted.drop("inserted_at", "last_updated_at", DAY), on=["coin_id"], how="left")
        .join(previous, on=["coin_id"], how="left")
        .withColumn("prev_cmc_rank", F.coalesce(before, rank))
        .withColumn("rank_change", F.col("prev_cmc_rank") - rank)
        .withColumn("is_new_entry", before.isNull())
    )
    return _named(moves, dim_coins)
