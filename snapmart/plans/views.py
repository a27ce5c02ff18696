"""The models as persistent views, so that any session of the catalog can ask for them by name.

The DataFrame models (``core``, ``marts``) are what jobs build on; a persistent view has to be SQL text. Each view reads
tables and views of the catalog by their full names and is created after those it reads. Ranks with a limit are cut on the
map side (WindowGroupLimit), and filters on the day reach the partitions of the staging tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from snapmart.operators.latest import DAY
from snapmart.plans import core
from snapmart.plans.marts import LEAD_COIN, MOMENTUM_COLUMNS, NEW_COIN_DAYS, QUOTE_COLUMNS, TOP_COINS
from snapmart.plans.staging import COLUMNS
from snapmart.schemas import DATASETS

Named = Callable[[str], str]


def newest(source: str, columns: Sequence[str], keys: Sequence[str], ties: Sequence[str], scope: str = "") -> str:
    """The newest row for each key, like ``latest_per_key``."""
    order = ", ".join(["inserted_at DESC NULLS FIRST", *[f"{c} DESC NULLS LAST" for c in ties]])
    place = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS place"
    return f"SELECT {', '.join(columns)} FROM (SELECT *, {place} FROM {source} {scope}) WHERE place = 1"


def share(top: str, bottom: str) -> str:
    return f"cast({top} AS double) / nullif(cast({bottom} AS double), 0.0D)"


def staging_view(name: str, table: str) -> str:
    day = [DAY] if DATASETS[name].historical else []
    return f"SELECT {', '.join([*COLUMNS[name], *day])} FROM {table}"


def view_sql(named: Named, as_of: datetime | None = None) -> dict[str, str]:
    """The text of each view that isn't a staging view, in the order of creation. ``named`` gives a model's full name;
    without ``as_of`` the age of coins is counted from the time of the query."""
    now = "localtimestamp()" if as_of is None else f"TIMESTAMP_NTZ '{as_of.replace(tzinfo=None).isoformat(sep=' ')}'"
    tracked = f"LEFT SEMI JOIN (SELECT coin_id AS known FROM {named('stg_map')}) ON coin_id = known"
    times = ("last_updated_at", "inserted_at")
    listing = newest(
        named("stg_listings_latest"), (*core.FACT_FROM_LISTINGS, *times), ["coin_id"], ["last_updated_at", "cmc_rank"], tracked
    )
    quote = newest(
        named("stg_quotes"), ("coin_id", *core.FACT_FROM_QUOTES, *times), ["coin_id"], ["last_updated_at", "market_cap"], tracked
    )
    by_day = ["coin_id", DAY]
    listed = newest(named("stg_listings_latest"), (*by_day, "cmc_rank", "date_added_at"), by_day, ["last_updated_at", "cmc_rank"])
    quoted = newest(named("stg_quotes"), (*by_day, *QUOTE_COLUMNS), by_day, ["last_updated_at", "market_cap"])
    amounts = ("market_cap", "volume_24h", "cex_volume_24h", "dex_volume_24h")
    daily = newest(named("stg_quotes"), (*by_day, *amounts, "market_cap_dominance_pct"), by_day, ["last_updated_at", "market_cap"])
    changes = ("24h", "7d", "30d")
    return {
        "int_coins": f"SELECT {', '.join(core.DIM_COINS)} FROM {named('stg_map')} LEFT JOIN {named('stg_info')} USING (coin_id)",
        "int_category_snapshot": newest(
            named("stg_categories"), core.DIM_CATEGORIES, ["category_id"], ["last_updated_at", "market_cap", "volume_24h"]
        ),
        "int_coin_market_snapshot": f"""
            SELECT coin_id, {", ".join(f"l.{c}" for c in core.FACT_FROM_LISTINGS[1:])},
                {", ".join(f"q.{c}" for c in core.FACT_FROM_QUOTES)},
                {", ".join(f"greatest(l.{c}, q.{c}) AS {c}" for c in times)}
            FROM ({listing}) l LEFT JOIN ({quote}) q USING (coin_id)""",
        "int_category_coin_bridge": newest(
            named("stg_category_details"), core.BRIDGE, ["category_id", "coin_id"], ["last_updated_at"], tracked
        ),
        "fact_coin_market": f"SELECT {', '.join(core.FACT)} FROM {named('int_coin_market_snapshot')}",
        "vw_market_overview_daily": f"""
            WITH daily AS ({daily}),
            totals AS (
                SELECT {DAY}, {", ".join(f"sum({c}) AS total_{c}" for c in amounts)},
                    max(CASE WHEN coin_id = {LEAD_COIN} THEN market_cap_dominance_pct END) AS btc_dominance_pct,
                    count(*) AS num_coins
                FROM daily GROUP BY {DAY}),
            leaders AS (
                SELECT {DAY} AS top_day, sum(market_cap) AS top FROM (
                    SELECT *, row_number() OVER (PARTITION BY {DAY} ORDER BY market_cap DESC NULLS LAST, coin_id) AS place
                    FROM daily) WHERE place <= {TOP_COINS} GROUP BY {DAY})
            SELECT {DAY}, {", ".join(f"total_{c}" for c in amounts)},
                {share("total_dex_volume_24h", "total_cex_volume_24h + total_dex_volume_24h")} AS dex_volume_share,
                btc_dominance_pct, {share("top", "total_market_cap")} AS top10_market_cap_share, num_coins
            FROM totals LEFT JOIN leaders ON {DAY} <=> top_day""",
        "vw_coin_explorer": f"""
            SELECT coin_id, coin_name, coin_symbol, coin_slug, logo_url, cmc_rank, price, percent_change_1h, percent_change_24h,
                percent_change_7d, percent_change_30d, percent_change_60d, percent_change_90d, market_cap,
                market_cap_dominance_pct, volume_24h, volume_change_24h_pct, cex_volume_24h, dex_volume_24h,
                fully_diluted_market_cap, {share("fully_diluted_market_cap", "market_cap")} AS fdv_mc_ratio,
                circulating_supply, total_supply, max_supply, is_infinite_supply,
                CASE WHEN is_infinite_supply THEN NULL ELSE {share("circulating_supply", "max_supply")} END AS supply_utilization,
                tvl, tvl_ratio, {share("market_cap", "tvl")} AS mc_tvl_ratio, num_market_pairs, date_added_at,
                date_added_at >= {now} - INTERVAL {NEW_COIN_DAYS} DAYS AS is_new_coin_90d, last_updated_at
            FROM {named("fact_coin_market")}
            LEFT JOIN (SELECT coin_id, coin_name, coin_symbol, coin_slug, logo_url FROM {named("dim_coins")}) USING (coin_id)""",
        "vw_sector_performance": f"""
            SELECT category_id, category_name, category_title, num_coins, market_cap, volume_24h,
                {", ".join(f"avg_change_{p}_pct" for p in changes)}, tvl, {share("market_cap", "tvl")} AS mc_tvl_ratio
            FROM (
                SELECT category_id, count(*) AS num_coins, sum(market_cap) AS market_cap, sum(volume_24h) AS volume_24h,
                    {", ".join(f"{share(f'sum(percent_change_{p})', f'count(percent_change_{p})')} AS avg_change_{p}_pct" for p in changes)},
                    sum(tvl) AS tvl
                FROM (SELECT category_id, coin_id FROM {named("bridge_category_coin")})
                JOIN {named("fact_coin_market")} USING (coin_id) GROUP BY category_id)
            JOIN (SELECT category_id, category_name, category_title FROM {named("dim_categories")}) USING (category_id)""",
        "vw_coin_momentum_daily": f"""
            WITH listed AS ({listed}), quoted AS ({quoted}),
            moves AS (
                SELECT q.*, coalesce(before, cmc_rank) AS prev_cmc_rank, coalesce(before, cmc_rank) - cmc_rank AS rank_change,
                    before IS NULL AS is_new_entry
                FROM (
                    SELECT *, lag(cmc_rank) OVER coin_days AS before, lag({DAY}) OVER coin_days AS prev_{DAY}
                    FROM listed LEFT JOIN quoted USING (coin_id, {DAY})
                    WINDOW coin_days AS (PARTITION BY coin_id ORDER BY {DAY} NULLS LAST)) q)
            SELECT {DAY}, coin_id, coalesce(d.coin_name, m.coin_name) AS coin_name,
                coalesce(d.coin_symbol, m.coin_symbol) AS coin_symbol, {", ".join(MOMENTUM_COLUMNS)}
            FROM moves m
            LEFT JOIN (SELECT coin_id, coin_name, coin_symbol FROM {named("dim_coins")}) d USING (coin_id)""",
        "vw_coin_momentum_latest": f"""
            SELECT * FROM {named("vw_coin_momentum_daily")}
            WHERE {DAY} = (SELECT max({DAY}) FROM {named("stg_listings_latest")})""",
    }


def create_views(spark: SparkSession, texts: dict[str, str], named: Named) -> None:
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {named(name)} AS {text}")
