"""The market models and charts over the given tables in their market roles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from snapmart.catalog.registry import Tables, query, ts_sql
from snapmart.catalog.roles import (
    EXPLORER_SQL,
    MOMENTUM_SQL,
    OVERVIEW_SQL,
    SECTORS_SQL,
    market_sql,
    models,
)
from snapmart.operators.joins import union_labelled
from snapmart.plans import charts

FACT_DOUBLES = (
    "circulating_supply", "total_supply", "max_supply", "minted_market_cap", "price", "volume_24h",
    "volume_change_24h_pct", "cex_volume_24h", "dex_volume_24h", "percent_change_1h", "percent_change_24h",
    "percent_change_7d", "percent_change_30d", "percent_change_60d", "percent_change_90d", "market_cap",
    "market_cap_dominance_pct", "fully_diluted_market_cap", "tvl",
)


DIM_COINS_SQL = market_sql(
    f"""
SELECT coin_id, coin_name, coin_symbol, coin_slug, is_active, NULL::VARCHAR AS first_historical_data_at,
       NULL::VARCHAR AS last_historical_data_at, coin_category, coin_description, logo_url,
       {ts_sql("date_launched_at")} AS date_launched_at
FROM dim_coins"""
)


@query("dim_coins", DIM_COINS_SQL)
def dim_coins(t: Tables):
    return models(t)["dim_coins"]


@query(
    "dim_categories",
    market_sql(
        f"""
SELECT category_id, category_name, category_title, NULL::VARCHAR AS category_description, volume_24h, num_tokens,
       avg_price_change_pct, market_cap, market_cap_change_pct, volume_change_pct,
       {ts_sql("inserted_at")} AS last_updated_at, {ts_sql("inserted_at")} AS inserted_at
FROM dim_categories"""
    ),
)
def dim_categories(t: Tables):
    return models(t)["dim_categories"]


@query(
    "bridge",
    market_sql(
        f"""
SELECT category_id, coin_id, {ts_sql("inserted_at")} AS last_updated_at, {ts_sql("inserted_at")} AS inserted_at
FROM bridge"""
    ),
)
def bridge(t: Tables):
    return models(t)["bridge_category_coin"]


@query(
    "snapshot_join",
    market_sql(
        f"""
SELECT coin_id, is_infinite_supply, {", ".join(f"{c}::DOUBLE AS {c}" for c in FACT_DOUBLES)},
       {ts_sql("date_added_at")} AS date_added_at, num_market_pairs::BIGINT AS num_market_pairs,
       cmc_rank::BIGINT AS cmc_rank, NULL::DOUBLE AS tvl_ratio, NULL::DOUBLE AS self_reported_circulating_supply,
       NULL::DOUBLE AS self_reported_market_cap, {ts_sql("inserted_at")} AS last_updated_at,
       {ts_sql("inserted_at")} AS inserted_at
FROM fact"""
    ),
)
def fact_coin_market(t: Tables):
    return models(t)["fact_coin_market"]


@query("market_overview", market_sql("SELECT * FROM overview", OVERVIEW_SQL))
def market_overview(t: Tables):
    return models(t)["vw_market_overview_daily"]


@query(
    "overview_kpis",
    market_sql(
        """
SELECT 'latest' AS scope, snapshot_date, total_market_cap, total_volume_24h, btc_dominance_pct,
       top10_market_cap_share, total_cex_volume_24h, total_dex_volume_24h, dex_volume_share
FROM overview JOIN (SELECT max(snapshot_date) AS snapshot_date FROM overview) USING (snapshot_date)
UNION ALL
SELECT 'trend', snapshot_date, total_market_cap, total_volume_24h, btc_dominance_pct,
       top10_market_cap_share, total_cex_volume_24h, total_dex_volume_24h, dex_volume_share
FROM overview""",
        OVERVIEW_SQL,
    ),
)
def overview_kpis(t: Tables):
    m = models(t)
    overview = m["vw_market_overview_daily"]
    latest = charts.overview_latest(overview, charts.newest_day(m["stg_quotes"]))
    return union_labelled([("latest", latest), ("trend", charts.overview_trend(overview))], label="scope")


@query(
    "entity_explorer",
    market_sql(
        f"""
SELECT * REPLACE ({ts_sql("date_added_at")} AS date_added_at, {ts_sql("last_updated_at")} AS last_updated_at)
FROM explorer""",
        EXPLORER_SQL,
    ),
)
def entity_explorer(t: Tables):
    return models(t)["vw_coin_explorer"]


@query("sector_performance", market_sql("SELECT * FROM sectors", SECTORS_SQL))
def sector_performance(t: Tables):
    return models(t)["vw_sector_performance"]


MOMENTUM_SELECT = f"SELECT * REPLACE ({ts_sql('date_added_at')} AS date_added_at) FROM momentum"


@query("momentum_daily", market_sql(MOMENTUM_SELECT, MOMENTUM_SQL))
def momentum_daily(t: Tables):
    return models(t)["vw_coin_momentum_daily"]


LATEST_DAY = "snapshot_date = (SELECT max(snapshot_date) FROM momentum)"


@query("momentum_latest", market_sql(f"{MOMENTUM_SELECT} WHERE {LATEST_DAY}", MOMENTUM_SQL))
def momentum_latest(t: Tables):
    return models(t)["vw_coin_momentum_latest"]


@query("momentum_newest_day", market_sql(f"{MOMENTUM_SELECT} WHERE {LATEST_DAY}", MOMENTUM_SQL))
def momentum_newest_day(t: Tables):
    """The same rows as a filter on the daily mart."""
    return charts.momentum_latest(models(t)["vw_coin_momentum_daily"])


@query(
    "rank_movers",
    market_sql(
        f"""
SELECT * FROM (
  SELECT 'gainers' AS side, coin_id, coin_symbol, coin_name, cmc_rank, prev_cmc_rank, rank_change
  FROM momentum WHERE {LATEST_DAY} ORDER BY rank_change DESC, coin_id LIMIT 20)
UNION ALL
SELECT * FROM (
  SELECT 'losers', coin_id, coin_symbol, coin_name, cmc_rank, prev_cmc_rank, rank_change
  FROM momentum WHERE {LATEST_DAY} ORDER BY rank_change, coin_id LIMIT 20)""",
        MOMENTUM_SQL,
    ),
)
def rank_movers(t: Tables):
    return charts.both_movers(models(t)["vw_coin_momentum_latest"])


@query(
    "new_entries",
    market_sql(
        f"""
SELECT snapshot_date, coin_id, coin_symbol, coin_name, cmc_rank, market_cap,
       {ts_sql("date_added_at")} AS date_added_at
FROM momentum WHERE is_new_entry AND {LATEST_DAY}""",
        MOMENTUM_SQL,
    ),
)
def new_entries(t: Tables):
    return charts.new_entries(models(t)["vw_coin_momentum_latest"])


@query(
    "rank_history",
    market_sql(
        """
SELECT snapshot_date, coin_symbol, -min(cmc_rank) AS inverted_rank FROM momentum
WHERE cmc_rank <= 10 GROUP BY ALL""",
        MOMENTUM_SQL,
    ),
)
def rank_history(t: Tables):
    return charts.rank_history(models(t)["vw_coin_momentum_daily"])


@query(
    "volatility_top",
    market_sql(
        """
SELECT coin_symbol, round(stddev_samp(percent_change_24h), 6) AS volatility FROM momentum
GROUP BY coin_symbol ORDER BY volatility DESC NULLS LAST, coin_symbol LIMIT 20""",
        MOMENTUM_SQL,
    ),
)
def volatility_top(t: Tables):
    top = charts.volatility_top(models(t)["vw_coin_momentum_daily"])
    return top.withColumn("volatility", F.round("volatility", 6))


@query(
    "top_table",
    market_sql(
        """
SELECT cmc_rank, coin_symbol, coin_name, price, percent_change_1h, percent_change_24h, percent_change_7d,
       percent_change_30d, market_cap, volume_24h
FROM explorer ORDER BY cmc_rank, coin_id LIMIT 100""",
        EXPLORER_SQL,
    ),
)
def top_table(t: Tables):
    return charts.top_table(models(t)["vw_coin_explorer"])


@query(
    "bubble_points",
    market_sql(
        """
SELECT coin_symbol, max(market_cap) AS market_cap, max(volume_24h) AS volume_24h FROM explorer
GROUP BY coin_symbol ORDER BY market_cap DESC NULLS LAST, coin_symbol LIMIT 500""",
        EXPLORER_SQL,
    ),
)
def bubble_points(t: Tables):
    return charts.bubble_points(models(t)["vw_coin_explorer"])


@query(
    "ratio_top",
    market_sql(
        """
SELECT * FROM (
  SELECT 'dilution' AS chart, coin_symbol, max(fdv_mc_ratio) AS ratio FROM explorer WHERE market_cap > 10000
  GROUP BY coin_symbol ORDER BY ratio DESC NULLS LAST, coin_symbol LIMIT 20)
UNION ALL
SELECT * FROM (
  SELECT 'utilization', coin_symbol, max(supply_utilization) AS ratio FROM explorer
  WHERE NOT is_infinite_supply AND max_supply IS NOT NULL
  GROUP BY coin_symbol ORDER BY ratio DESC NULLS LAST, coin_symbol LIMIT 20)""",
        EXPLORER_SQL,
    ),
)
def ratio_top(t: Tables):
    explorer = models(t)["vw_coin_explorer"]
    dilution = charts.dilution_top(explorer, min_market_cap=10_000).withColumnRenamed("fdv_mc_ratio", "ratio")
    utilization = charts.utilization_top(explorer).withColumnRenamed("supply_utilization", "ratio")
    return union_labelled([("dilution", dilution), ("utilization", utilization)], label="chart")


@query(
    "ratio_bottom",
    market_sql(
        """
SELECT coin_symbol, coin_name, tvl, market_cap, mc_tvl_ratio FROM explorer WHERE tvl IS NOT NULL
ORDER BY mc_tvl_ratio NULLS LAST, coin_id LIMIT 50""",
        EXPLORER_SQL,
    ),
)
def ratio_bottom(t: Tables):
    return charts.cheapest_by_tvl(models(t)["vw_coin_explorer"])


@query(
    "new_coin_performance",
    market_sql(
        f"""
SELECT coin_id, coin_symbol, coin_name, {ts_sql("date_added_at")} AS date_added_at, percent_change_30d,
       market_cap, cmc_rank
FROM explorer WHERE is_new_coin_90d""",
        EXPLORER_SQL,
    ),
)
def new_coin_performance(t: Tables):
    return charts.new_coin_performance(models(t)["vw_coin_explorer"])


@query(
    "sector_top",
    market_sql(
        """
SELECT * FROM (SELECT 'treemap' AS chart, category_name, market_cap AS measure FROM sectors
               ORDER BY measure DESC NULLS LAST, category_name LIMIT 50)
UNION ALL
SELECT * FROM (SELECT 'change_7d', category_name, avg_change_7d_pct AS measure FROM sectors
               ORDER BY measure DESC NULLS LAST, category_name LIMIT 20)
UNION ALL
SELECT * FROM (SELECT 'change_30d', category_name, avg_change_30d_pct AS measure FROM sectors
               ORDER BY measure DESC NULLS LAST, category_name LIMIT 20)
UNION ALL
SELECT * FROM (SELECT 'volume', category_name, volume_24h AS measure FROM sectors
               ORDER BY measure DESC NULLS LAST, category_name LIMIT 15)""",
        SECTORS_SQL,
    ),
)
def sector_top(t: Tables):
    sectors = models(t)["vw_sector_performance"]
    parts = {
        "treemap": charts.sector_treemap(sectors),
        "change_7d": charts.sector_change(sectors, "7d"),
        "change_30d": charts.sector_change(sectors, "30d"),
        "volume": charts.sector_volume(sectors),
    }
    named = [
        (chart, df.select("category_name", F.col(df.columns[1]).cast("double").alias("measure")))
        for chart, df in parts.items()
    ]
    return union_labelled(named, label="chart")


@query(
    "sector_table",
    market_sql(
        "SELECT category_name, num_coins, market_cap, avg_change_24h_pct, mc_tvl_ratio FROM sectors", SECTORS_SQL
    ),
)
def sector_table(t: Tables):
    return charts.sector_table(models(t)["vw_sector_performance"])


@query(
    "time_range",
    market_sql(
        f"{MOMENTUM_SELECT} WHERE snapshot_date BETWEEN '2024-01-10' AND '2024-01-12' AND coin_symbol = 'S7'",
        MOMENTUM_SQL,
    ),
)
def time_range(t: Tables):
    momentum = models(t)["vw_coin_momentum_daily"]
    return charts.with_symbol(charts.days_between(momentum, date(2024, 1, 10), date(2024, 1, 12)), "S7")
