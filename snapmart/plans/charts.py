"""Dashboard charts as queries over the marts. Limits are the charts' own row limits; every order
ends in a unique column, so a report does not depend on the order of rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.operators.latest import DAY, dated
from snapmart.operators.ranking import top_k, top_per_group

# Row limits and filters of the charts.
TOP_TABLE_ROWS = 100
BUBBLE_ROWS = 500
RATIO_ROWS = 20
VALUATION_ROWS = 50
TREEMAP_ROWS = 50
SECTOR_CHANGE_ROWS = 20
SECTOR_VOLUME_ROWS = 15
MOVER_ROWS = 20
VOLATILITY_ROWS = 20
MIN_MARKET_CAP = 100_000_000
HISTORY_RANK = 10

TREND_METRICS = (
    "total_market_cap",
    "total_volume_24h",
    "btc_dominance_pct",
    "top10_market_cap_share",
    "total_cex_volume_24h",
    "total_dex_volume_24h",
    "dex_volume_share",
)


def in_time_range(df: DataFrame, column: str, first: Column, last: Column) -> DataFrame:
    """Dashboard time filter, both ends included."""
    return df.where(F.col(column).between(first, last))


def days_between(df: DataFrame, first: date, last: date) -> DataFrame:
    return in_time_range(df, DAY, F.lit(first), F.lit(last))


def with_symbol(df: DataFrame, symbol: str) -> DataFrame:
    return df.where(F.col("coin_symbol") == symbol)


def overview_trend(overview: DataFrame, metrics: Sequence[str] = TREND_METRICS) -> DataFrame:
    """Trend lines: each metric by day."""
    return overview.groupBy(DAY).agg(*[F.max(m).alias(m) for m in metrics])


def overview_latest(
    overview: DataFrame, newest: Column | None = None, metrics: Sequence[str] = TREND_METRICS
) -> DataFrame:
    """Big numbers: the metrics of the newest day.

    ``newest`` gives that day where a cheaper relation knows it (see ``newest_day``); the filter then
    reaches the scan, and no other day is read.
    """
    day = overview.select(F.max(DAY)).scalar() if newest is None else newest
    return overview_trend(overview.where(F.col(DAY) == day), metrics)


def newest_day(stg: DataFrame) -> Column:
    """The newest day of a staging model, as a scalar."""
    return dated(stg, "inserted_at").select(F.max(DAY)).scalar()


def top_table(explorer: DataFrame) -> DataFrame:
    columns = ("cmc_rank", "coin_symbol", "coin_name", "price", "percent_change_1h", "percent_change_24h",
               "percent_change_7d", "percent_change_30d", "market_cap", "volume_24h")
    order = [F.col("cmc_rank").asc_nulls_last(), F.col("coin_id")]
    return top_k(explorer, order, TOP_TABLE_ROWS).select(*columns)


def _best_by_name(df: DataFrame, name: str, measure: str, rows: int) -> DataFrame:
    best = df.groupBy(name).agg(F.max(measure).alias(measure))
    return top_k(best, [F.col(measure).desc_nulls_last(), F.col(name)], rows)


def bubble_points(explorer: DataFrame) -> DataFrame:
    points = explorer.groupBy("coin_symbol").agg(
        F.max("market_cap").alias("market_cap"), F.max("volume_24h").alias("volume_24h")
    )
    return top_k(points, [F.col("market_cap").desc_nulls_last(), F.col("coin_symbol")], BUBBLE_ROWS)


def dilution_top(explorer: DataFrame, min_market_cap: float = MIN_MARKET_CAP) -> DataFrame:
    large = explorer.where(F.col("market_cap") > min_market_cap)
    return _best_by_name(large, "coin_symbol", "fdv_mc_ratio", RATIO_ROWS)


def utilization_top(explorer: DataFrame) -> DataFrame:
    finite = explorer.where(~F.col("is_infinite_supply") & F.col("max_supply").isNotNull())
    return _best_by_name(finite, "coin_symbol", "supply_utilization", RATIO_ROWS)


def cheapest_by_tvl(explorer: DataFrame) -> DataFrame:
    known = explorer.where(F.col("tvl").isNotNull())
    order = [F.col("mc_tvl_ratio").asc_nulls_last(), F.col("coin_id")]
    return top_k(known, order, VALUATION_ROWS).select("coin_symbol", "coin_name", "tvl", "market_cap", "mc_tvl_ratio")


def sector_top(sectors: DataFrame, measure: str, rows: int) -> DataFrame:
    """Treemap, performance and volume charts: categories with the greatest measure."""
    return _best_by_name(sectors, "category_name", measure, rows)


def sector_treemap(sectors: DataFrame) -> DataFrame:
    return sector_top(sectors, "market_cap", TREEMAP_ROWS)


def sector_change(sectors: DataFrame, period: str) -> DataFrame:
    return sector_top(sectors, f"avg_change_{period}_pct", SECTOR_CHANGE_ROWS)


def sector_volume(sectors: DataFrame) -> DataFrame:
    return sector_top(sectors, "volume_24h", SECTOR_VOLUME_ROWS)


def sector_table(sectors: DataFrame) -> DataFrame:
    columns = ("category_name", "num_coins", "market_cap", "avg_change_24h_pct", "mc_tvl_ratio")
    return sectors.select(*columns).orderBy(F.col("market_cap").desc_nulls_last(), "category_name")


def momentum_latest(momentum: DataFrame) -> DataFrame:
    """The newest day of the momentum mart. (``vw_coin_momentum_latest`` has the same rows for less work.)"""
    return momentum.where(F.col(DAY) == momentum.select(F.max(DAY)).scalar())


def rank_movers(latest: DataFrame, up: bool, rows: int = MOVER_ROWS) -> DataFrame:
    change = F.col("rank_change")
    order = [change.desc() if up else change.asc(), F.col("coin_id")]
    columns = ("coin_id", "coin_symbol", "coin_name", "cmc_rank", "prev_cmc_rank", "rank_change")
    return top_k(latest.where(change.isNotNull()), order, rows).select(*columns)


def both_movers(latest: DataFrame, rows: int = MOVER_ROWS) -> DataFrame:
    """Gainers and losers from one reading of the newest day, marked by ``side``."""
    change = F.col("rank_change")
    sides = F.array(
        F.struct(F.lit("gainers").alias("side"), (-change).alias("place")),
        F.struct(F.lit("losers").alias("side"), change.alias("place")),
    )
    columns = ("coin_id", "coin_symbol", "coin_name", "cmc_rank", "prev_cmc_rank", "rank_change")
    moved = latest.where(change.isNotNull()).select(F.explode(sides).alias("_s"), *columns).select("_s.*", *columns)
    return top_per_group(moved, ["side"], [F.col("place"), F.col("coin_id")], rows).drop("place")


def new_entries(latest: DataFrame) -> DataFrame:
    columns = (DAY, "coin_id", "coin_symbol", "coin_name", "cmc_rank", "market_cap", "date_added_at")
    return latest.where("is_new_entry").select(*columns).orderBy(F.col("cmc_rank").asc_nulls_last(), "coin_id")


def rank_history(momentum: DataFrame, max_rank: int = HISTORY_RANK) -> DataFrame:
    """Inverted rank per day and symbol, so that rank 1 is drawn on top."""
    leaders = momentum.where(F.col("cmc_rank") <= max_rank)
    return leaders.groupBy(DAY, "coin_symbol").agg((-F.min("cmc_rank")).alias("inverted_rank"))


def volatility_top(momentum: DataFrame) -> DataFrame:
    """Sample deviation of the daily change per symbol over all days; null for a single day."""
    spread = momentum.groupBy("coin_symbol").agg(F.stddev_samp("percent_change_24h").alias("volatility"))
    return top_k(spread, [F.col("volatility").desc_nulls_last(), F.col("coin_symbol")], VOLATILITY_ROWS)


def new_coin_performance(explorer: DataFrame) -> DataFrame:
    columns = ("coin_id", "coin_symbol", "coin_name", "date_added_at", "percent_change_30d", "market_cap", "cmc_rank")
    recent = explorer.where("is_new_coin_90d").select(*columns)
    return recent.orderBy(F.col("percent_change_30d").desc_nulls_last(), "coin_id")
