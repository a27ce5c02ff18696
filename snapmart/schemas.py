"""Record, staging and result schemas of the market data sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

# Names and types of the six staging tables.
STAGING_DDL = {
    "listings_latest": """
        id BIGINT, infinite_supply BOOLEAN, circulating_supply DECIMAL(30,4), total_supply DECIMAL(30,4),
        max_supply DECIMAL(30,4), date_added TIMESTAMP_NTZ, num_market_pairs INT, cmc_rank INT,
        last_updated TIMESTAMP_NTZ, tvl_ratio DECIMAL(20,6), self_reported_circulating_supply DECIMAL(30,4),
        self_reported_market_cap DECIMAL(30,4), minted_market_cap DECIMAL(30,4), inserted_at TIMESTAMP_NTZ""",
    "quotes": """
        id BIGINT, name VARCHAR(100), symbol VARCHAR(20), slug VARCHAR(100), is_fiat SMALLINT, quote_id BIGINT,
        quote_symbol VARCHAR(20), quote_price DECIMAL(30,10), quote_volume_24h DECIMAL(30,4),
        quote_volume_change_24h DECIMAL(20,6), quote_cex_volume_24h DECIMAL(30,4),
        quote_dex_volume_24h DECIMAL(30,4), quote_percent_change_1h DECIMAL(20,6),
        quote_percent_change_24h DECIMAL(20,6), quote_percent_change_7d DECIMAL(20,6),
        quote_percent_change_30d DECIMAL(20,6), quote_percent_change_60d DECIMAL(20,6),
        quote_percent_change_90d DECIMAL(20,6), quote_market_cap DECIMAL(30,4),
        quote_market_cap_dominance DECIMAL(20,6), quote_fully_diluted_market_cap DECIMAL(30,4),
        quote_minted_market_cap DECIMAL(30,4), quote_tvl DECIMAL(30,4), quote_last_updated TIMESTAMP_NTZ,
        inserted_at TIMESTAMP_NTZ""",
    "categories": """
        id VARCHAR(50), name VARCHAR(100), title VARCHAR(150), description STRING, volume DECIMAL(30,4),
        num_tokens INT, avg_price_change DECIMAL(20,6), market_cap DECIMAL(30,4),
        market_cap_change DECIMAL(20,6), volume_change DECIMAL(20,6), last_updated TIMESTAMP_NTZ,
        inserted_at TIMESTAMP_NTZ""",
    "category_details": """
        id VARCHAR(50), name VARCHAR(100), title VARCHAR(150), description STRING, volume DECIMAL(30,4),
        num_tokens INT, last_updated TIMESTAMP_NTZ, avg_price_change DECIMAL(20,6), market_cap DECIMAL(30,4),
        market_cap_change DECIMAL(20,6), volume_change DECIMAL(20,6), coins_id BIGINT,
        inserted_at TIMESTAMP_NTZ""",
    "map": """
        id BIGINT, name VARCHAR(100), symbol VARCHAR(20), slug VARCHAR(100), is_active SMALLINT,
        first_historical_data TIMESTAMP_NTZ, last_historical_data TIMESTAMP_NTZ""",
    "info": """
        id BIGINT, category VARCHAR(100), description STRING, logo VARCHAR(255), date_launched TIMESTAMP_NTZ""",
}

# The fields of one USD quote, in payload order.
USD_FIELDS = (
    "price",
    "volume_24h",
    "volume_change_24h",
    "cex_volume_24h",
    "dex_volume_24h",
    "percent_change_1h",
    "percent_change_24h",
    "percent_change_7d",
    "percent_change_30d",
    "percent_change_60d",
    "percent_change_90d",
    "market_cap",
    "market_cap_dominance",
    "fully_diluted_market_cap",
    "tvl",
    "last_updated",
)

# Constants of a derived quote record.
USD_QUOTE_ID = 2781
USD_SYMBOL = "USD"

# Record fields that are read from each payload. Numbers are read as text, which keeps every digit
# for the cast to decimal; fields that are not named here are skipped by the JSON parser.
_CATEGORY_RECORD = """
    id STRING, name STRING, title STRING, description STRING, volume STRING, num_tokens STRING,
    avg_price_change STRING, market_cap STRING, market_cap_change STRING, volume_change STRING,
    last_updated STRING"""
_QUOTE_ITEM = "id: BIGINT, symbol: STRING, minted_market_cap: STRING, " + ", ".join(
    f"{field}: STRING" for field in USD_FIELDS
)

RECORD_DDL = {
    "listings_latest": """
        id BIGINT, name STRING, symbol STRING, slug STRING, infinite_supply BOOLEAN, circulating_supply STRING,
        total_supply STRING, max_supply STRING, date_added STRING, num_market_pairs STRING, cmc_rank STRING,
        last_updated STRING, tvl_ratio STRING, self_reported_circulating_supply STRING,
        self_reported_market_cap STRING, minted_market_cap STRING, quote STRUCT<USD: MAP<STRING, STRING>>""",
    "quotes": f"""
        id BIGINT, name STRING, symbol STRING, slug STRING, is_fiat SMALLINT,
        quote ARRAY<STRUCT<{_QUOTE_ITEM}>>""",
    "categories": _CATEGORY_RECORD,
    "category_details": f"{_CATEGORY_RECORD}, coins ARRAY<STRUCT<id: BIGINT>>",
    "map": """
        id BIGINT, name STRING, symbol STRING, slug STRING, is_active SMALLINT, first_historical_data STRING,
        last_historical_data STRING""",
    "info": "id BIGINT, category STRING, description STRING, logo STRING, date_launched STRING",
}


def record_schema(name: str) -> StructType:
    return StructType.fromDDL(RECORD_DDL[name])


@dataclass(frozen=True)
class DataSet:
    """How one landed payload becomes a staging table."""

    name: str
    cadence: str
    keyed: bool = False
    explode: str | None = None
    keys: tuple[str, ...] = ("id",)
    historical: bool = True


DATASETS = {
    d.name: d
    for d in (
        DataSet("listings_latest", "daily"),
        DataSet("quotes", "daily", explode="quote"),
        DataSet("categories", "weekly"),
        DataSet("category_details", "weekly", explode="coins", keys=("id", "coins_id")),
        DataSet("map", "monthly", historical=False),
        DataSet("info", "monthly", keyed=True, historical=False),
    )
}


def datasets_of(group: str | None) -> list[DataSet]:
    """The data sets of one cadence group, or all of them for None."""
    groups = {d.cadence for d in DATASETS.values()}
    if group is not None and group not in groups:
        raise ValueError(f"unknown group {group!r}; expected one of {sorted(groups)}")
    return [d for d in DATASETS.values() if group in (None, d.cadence)]
