"""Declarative data checks: all checks of a table partition are read off one aggregate row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import escape_markup, hours_between, moment
from snapmart.operators.aggregates import duplicate_keys, duplicate_values, joined_names
from snapmart.operators.history import STAMP
from snapmart.operators.joins import orphans
from snapmart.operators.latest import latest_batch
from snapmart.operators.ranking import top_k, top_per_group

WHOLE = "all"
LATEST = "latest"


@dataclass(frozen=True)
class Check:
    """One rule. ``kind`` is one of rows_above, rows_between, missing_count, missing_percent_below,
    minimum, fresh_within (hours) and unique (``columns`` is the key)."""

    kind: str
    columns: tuple[str, ...] = ()
    limit: float = 0
    upper: float | None = None
    partition: str = WHOLE

    @property
    def name(self) -> str:
        column = ", ".join(self.columns)
        return {
            "rows_above": f"row_count > {self.limit:g}",
            "rows_between": f"row_count between {self.limit:.15g} and {self.upper or 0:.15g}",
            "missing_count": f"missing_count({column}) = 0",
            "missing_percent_below": f"missing_percent({column}) < {self.limit:g}%",
            "minimum": f"min({column}) >= {self.limit:g}",
            "fresh_within": f"freshness({column}) <= {self.limit:g}h",
            "unique": f"{' + '.join(self.columns)} should be unique",
        }[self.kind]


def rows_above(limit: int = 0, partition: str = WHOLE) -> Check:
    return Check("rows_above", (), limit, partition=partition)


def rows_between(low: int, high: int, partition: str = LATEST) -> Check:
    return Check("rows_between", (), low, high, partition)


def no_missing(*columns: str, partition: str = WHOLE) -> list[Check]:
    return [Check("missing_count", (c,), partition=partition) for c in columns]


def missing_below(percent: float, *columns: str, partition: str = WHOLE) -> list[Check]:
    return [Check("missing_percent_below", (c,), percent, partition=partition) for c in columns]


def at_least(limit: float, *columns: str, partition: str = WHOLE) -> list[Check]:
    return [Check("minimum", (c,), limit, partition=partition) for c in columns]


def fresh_within(hours: int, column: str = STAMP, partition: str = WHOLE) -> Check:
    return Check("fresh_within", (column,), hours, partition=partition)


def unique(*columns: str, partition: str = LATEST) -> Check:
    return Check("unique", columns, partition=partition)


# The checks of the staging tables.
MARKET_CHECKS: dict[str, list[Check]] = {
    "categories": [
        rows_above(0),
        *no_missing("id"),
        fresh_within(24),
        *missing_below(15, "market_cap_change"),
        *at_least(0, "volume", "market_cap", "num_tokens"),
        rows_between(480, 520),
        *no_missing("id", partition=LATEST),
        unique("id", "inserted_at"),
    ],
    "category_details": [
        rows_above(0),
        fresh_within(216),
        *no_missing("id", "coins_id"),
        *missing_below(15, "market_cap_change"),
        *at_least(0, "volume", "market_cap", "num_tokens"),
        rows_between(56500, 62500),
        *no_missing("id", "coins_id", partition=LATEST),
        unique("id", "coins_id", "inserted_at"),
    ],
    "info": [rows_above(0), *missing_below(15, "date_launched")],
    "listings_latest": [
        rows_above(0),
        fresh_within(48),
        *no_missing(
            "id", "cmc_rank", "last_updated", "date_added", "num_market_pairs", "circulating_supply",
            "total_supply", "infinite_supply", "minted_market_cap", "inserted_at",
        ),
        *missing_below(50, "max_supply"),
        *missing_below(96, "tvl_ratio"),
        *missing_below(45, "self_reported_circulating_supply", "self_reported_market_cap"),
        rows_between(480, 520),
        *no_missing("id", "cmc_rank", partition=LATEST),
        unique("id", "inserted_at"),
    ],
    "quotes": [
        rows_above(0),
        fresh_within(48),
        *no_missing(
            "id", "name", "symbol", "slug", "is_fiat", "quote_id", "quote_symbol", "quote_volume_24h",
            "quote_volume_change_24h", "quote_cex_volume_24h", "quote_dex_volume_24h",
            "quote_percent_change_1h", "quote_percent_change_24h", "quote_percent_change_7d",
            "quote_percent_change_30d", "quote_percent_change_60d", "quote_percent_change_90d",
            "quote_market_cap_dominance", "quote_fully_diluted_market_cap", "quote_minted_market_cap",
            "quote_last_updated", "inserted_at",
        ),
        *missing_below(1, "quote_price", "quote_market_cap"),
        *missing_below(96, "quote_tvl"),
        rows_between(380, 420),
        *no_missing("id", "quote_id", partition=LATEST),
        unique("id", "quote_id", "inserted_at"),
    ],
}


def _measure(check: Check, as_of: Column) -> Column:
    """The aggregate a check is decided on."""
    if check.kind.startswith("rows"):
        return F.count("*")
    column = F.col(check.columns[0])
    if check.kind == "missing_count":
        return F.count_if(column.isNull())
    if check.kind == "missing_percent_below":
        return F.lit(100.0) * F.count_if(column.isNull()) / F.nullif(F.count("*"), F.lit(0))
    if check.kind == "minimum":
        return F.min(column)
    return hours_between(as_of, F.max(column))


def _passed(check: Check, measured: Column) -> Column:
    if check.kind == "rows_above":
        return measured > check.limit
    if check.kind == "rows_between":
        return measured.between(check.limit, check.upper)
    if check.kind == "missing_percent_below":
        return measured < check.limit
    if check.kind == "minimum":
        return measured >= check.limit
    if check.kind == "fresh_within":
        return measured <= check.limit
    return measured == 0


def _rows(profile: DataFrame, table: str, partition: str, checks: Sequence[Check], evaluated: Column) -> DataFrame:
    """One result row per check from a profile row with columns ``m0``, ``m1``, ..."""
    results = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(partition).alias("partition_name"),
            F.lit(check.name).alias("check_name"),
            F.lit(", ".join(check.columns)).alias("column_name"),
            F.col(f"m{i}").alias("measured"),
            F.when(_passed(check, F.col(f"m{i}")), "pass").otherwise("fail").alias("outcome"),
            evaluated.alias("evaluated_at"),
        )
        for i, check in enumerate(checks)
    ]
    return profile.select(F.inline(F.array(*results)))


def run_checks(
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, Sequence[Check]],
    as_of: datetime,
    at: str | Mapping[str, str] = STAMP,
    day: str | None = None,
    latest: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Results of all checks: one aggregate per table partition, one grouped count per uniqueness rule.

    ``at`` is the stamp that marks the latest partition (one name, or one per table); ``day`` the
    partition column of the histories, if they have one; ``latest`` the newest batches where they are known, as from
    ``newest_batches``. A check without a measure (empty table) fails. Nothing stops on failure: the result is a report.
    """
    now = moment(as_of)
    parts: list[DataFrame] = []
    for table, rules in checks.items():
        stamp_column = at if isinstance(at, str) else at.get(table, STAMP)
        for partition in dict.fromkeys(c.partition for c in rules):
            if partition == WHOLE:
                df = tables[table]
            elif table in (latest or {}):
                df = latest[table]
            else:
                df = latest_batch(tables[table], stamp_column, day)
            mine = [c for c in rules if c.partition == partition]
            simple = [c for c in mine if c.kind != "unique"]
            if simple:
                measures = [_measure(c, now).cast("double").alias(f"m{i}") for i, c in enumerate(simple)]
                parts.append(_rows(df.agg(*measures), table, partition, simple, now))
            for rule in (c for c in mine if c.kind == "unique"):
                groups = duplicate_keys(df, rule.columns).agg(F.count("*").cast("double").alias("m0"))
                parts.append(_rows(groups, table, partition, [rule], now))
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


#: So many failing rows of a check are reported.
FAILED_ROWS = 100

_ROW_KINDS = ("missing_count", "minimum")


def _key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def failing_rows(
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, Sequence[Check]],
    keys: Mapping[str, Sequence[str]],
    at: str | Mapping[str, str] = STAMP,
    day: str | None = None,
    limit: int = FAILED_ROWS,
) -> DataFrame:
    """The rows behind failed checks: table_name, partition_name, check_name, failing_key and row_count.

    For checks that a single row can fail (missing_count, minimum) the key of the row, as ``keys`` names its columns; for
    uniqueness the key that comes more than once, with its rows. Of each check the ``limit`` least keys, as text. All row
    checks of a table partition are one scan, and the limit holds in every task before rows are moved.
    """
    parts: list[DataFrame] = []
    for table, rules in checks.items():
        stamp_column = at if isinstance(at, str) else at.get(table, STAMP)
        for partition in dict.fromkeys(c.partition for c in rules):
            df = tables[table] if partition == WHOLE else latest_batch(tables[table], stamp_column, day)
            mine = [c for c in rules if c.partition == partition]
            by_row = [c for c in mine if c.kind in _ROW_KINDS]
            if by_row:
                failed = F.filter(F.array(*[F.when(_row_fails(c), F.lit(c.name)) for c in by_row]), lambda name: name.isNotNull())
                rows = df.select(_key_text(keys[table]).alias("failing_key"), F.explode(failed).alias("check_name"))
                rows = top_per_group(rows, ["check_name"], [F.col("failing_key")], limit)
                parts.append(_failing(rows.withColumn("row_count", F.lit(1).cast("bigint")), table, partition))
            for rule in (c for c in mine if c.kind == "unique"):
                groups = duplicate_keys(df, rule.columns).withColumn("failing_key", _key_text(rule.columns))
                groups = top_k(groups, [F.col("failing_key")], limit).withColumn("check_name", F.lit(rule.name))
                parts.append(_failing(groups, table, partition))
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


def _row_fails(check: Check) -> Column:
    column = F.col(check.columns[0])
    return column.isNull() if check.kind == "missing_count" else column < check.limit


def _failing(rows: DataFrame, table: str, partition: str) -> DataFrame:
    return rows.select(
        F.lit(table).alias("table_name"), F.lit(partition).alias("partition_name"), "check_name", "failing_key", "row_count"
    )


def offending_keys(models: Mapping[str, DataFrame]) -> DataFrame:
    """All keys that break a model test, as (model, test, failing_key): repeated values, references without a
    target, and repeated pairs of the bridge."""
    parts = [
        duplicate_values(models[m], c).select(F.lit(m).alias("model"), F.lit("unique").alias("test"), _key_text([c]).alias("failing_key"))
        for m, c in UNIQUE_COLUMNS
    ]
    for m, c, to in REFERENCES:
        lost = orphans(models[m], c, models[to], c).select(c).distinct()
        parts.append(lost.select(F.lit(m).alias("model"), F.lit("relationships").alias("test"), _key_text([c]).alias("failing_key")))
    pairs = duplicate_keys(models["bridge_category_coin"], BRIDGE_PAIR)
    names = F.lit("bridge_category_coin").alias("model"), F.lit("unique_pair").alias("test")
    parts.append(pairs.select(*names, _key_text(BRIDGE_PAIR).alias("failing_key")))
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


def alert_digest(results: DataFrame) -> DataFrame:
    """Failed checks per table as one escaped text; bounded by the number of declared checks."""
    failed = results.where(F.col("outcome") != "pass")
    digest = joined_names(failed, "table_name", "check_name")
    return digest.select("table_name", F.col("n_names").alias("n_failed"), escape_markup("names").alias("failed_checks"))


# Tested columns of the models, the models that hold the referenced keys, and the bridge's key.
UNIQUE_COLUMNS = (
    ("dim_coins", "coin_id"),
    ("dim_categories", "category_id"),
    ("fact_coin_market", "coin_id"),
    ("vw_market_overview_daily", "snapshot_date"),
    ("vw_coin_explorer", "coin_id"),
    ("vw_sector_performance", "category_id"),
)
REFERENCES = (
    ("fact_coin_market", "coin_id", "dim_coins"),
    ("bridge_category_coin", "category_id", "dim_categories"),
    ("bridge_category_coin", "coin_id", "dim_coins"),
)
BRIDGE_PAIR = ("category_id", "coin_id")


def model_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """Offending rows per model test: unique, not_null, relationships and the bridge's pair key."""
    filled_columns = [*UNIQUE_COLUMNS, ("bridge_category_coin", "category_id"), ("bridge_category_coin", "coin_id")]

    def result(df: DataFrame, model: str, test: str, column: str) -> DataFrame:
        return df.agg(F.count("*").alias("failures")).select(
            F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(column).alias("column_name"), "failures"
        )

    def column_tests(model: str, column: str) -> DataFrame:
        """Repeated values and nulls of a column, from one count per value."""
        counts = models[model].groupBy(column).agg(F.count("*").alias("n"))
        null = F.col(column).isNull()
        found = counts.agg(
            F.count(F.when(~null & (F.col("n") > 1), 1)).alias("repeated"),
            F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).alias("empty"),
        )
        tests = [F.struct(F.lit("not_null").alias("test"), F.col("empty").alias("failures"))]
        if (model, column) in UNIQUE_COLUMNS:
            tests.append(F.struct(F.lit("unique").alias("test"), F.col("repeated").alias("failures")))
        return found.select(F.explode(F.array(*tests)).alias("t")).select(
            F.lit(model).alias("model"), "t.test", F.lit(column).alias("column_name"), "t.failures"
        )

    parts = [column_tests(m, c) for m, c in filled_columns]
    parts += [result(orphans(models[m], c, models[to], c), m, "relationships", c) for m, c, to in REFERENCES]
    pairs = duplicate_keys(models["bridge_category_coin"], BRIDGE_PAIR)
    parts.append(result(pairs, "bridge_category_coin", "unique_pair", "+".join(BRIDGE_PAIR)))
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out
