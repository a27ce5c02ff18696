"""Data checks and monitoring panels over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from snapmart.catalog.registry import Tables, query, ts_sql
from snapmart.catalog.roles import (
    AS_OF,
    CHECKED_COLUMNS,
    CHECKED_SQL,
    EXPLORER_SQL,
    OVERVIEW_SQL,
    SECTORS_SQL,
    market_sql,
    models,
    staging_roles,
)
from snapmart.operators.aggregates import duplicate_values
from snapmart.operators.joins import enrich, union_labelled
from snapmart.plans import panels, quality
from snapmart.plans.panels import Watched


def watched(t: Tables) -> dict[str, Watched]:
    return {
        "events": Watched(t["events"], "ts", ("user_id", "ts"), 48, (1, 10)),
        "lineitem": Watched(t["lineitem"], "l_shipdate", ("l_orderkey", "l_linenumber"), 192, (1, 10)),
        "orders": Watched(t["orders"], "o_orderdate", ("o_custkey", "o_orderdate"), 216, (2, 3)),
    }


STAMPS = {"events": "ts", "lineitem": "l_shipdate", "orders": "o_orderdate"}


@query(
    "freshness",
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, {ts_sql(f'max({at})')} AS last_inserted FROM {n}" for n, at in STAMPS.items()
    ),
)
def freshness(t: Tables):
    return panels.freshness(watched(t))


@query(
    "freshness_sla",
    f"""
SELECT table_name, {ts_sql("last")} AS last_inserted,
       round(((epoch_us(TIMESTAMP '2024-02-03') - epoch_us(last)) / 3600000000.0)::DECIMAL(20,6), 1)::DOUBLE
         AS hours_since_update,
       sla_hours, CASE WHEN TIMESTAMP '2024-02-03' - last > to_hours(sla_hours) THEN 'STALE' ELSE 'OK' END AS status
FROM (
  SELECT 'events' AS table_name, max(ts) AS last, 48::BIGINT AS sla_hours FROM events
  UNION ALL SELECT 'lineitem', max(l_shipdate), 192 FROM lineitem
  UNION ALL SELECT 'orders', max(o_orderdate), 216 FROM orders)""",
)
def freshness_sla(t: Tables):
    return panels.freshness_sla(watched(t), AS_OF)


def _newest(table: str, at: str) -> str:
    return f"{table} WHERE {at} = (SELECT max({at}) FROM {table})"


@query(
    "duplicate_status",
    f"""
SELECT *, CASE WHEN duplicate_groups = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM (
  SELECT 'events' AS table_name, count(*) AS duplicate_groups FROM (
    SELECT user_id, ts FROM {_newest("events", "ts")} GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'lineitem', count(*) FROM (
    SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'orders', count(*) FROM (
    SELECT o_custkey, o_orderdate FROM {_newest("orders", "o_orderdate")} GROUP BY ALL HAVING count(*) > 1))""",
)
def duplicate_status(t: Tables):
    tables = watched(t)
    whole = Watched(t["lineitem"], "l_shipdate", ("l_orderkey", "l_linenumber"), batched=False)
    return panels.duplicate_status({**tables, "lineitem": whole})


@query(
    "row_count_expected",
    "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS table_name, count(*) AS row_count, {low}::BIGINT AS expected_min,
       {high}::BIGINT AS expected_max,
       CASE WHEN count(*) BETWEEN {low} AND {high} THEN 'OK' ELSE 'OUT OF RANGE' END AS status
FROM {_newest(n, STAMPS[n])}"""
        for n, low, high in (("events", 1, 10), ("lineitem", 1, 10), ("orders", 2, 3))
    ),
)
def row_count_expected(t: Tables):
    return panels.batch_size_status(watched(t))


MISSING_SQL = "round((100 * count(*) FILTER (WHERE {c} IS NULL) / nullif(count(*), 0))::DECIMAL(20,8), 2)::DOUBLE"


def _missing_rows(table: str, relation: str, allowed: dict[str, int]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS table_name, '{c}' AS column_name, {MISSING_SQL.format(c=c)} AS missing_percent,
       {limit}::BIGINT AS threshold_percent,
       CASE WHEN {MISSING_SQL.format(c=c)} > {limit} THEN 'FAIL' ELSE 'OK' END AS status
FROM {relation}"""
        for c, limit in allowed.items()
    )


LABELLED = "(SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"
ALLOWED = {"doc_id": 0, "quality": 50, "toxic": 96}


@query(
    "missing_pct",
    _missing_rows("documents", LABELLED, ALLOWED)
    + "\nUNION ALL\n"
    + _missing_rows("part", "part", {"p_name": 0, "p_size": 15}),
)
def missing_pct(t: Tables):
    labelled = enrich(t["documents"].select("doc_id"), t["labels"], "doc_id")
    return panels.missing_status([("documents", labelled, ALLOWED), ("part", t["part"], {"p_name": 0, "p_size": 15})])


RUN_LOG = """
SELECT event_type AS job_id, CASE WHEN value > 10 THEN 'success' ELSE 'failed' END AS state, ts AS start_date,
       ts + to_minutes(floor(value::DECIMAL(18,2))::INT) AS end_date
FROM events"""


def run_log(t: Tables):
    """The event history as a run log: the type is the job, the value the minutes it took."""
    minutes = F.floor(F.col("value").cast("decimal(18,2)")).cast("int")
    return t["events"].select(
        F.col("event_type").alias("job_id"),
        F.when(F.col("value") > 10, "success").otherwise("failed").alias("state"),
        F.col("ts").alias("start_date"),
        (F.col("ts") + F.make_interval(mins=minutes)).alias("end_date"),
    )


@query(
    "latest_runs",
    f"""
SELECT job_id, state, {ts_sql("start_date")} AS start_date, {ts_sql("end_date")} AS end_date,
       round(((epoch_us(end_date) - epoch_us(start_date)) / 60000000.0)::DECIMAL(20,6), 1)::DOUBLE AS duration_minutes
FROM ({RUN_LOG}) r WHERE start_date = (SELECT max(ts) FROM events e WHERE e.event_type = r.job_id)""",
)
def latest_runs(t: Tables):
    return panels.latest_runs(run_log(t))


@query(
    "success_rate",
    f"""
SELECT job_id, count(*) AS total_runs,
       round((100 * count(*) FILTER (WHERE state = 'success') / count(*))::DECIMAL(20,8), 1)::DOUBLE AS success_rate_pct
FROM ({RUN_LOG})
WHERE start_date BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' GROUP BY job_id""",
)
def success_rate(t: Tables):
    return panels.run_success(run_log(t), datetime(2024, 1, 5), datetime(2024, 1, 25))


CHECKS = {
    "customer": [
        quality.rows_above(0),
        *quality.no_missing("c_custkey", "c_name"),
        *quality.at_least(0, "c_acctbal"),
        quality.unique("c_custkey", partition=quality.WHOLE),
    ],
    "documents": [
        *quality.missing_below(50, "quality"),
        *quality.missing_below(96, "toxic"),
        *quality.no_missing("quality"),
    ],
    "events": [
        quality.fresh_within(96, "ts"),
        quality.rows_between(1, 10),
        quality.unique("user_id", "ts"),
    ],
    "lineitem": [
        quality.rows_above(0),
        *quality.at_least(0, "l_quantity", "l_discount"),
        quality.unique("l_orderkey", "l_linenumber", partition=quality.WHOLE),
    ],
    "orders": [
        quality.fresh_within(48, "o_orderdate"),
        quality.rows_between(2, 3),
        *quality.no_missing("o_custkey", partition=quality.LATEST),
    ],
}


def _check_sql(table, partition, relation, name, column, measured, passed) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{partition}' AS partition_name, '{name}' AS check_name,\n"
        f"       '{column}' AS column_name, ({measured})::DOUBLE AS measured,\n"
        f"       CASE WHEN ({measured}) {passed} THEN 'pass' ELSE 'fail' END AS outcome,\n"
        f"       '2024-02-03 00:00:00.000000' AS evaluated_at FROM {relation}"
    )


def _nulls(column: str) -> str:
    return f"count(*) FILTER (WHERE {column} IS NULL)"


def _share(column: str) -> str:
    return f"100.0::DOUBLE * {_nulls(column)} / nullif(count(*), 0)"


def _age(column: str) -> str:
    return f"(epoch_us(TIMESTAMP '2024-02-03') - epoch_us(max({column}))) / 3600000000.0"


def _groups(relation: str, keys: str) -> str:
    return f"(SELECT {keys} FROM {relation} GROUP BY ALL HAVING count(*) > 1) g"


DQ_SQL = "\nUNION ALL\n".join(
    [
        _check_sql("customer", "all", "customer", "row_count > 0", "", "count(*)", "> 0"),
        _check_sql("customer", "all", "customer", "missing_count(c_custkey) = 0", "c_custkey", _nulls("c_custkey"), "= 0"),
        _check_sql("customer", "all", "customer", "missing_count(c_name) = 0", "c_name", _nulls("c_name"), "= 0"),
        _check_sql("customer", "all", "customer", "min(c_acctbal) >= 0", "c_acctbal", "min(c_acctbal)", ">= 0"),
        _check_sql(
            "customer", "all", _groups("customer", "c_custkey"), "c_custkey should be unique", "c_custkey", "count(*)", "= 0"
        ),
        _check_sql("documents", "all", LABELLED, "missing_percent(quality) < 50%", "quality", _share("quality"), "< 50"),
        _check_sql("documents", "all", LABELLED, "missing_percent(toxic) < 96%", "toxic", _share("toxic"), "< 96"),
        _check_sql("documents", "all", LABELLED, "missing_count(quality) = 0", "quality", _nulls("quality"), "= 0"),
        _check_sql("events", "all", "events", "freshness(ts) <= 96h", "ts", _age("ts"), "<= 96"),
        _check_sql("events", "latest", _newest("events", "ts"), "row_count between 1 and 10", "", "count(*)", "BETWEEN 1 AND 10"),
        _check_sql(
            "events", "latest", _groups(_newest("events", "ts"), "user_id, ts"), "user_id + ts should be unique",
            "user_id, ts", "count(*)", "= 0",
        ),
        _check_sql("lineitem", "all", "lineitem", "row_count > 0", "", "count(*)", "> 0"),
        _check_sql("lineitem", "all", "lineitem", "min(l_quantity) >= 0", "l_quantity", "min(l_quantity)", ">= 0"),
        _check_sql("lineitem", "all", "lineitem", "min(l_discount) >= 0", "l_discount", "min(l_discount)", ">= 0"),
        _check_sql(
            "lineitem", "all", _groups("lineitem", "l_orderkey, l_linenumber"),
            "l_orderkey + l_linenumber should be unique", "l_orderkey, l_linenumber", "count(*)", "= 0",
        ),
        _check_sql("orders", "all", "orders", "freshness(o_orderdate) <= 48h", "o_orderdate", _age("o_orderdate"), "<= 48"),
        _check_sql("orders", "latest", _newest("orders", "o_orderdate"), "row_count between 2 and 3", "", "count(*)", "BETWEEN 2 AND 3"),
        _check_sql(
            "orders", "latest", _newest("orders", "o_orderdate"), "missing_count(o_custkey) = 0", "o_custkey",
            _nulls("o_custkey"), "= 0",
        ),
    ]
)


def check_results(t: Tables):
    tables = {name: t[name] for name in CHECKS}
    tables["documents"] = enrich(t["documents"].select("doc_id"), t["labels"], "doc_id")
    return quality.run_checks(tables, CHECKS, AS_OF, at=STAMPS)


@query("dq_report", DQ_SQL)
def dq_report(t: Tables):
    return check_results(t)


@query(
    "alert_digest",
    f"""
SELECT table_name, count(*) AS n_failed,
       replace(replace(replace(string_agg(check_name, ', ' ORDER BY check_name), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
         AS failed_checks
FROM ({DQ_SQL}) WHERE outcome = 'fail' GROUP BY table_name""",
)
def alert_digest(t: Tables):
    return quality.alert_digest(check_results(t))


@query(
    "dq_unique",
    """
SELECT 'customer' AS table_name, count(*) AS failures FROM (
  SELECT c_custkey FROM customer GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY ALL HAVING count(*) > 1)""",
)
def dq_unique(t: Tables):
    counts = {"customer": "c_custkey", "lineitem": "l_orderkey"}
    return union_labelled(
        [(n, duplicate_values(t[n], c).agg(F.count("*").alias("failures"))) for n, c in counts.items()]
    )


@query(
    "dq_not_null",
    f"SELECT 'quality' AS column_name, {_nulls('quality')} AS failures FROM {LABELLED}",
)
def dq_not_null(t: Tables):
    labelled = enrich(t["documents"].select("doc_id"), t["labels"], "doc_id")
    return labelled.where(F.col("quality").isNull()).agg(F.count("*").alias("failures")).select(
        F.lit("quality").alias("column_name"), "failures"
    )


def _market_missing_sql() -> str:
    quote_nulls = {
        "quote_market_cap": "event_type = 'error'",
        "quote_percent_change_7d": "event_type = 'purchase'",
        "quote_tvl": "event_type = 'view'",
    }
    listing_nulls = {
        "infinite_supply": "event_type = 'click'",
        "max_supply": "event_type = 'signup'",
        "tvl_ratio": "true",
        "self_reported_circulating_supply": "true",
        "self_reported_market_cap": "true",
    }
    sector_nulls = {"market_cap_change": "l_returnflag = 'R'"}
    sources = {
        "categories": (_newest("lineitem", "l_shipdate"), sector_nulls),
        "category_details": (_newest("lineitem", "l_shipdate"), sector_nulls),
        "info": ("part", {"date_launched": "p_size <= 5"}),
        "listings_latest": (_newest("events", "ts"), listing_nulls),
        "quotes": (_newest("events", "ts"), quote_nulls),
    }
    rows = []
    for table, (relation, nulls) in sources.items():
        for column, limit in panels.allowed_missing(table).items():
            condition = nulls.get(column, "false")
            share = (
                f"round((100 * count(*) FILTER (WHERE {condition}) / nullif(count(*), 0))::DECIMAL(20,8), 2)::DOUBLE"
            )
            rows.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, {share} AS missing_percent, "
                f"{limit}::BIGINT AS threshold_percent, "
                f"CASE WHEN {share} > {limit} THEN 'FAIL' ELSE 'OK' END AS status FROM {relation}"
            )
    return "\nUNION ALL\n".join(rows)


@query("market_missing", _market_missing_sql())
def market_missing(t: Tables):
    """The 45-column missing-value panel over the staging tables in their roles."""
    return panels.market_missing_status(staging_roles(t))


def _market_checks_sql() -> str:
    """Every declared check as its own SELECT over the staging tables in their roles."""
    rows = []
    for table, checks in quality.MARKET_CHECKS.items():
        known = CHECKED_COLUMNS[table]
        for check in checks:
            relation = f"st_{table}" if check.partition == quality.WHOLE else _newest(f"st_{table}", "inserted_at")
            columns = [c if c in known else "id" for c in check.columns]
            column = columns[0] if columns else ""
            if check.kind == "unique":
                relation = _groups(relation, ", ".join(columns))
            measured, passed = {
                "rows_above": ("count(*)", f"> {check.limit}"),
                "rows_between": ("count(*)", f"BETWEEN {check.limit} AND {check.upper}"),
                "missing_count": (_nulls(column), "= 0"),
                "missing_percent_below": (_share(column), f"< {check.limit}"),
                "minimum": (f"min({column})", f">= {check.limit}"),
                "fresh_within": (_age(column), f"<= {check.limit}"),
                "unique": ("count(*)", "= 0"),
            }[check.kind]
            names = ", ".join(check.columns)
            rows.append(_check_sql(table, check.partition, relation, check.name, names, measured, passed))
    return f"WITH {CHECKED_SQL}\n" + "\nUNION ALL\n".join(rows)


@query("market_checks", _market_checks_sql())
def market_checks(t: Tables):
    """All declared checks of the staging tables over the tables in their roles."""
    return quality.run_checks(staging_roles(t), quality.MARKET_CHECKS, AS_OF)


def _model_tests_sql() -> str:
    keys = {
        "dim_coins": ("dim_coins", "coin_id"),
        "dim_categories": ("dim_categories", "category_id"),
        "fact_coin_market": ("fact", "coin_id"),
        "vw_market_overview_daily": ("overview", "snapshot_date"),
        "vw_coin_explorer": ("explorer", "coin_id"),
        "vw_sector_performance": ("sectors", "category_id"),
    }
    references = [
        ("fact_coin_market", "fact", "coin_id", "dim_coins"),
        ("bridge_category_coin", "bridge", "category_id", "dim_categories"),
        ("bridge_category_coin", "bridge", "coin_id", "dim_coins"),
    ]
    row = "SELECT '{0}' AS model, '{1}' AS test, '{2}' AS column_name, count(*) AS failures FROM {3}"
    rows = []
    for model, (cte, key) in keys.items():
        rows.append(row.format(model, "unique", key, _groups(cte, key)))
    for model, cte, key in [*((m, *k) for m, k in keys.items()), *(r[:3] for r in references[1:])]:
        rows.append(row.format(model, "not_null", key, f"{cte} WHERE {key} IS NULL"))
    for model, cte, key, to in references:
        rows.append(row.format(model, "relationships", key, f"{cte} WHERE {key} NOT IN (SELECT {key} FROM {to})"))
    pair = _groups("bridge", "category_id, coin_id")
    rows.append(row.format("bridge_category_coin", "unique_pair", "category_id+coin_id", pair))
    return market_sql("\nUNION ALL\n".join(rows), OVERVIEW_SQL, EXPLORER_SQL, SECTORS_SQL)


@query("model_tests", _model_tests_sql())
def model_tests(t: Tables):
    return quality.model_tests(models(t))


@query(
    "failing_rows",
    """
WITH failed AS (
  SELECT 'missing_count(price) = 0' AS check_name, o_orderkey::VARCHAR AS failing_key, 1::BIGINT AS row_count
  FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT 'min(price) >= 1500', o_orderkey::VARCHAR, 1 FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice < 1500
  UNION ALL SELECT 'customer + day should be unique', o_custkey || ' | ' || o_orderdate::DATE, count(*) FROM orders
  GROUP BY o_custkey, o_orderdate::DATE HAVING count(*) > 1)
SELECT 'orders' AS table_name, 'all' AS partition_name, check_name, failing_key, row_count FROM failed
QUALIFY row_number() OVER (PARTITION BY check_name ORDER BY failing_key) <= 100""",
)
def failing_rows(t: Tables):
    """The least hundred keys behind each failed check of the orders."""
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price")
    day = F.col("o_orderdate").cast("date").alias("day")
    orders = t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), day, price)
    checks = [*quality.no_missing("id", "price"), quality.Check("minimum", ("price",), 1500), quality.Check("unique", ("customer", "day"))]
    return quality.failing_rows({"orders": orders}, {"orders": checks}, {"orders": ["id"]})
