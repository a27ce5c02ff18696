"""Checks and panels on hand-made edge rows."""

from datetime import datetime

import pytest

from snapmart.plans import panels, quality
from snapmart.plans.panels import Watched

NOW = datetime(2024, 5, 10)
SCHEMA = "id bigint, v double, inserted_at timestamp_ntz"


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        (1, 1.0, datetime(2024, 5, 1)),
        (1, None, datetime(2024, 5, 8)),  # same key, same time, twice
        (1, 2.0, datetime(2024, 5, 8)),
        (2, -1.0, datetime(2024, 5, 8)),
        (None, None, datetime(2024, 5, 8)),
        (3, 1.0, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def outcomes(df, checks, **options):
    found = quality.run_checks({"t": df}, {"t": checks}, NOW, **options).collect()
    return {(r["partition_name"], r["check_name"]): (r["measured"], r["outcome"]) for r in found}


def test_each_kind_of_check(table):
    found = outcomes(
        table,
        [
            quality.rows_above(0),
            quality.rows_between(4, 4),
            *quality.no_missing("id", "inserted_at"),
            *quality.no_missing("id", partition=quality.LATEST),
            *quality.at_least(0, "v"),
            quality.fresh_within(48),
            quality.unique("id", "inserted_at"),
            quality.unique("id", "inserted_at", partition=quality.WHOLE),
        ],
    )
    assert found == {
        ("all", "row_count > 0"): (6, "pass"),
        ("all", "missing_count(id) = 0"): (1, "fail"),
        ("all", "missing_count(inserted_at) = 0"): (1, "fail"),
        ("all", "min(v) >= 0"): (-1, "fail"),
        ("all", "freshness(inserted_at) <= 48h"): (48, "pass"),  # exactly at the limit
        ("all", "id + inserted_at should be unique"): (1, "fail"),
        ("latest", "row_count between 4 and 4"): (4, "pass"),  # a null time is never the latest
        ("latest", "missing_count(id) = 0"): (1, "fail"),
        ("latest", "id + inserted_at should be unique"): (1, "fail"),
    }


def test_missing_share_at_the_limit_fails_the_rule_and_passes_the_panel(table):
    latest = table.where("inserted_at = timestamp_ntz'2024-05-08'")  # half of v is missing
    found = outcomes(latest, [*quality.missing_below(50, "v"), *quality.missing_below(50.01, "v")])
    assert found["all", "missing_percent(v) < 50%"] == (50.0, "fail")
    assert found["all", "missing_percent(v) < 50.01%"] == (50.0, "pass")
    panel = {r["column_name"]: r["status"] for r in panels.missing_status([("t", latest, {"v": 50, "id": 24})]).collect()}
    assert panel == {"v": "OK", "id": "FAIL"}


def test_empty_table_fails_the_rules_and_passes_the_panels(table):
    empty = table.where("false")
    found = outcomes(empty, [quality.rows_above(0), quality.fresh_within(48), *quality.missing_below(50, "v")])
    assert {outcome for _, outcome in found.values()} == {"fail"}
    watch = {"t": Watched(empty, keys=("id",), sla_hours=1, expected=(0, 1))}
    row = panels.freshness_sla(watch, NOW).first()
    assert (row["last_inserted"], row["hours_since_update"], row["status"]) == (None, None, "OK")
    assert panels.missing_status([("t", empty, {"v": 0})]).first()["status"] == "OK"
    assert panels.batch_size_status(watch).first()["row_count"] == 0
    assert panels.duplicate_status(watch).first()["status"] == "OK"


def test_panels_on_edge_rows(table):
    watch = {"t": Watched(table, keys=("id", "inserted_at"), sla_hours=48, expected=(5, 9))}
    assert panels.duplicate_status(watch).first()["status"] == "FAIL"
    assert panels.batch_size_status(watch).first()["status"] == "OUT OF RANGE"
    assert panels.freshness_sla(watch, NOW).first()["status"] == "OK"  # exactly at the limit
    late = panels.freshness_sla(watch, datetime(2024, 5, 10, 0, 0, 1)).first()
    assert (late["status"], late["hours_since_update"]) == ("STALE", 48.0)


def test_all_checks_of_a_partition_share_one_scan(table):
    checks = [quality.rows_above(0), *quality.no_missing("id", "v"), *quality.at_least(0, "v"), quality.fresh_within(1)]
    plan = quality.run_checks({"t": table}, {"t": checks}, NOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_digest_groups_and_escapes_failed_checks(table):
    results = quality.run_checks(
        {"t": table, "u": table},
        {"t": [*quality.at_least(0, "v"), *quality.missing_below(1, "v"), quality.rows_above(0)], "u": [quality.rows_above(0)]},
        NOW,
    )
    digest = quality.alert_digest(results).collect()
    assert [tuple(r) for r in digest] == [("t", 2, "min(v) &gt;= 0, missing_percent(v) &lt; 1%")]


def test_declared_checks_are_complete():
    counts = {t: len(c) for t, c in quality.MARKET_CHECKS.items()}
    assert counts == {"categories": 10, "category_details": 12, "info": 2, "listings_latest": 20, "quotes": 31}
    assert sum(len(panels.allowed_missing(t)) for t in panels.MARKET_CHECKS) == 45


def test_run_log_panels(spark):
    runs = spark.createDataFrame(
        [
            ("a", "failed", datetime(2024, 5, 1), datetime(2024, 5, 1, 0, 1)),
            ("a", "success", datetime(2024, 5, 2), datetime(2024, 5, 2, 0, 2, 33)),
            ("a", "failed", datetime(2024, 5, 2), None),  # started together, still open
            ("b", "success", datetime(2024, 4, 1), datetime(2024, 4, 1, 1)),
        ],
        "job_id string, state string, start_date timestamp_ntz, end_date timestamp_ntz",
    )
    latest = sorted((r["job_id"], r["state"], r["duration_minutes"]) for r in panels.latest_runs(runs).collect())
    assert latest == [("a", "failed", None), ("a", "success", 2.6), ("b", "success", 60.0)]
    rates = panels.run_success(runs, datetime(2024, 5, 1), datetime(2024, 5, 2)).collect()
    assert [(r["job_id"], r["total_runs"], r["success_rate_pct"]) for r in rates] == [("a", 3, 33.3)]


def test_failing_rows_are_named(spark, as_rows):
    rows = [(1, 5.0, "a"), (2, None, "a"), (None, -1.0, "b"), (4, -2.0, None), (2, -3.0, "a")]
    df = spark.createDataFrame(rows, "id int, price double, name string")
    checks = {"t": [*quality.no_missing("price", "name"), quality.Check("minimum", ("price",), 0), quality.Check("unique", ("id", "name")), quality.rows_above(9)]}
    found = quality.failing_rows({"t": df}, checks, {"t": ["id", "name"]})
    assert as_rows(found, "check_name", "failing_key", "row_count") == [
        ("id + name should be unique", "2 | a", 2),
        ("min(price) >= 0", "2 | a", 1),
        ("min(price) >= 0", "4 | null", 1),
        ("min(price) >= 0", "null | b", 1),
        ("missing_count(name) = 0", "4 | null", 1),
        ("missing_count(price) = 0", "2 | a", 1),
    ]
    few = quality.failing_rows({"t": df}, checks, {"t": ["id", "name"]}, limit=1)
    assert as_rows(few, "check_name", "failing_key")[1] == ("min(price) >= 0", "2 | a") and few.count() == 4


def test_offending_keys_of_the_models(spark, as_rows):
    def ids(name, *values):
        return spark.createDataFrame([(v,) for v in values], f"{name} int")

    bridge = spark.createDataFrame([(1, 7), (1, 7), (2, 8), (3, 9), (3, 9), (3, 9)], "category_id int, coin_id int")
    models = {
        "dim_coins": ids("coin_id", 7, 8, 8, None),
        "dim_categories": ids("category_id", 1, 2),
        "fact_coin_market": ids("coin_id", 7, 5, 5),
        "vw_market_overview_daily": ids("snapshot_date", 1, 2),
        "vw_coin_explorer": ids("coin_id", 7),
        "vw_sector_performance": ids("category_id", 1, 1),
        "bridge_category_coin": bridge,
    }
    assert as_rows(quality.offending_keys(models)) == [
        ("bridge_category_coin", "relationships", "3"),
        ("bridge_category_coin", "relationships", "9"),
        ("bridge_category_coin", "unique_pair", "1 | 7"),
        ("bridge_category_coin", "unique_pair", "3 | 9"),
        ("dim_coins", "unique", "8"),
        ("fact_coin_market", "relationships", "5"),
        ("fact_coin_market", "unique", "5"),
        ("vw_sector_performance", "unique", "1"),
    ]
