"""Landed payloads to marts over several runs."""

from datetime import date, datetime

import pytest

from snapmart.operators.history import read_history
from snapmart.operators.latest import latest_batch
from snapmart.plans import charts, panels, quality
from snapmart.plans.refresh import (
    Layout,
    Models,
    export_csv,
    import_csv,
    ingest_dataset,
    land_entities,
    land_keyed_batches,
    load_group,
    newest_batches,
    run_pipeline,
    staging_tables,
)
from snapmart.sources.tables import create_layers, create_staging_tables, layer_name, staging_schema
from tests.market import category, info, land, listing, mapped

RUN1, RUN2, RUN3 = datetime(2024, 5, 1, 6), datetime(2024, 5, 2, 6), datetime(2024, 5, 4, 6)


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("market")
    for database in ("staging_layer", "intermediate_layer", "olap", "analytics"):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    return Layout(str(root / "landing"), str(root / "warehouse"))


def counts(report):
    return {r["dataset"]: (r["row_count"], r["error"]) for r in report.collect()}


@pytest.fixture(scope="module")
def market(spark, layout):
    """Three run days: first load, a changed daily run, a repeated and then a same-day changed run."""
    landing = layout.landing
    land(landing, "map", [mapped(1), mapped(2), mapped(3, is_active=0)])
    land(landing, "info", {"1": info(1), "2": info(2)})
    land(landing, "categories", [category("x", [1, 2]), category("y", [9])])
    land(landing, "category_details", [category("x", [1, 2]), category("y", [9]), category("z", [])])
    land(landing, "listings_latest", [listing(1, 1, 100.0), listing(2, 2, 20.0), listing(3, 3, 5.0, quoted=False), listing(9, 4, 1.0)])
    first = counts(run_pipeline(spark, layout, None, RUN1))

    land(landing, "listings_latest", [listing(2, 1, 110.0), listing(1, 2, 90.0), listing(3, 3, 6.0), listing(8, 5, 2.0)])
    second = counts(run_pipeline(spark, layout, "daily", RUN2))

    repeated = counts(run_pipeline(spark, layout, "daily", RUN3))  # unchanged
    land(landing, "listings_latest", [listing(1, 1, 95.0), listing(2, 3, 50.0), listing(9, 2, 60.0)])
    run_pipeline(spark, layout, "daily", RUN3.replace(hour=8))
    land(landing, "listings_latest", [listing(1, 1, 96.0), listing(2, 3, 50.0), listing(9, 2, 60.0)])
    run_pipeline(spark, layout, "daily", RUN3.replace(hour=20))
    models = Models(staging_tables(spark, layout), datetime(2024, 5, 5))
    return {"first": first, "second": second, "repeated": repeated, "models": models}


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_row_counts_per_data_set(market):
    assert market["first"] == {
        "listings_latest": (4, None), "quotes": (3, None), "categories": (2, None), "category_details": (4, None),
        "map": (3, None), "info": (2, None),
    }
    assert market["second"] == {"listings_latest": (4, None), "quotes": (4, None)}


def test_history_holds_changed_runs_only(spark, layout, market):
    def stamps(name):
        return sorted(r[0] for r in read_history(spark, layout.history(name)).select("inserted_at").distinct().collect())

    assert stamps("quotes") == [RUN1, RUN2, RUN3.replace(hour=20)]
    assert stamps("listings_latest") == [RUN1, RUN2, RUN3.replace(hour=8)]  # only a price changed after that


def test_staging_types(market):
    quotes = market["models"]["stg_quotes"]
    kinds = dict(quotes.dtypes)
    assert kinds["price"] == "decimal(30,10)" and kinds["is_fiat"] == "boolean"
    assert kinds["last_updated_at"] == "timestamp_ntz" and kinds["quote_currency_id"] == "bigint"
    assert {r["quote_currency_symbol"] for r in quotes.collect()} == {"USD"}


def test_category_without_coins_is_one_row_without_coin(market):
    details = by(market["models"]["stg_category_details"].where("category_id = 'z'"), "category_id")
    assert details["z"]["coin_id"] is None


def test_dim_coins(market):
    dim = by(market["models"]["dim_coins"], "coin_id")
    assert set(dim) == {1, 2, 3}
    assert dim[3]["is_active"] is False and dim[3]["coin_category"] is None
    assert dim[1]["first_historical_data_at"] == datetime(2013, 4, 28, 18, 47, 21)


def test_bridge_is_scoped_to_tracked_coins(market):
    assert set(by(market["models"]["bridge_category_coin"], "category_id", "coin_id")) == {("x", 1), ("x", 2)}


def test_fact_is_the_newest_state_of_tracked_coins(market):
    fact = by(market["models"]["fact_coin_market"], "coin_id")
    assert set(fact) == {1, 2, 3}
    assert float(fact[1]["price"]) == 96.0 and fact[1]["cmc_rank"] == 1
    assert float(fact[3]["price"]) == 6.0  # not listed any more: its last state stays
    assert fact[1]["inserted_at"] == RUN3.replace(hour=20)
    assert fact[1]["last_updated_at"] == datetime(2024, 5, 1, 5, 30)  # the later of listing and quote
    assert len(fact[1]) == 29


def test_listing_without_quote_stays_in_the_fact(spark, layout, market):
    tables = staging_tables(spark, layout)
    first = {**tables, **{n: tables[n].where("snapshot_date = date'2024-05-01'") for n in ("listings_latest", "quotes")}}
    fact = by(Models(first, RUN1)["fact_coin_market"], "coin_id")
    assert fact[3]["price"] is None and fact[3]["cmc_rank"] == 3
    assert fact[3]["inserted_at"] == RUN1


def test_market_overview(market):
    overview = by(market["models"]["vw_market_overview_daily"], "snapshot_date")
    assert set(overview) == {date(2024, 5, 1), date(2024, 5, 2), date(2024, 5, 4)}
    day = overview[date(2024, 5, 1)]
    assert float(day["total_market_cap"]) == 121_000 and day["num_coins"] == 3
    assert day["dex_volume_share"] == pytest.approx(0.25) and day["top10_market_cap_share"] == 1.0
    assert float(day["btc_dominance_pct"]) == 10.0
    assert overview[date(2024, 5, 4)]["num_coins"] == 3  # the later run of the day only


def test_momentum(market):
    moves = by(market["models"]["vw_coin_momentum_daily"], "coin_id", "snapshot_date")
    d1, d2, d4 = date(2024, 5, 1), date(2024, 5, 2), date(2024, 5, 4)
    assert (moves[1, d1]["prev_cmc_rank"], moves[1, d1]["rank_change"], moves[1, d1]["is_new_entry"]) == (1, 0, True)
    assert (moves[2, d2]["rank_change"], moves[2, d2]["is_new_entry"]) == (1, False)
    assert (moves[9, d4]["prev_snapshot_date"], moves[9, d4]["rank_change"]) == (d1, 2)  # absent on the second day
    assert moves[9, d4]["coin_name"] == "Coin 9"  # not in the dimension: named by the quote
    assert moves[3, d1]["price"] is None and moves[3, d1]["coin_symbol"] == "C3"
    assert moves[8, d2]["is_new_entry"] is True


def test_newest_day_of_momentum_is_the_same_both_ways(market, as_rows):
    m = market["models"]
    short, full = m["vw_coin_momentum_latest"], charts.momentum_latest(m["vw_coin_momentum_daily"])
    assert short.columns == full.columns
    assert as_rows(short) == as_rows(full) and short.count() == 3


def test_marts_prune_the_history_by_day(market):
    m = market["models"]
    day = charts.days_between(m["vw_market_overview_daily"], date(2024, 5, 2), date(2024, 5, 2))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    fact = m["fact_coin_market"]._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in fact


def test_explorer_ratios_and_flags(market):
    explorer = by(market["models"]["vw_coin_explorer"], "coin_id")
    assert len(explorer[1]) == 33
    assert explorer[1]["fdv_mc_ratio"] == 2.0 and explorer[1]["supply_utilization"] == 0.505
    assert explorer[1]["mc_tvl_ratio"] == pytest.approx(10.0) and explorer[2]["mc_tvl_ratio"] is None
    assert explorer[1]["is_new_coin_90d"] is True


def test_explorer_zero_denominators_and_infinite_supply(spark, layout, market):
    tables = dict(staging_tables(spark, layout))
    listings = tables["listings_latest"].selectExpr(
        "* except (infinite_supply, max_supply)",
        "case id when 1 then true when 2 then false end as infinite_supply",
        "cast(case id when 2 then 0 else 100 end as decimal(30,4)) as max_supply",
    )
    explorer = by(Models({**tables, "listings_latest": listings}, RUN3)["vw_coin_explorer"], "coin_id")
    assert explorer[1]["supply_utilization"] is None  # infinite
    assert explorer[2]["supply_utilization"] is None  # zero maximum
    assert explorer[3]["supply_utilization"] == 0.505  # unknown counts as finite


def test_sectors_cover_tracked_coins_only(market):
    sectors = by(market["models"]["vw_sector_performance"], "category_id")
    assert set(sectors) == {"x"}
    row = sectors["x"]
    assert row["num_coins"] == 2 and float(row["market_cap"]) == 146_000
    assert row["avg_change_24h_pct"] == pytest.approx((0.5 + 1.5) / 2)
    assert row["mc_tvl_ratio"] == pytest.approx(146_000 / 9_600)


def test_charts_over_the_marts(market):
    m = market["models"]
    latest = charts.momentum_latest(m["vw_coin_momentum_daily"])
    assert [r["coin_id"] for r in charts.rank_movers(latest, up=True).collect()] == [9, 1, 2]
    assert [r["coin_id"] for r in charts.rank_movers(latest, up=False).collect()] == [2, 1, 9]
    assert charts.new_entries(latest).count() == 0
    assert charts.overview_latest(m["vw_market_overview_daily"]).first()["snapshot_date"] == date(2024, 5, 4)
    assert [r["coin_symbol"] for r in charts.top_table(m["vw_coin_explorer"]).collect()] == ["C1", "C2", "C3"]
    assert charts.dilution_top(m["vw_coin_explorer"], 50_000).collect()[0]["fdv_mc_ratio"] == 2.0
    assert charts.cheapest_by_tvl(m["vw_coin_explorer"]).count() == 2
    history = by(charts.rank_history(m["vw_coin_momentum_daily"]), "snapshot_date", "coin_symbol")
    assert history[date(2024, 5, 1), "C2"]["inverted_rank"] == -2
    assert charts.days_between(m["vw_market_overview_daily"], date(2024, 5, 2), date(2024, 5, 4)).count() == 2


def test_model_tests_pass(market):
    results = quality.model_tests(market["models"]).collect()
    assert len(results) == 18 and all(r["failures"] == 0 for r in results)


def test_tables_and_views_can_be_queried_by_name(spark, layout, market):
    assert spark.sql("select count(*) from olap.dim_coins").first()[0] == 3
    assert spark.sql("select count(*) from olap.bridge_category_coin").first()[0] == 2
    assert spark.sql("select max(cmc_rank) from fact_coin_market").first()[0] == 3
    assert spark.sql("select count(*) from staging_layer.map").first()[0] == 3
    assert spark.sql("select count(*) from stg_quotes").first()[0] == 10
    assert spark.sql("select count(*) from int_category_coin_bridge").first()[0] == 2
    assert spark.sql("select max(num_coins) from vw_sector_performance").first()[0] == 2


def test_declared_checks_over_staging(spark, layout, market):
    tables = staging_tables(spark, layout)
    results = quality.run_checks(tables, quality.MARKET_CHECKS, datetime(2024, 5, 5), day="snapshot_date").collect()
    assert len(results) == 75
    outcome = {(r["table_name"], r["partition_name"], r["check_name"]): r["outcome"] for r in results}
    assert outcome["listings_latest", "all", "row_count > 0"] == "pass"
    assert outcome["listings_latest", "latest", "row_count between 480 and 520"] == "fail"
    assert outcome["category_details", "all", "missing_count(coins_id) = 0"] == "fail"
    assert outcome["quotes", "all", "freshness(inserted_at) <= 48h"] == "pass"
    assert outcome["categories", "all", "freshness(inserted_at) <= 24h"] == "fail"
    assert outcome["quotes", "latest", "id + quote_id + inserted_at should be unique"] == "pass"


def test_newest_batches_are_read_from_their_day_only(spark, layout, market, as_rows):
    latest = newest_batches(spark, layout)
    tables = staging_tables(spark, layout)
    for name, rows in latest.items():
        assert as_rows(rows, *tables[name].columns) == as_rows(latest_batch(tables[name], "inserted_at", "snapshot_date"), *tables[name].columns)
        assert len({f.split("snapshot_date=")[1][:10] for f in rows.inputFiles()}) == 1
    as_of = datetime(2024, 5, 5)
    asked = [quality.run_checks(tables, quality.MARKET_CHECKS, as_of, day="snapshot_date", latest=x) for x in (None, latest)]
    assert as_rows(asked[0], "table_name", "check_name", "outcome") == as_rows(asked[1], "table_name", "check_name", "outcome")


def test_panels_over_staging(spark, layout, market):
    tables = staging_tables(spark, layout)
    watch = panels.market_watch(tables, day="snapshot_date")
    as_of = datetime(2024, 5, 7)
    ages = by(panels.freshness_sla(watch, as_of), "table_name")
    assert ages["quotes"]["status"] == "STALE" and ages["categories"]["status"] == "OK"
    assert ages["quotes"]["hours_since_update"] == 52.0
    assert {r["status"] for r in panels.duplicate_status(watch).collect()} == {"OK"}
    assert by(panels.batch_size_status(watch), "table_name")["quotes"]["row_count"] == 3
    missing = by(panels.market_missing_status(tables, day="snapshot_date"), "table_name", "column_name")
    assert len(missing) == 45
    assert missing["category_details", "coins_id"]["status"] == "FAIL"
    assert missing["listings_latest", "tvl_ratio"]["missing_percent"] == 100.0
    days = by(panels.rows_per_day(watch), "day")
    assert days[date(2024, 5, 1)]["category_details"] == 4 and days[date(2024, 5, 2)]["categories"] is None


def test_missing_data_sets_are_skipped_and_bad_ones_reported(spark, tmp_path):
    layout = Layout(str(tmp_path / "landing"), str(tmp_path / "warehouse"))
    with pytest.raises(RuntimeError, match="no data set was loaded"):
        load_group(spark, layout, "monthly", RUN1)
    land(layout.landing, "categories", [{**category("x", [1]), "num_tokens": "many"}])
    land(layout.landing, "category_details", [category("x", [1])])
    counts_, errors = load_group(spark, layout, "weekly", RUN1)
    assert counts_ == {"category_details": 1} and "many" in errors["categories"]
    with pytest.raises(ValueError, match="unknown group"):
        load_group(spark, layout, "hourly", RUN1)
    with pytest.raises(RuntimeError, match="listings are not landed"):
        load_group(spark, layout, "daily", RUN1)


def test_over_long_text_fails_the_load(spark, tmp_path):
    layout = Layout(str(tmp_path / "landing"), str(tmp_path / "warehouse"))
    land(layout.landing, "categories", [{**category("x", []), "name": "n" * 101}])
    land(layout.landing, "category_details", [category("x", [1])])
    _, errors = load_group(spark, layout, "weekly", RUN1)
    assert "name is longer than 100" in errors["categories"]


def test_bad_load_keeps_the_old_table(spark, layout, market, tmp_path):
    from snapmart.sources.tables import conform, replace_table

    schema = staging_schema("info")
    good = spark.createDataFrame([("1", "a", "d", "l", "2020-01-01 00:00:00")], "id string, category string, description string, logo string, date_launched string")
    table = replace_table(conform(good, schema), "info_copy", str(tmp_path))
    assert table.count() == 1
    with pytest.raises(Exception, match="bad value for id: x"):
        replace_table(conform(good.selectExpr("'x' as id", "category", "description", "logo", "date_launched"), schema), "info_copy", str(tmp_path))
    assert spark.table("info_copy").first()["id"] == 1
    replace_table(conform(good.selectExpr("'2' as id", "category", "description", "logo", "date_launched"), schema), "info_copy", str(tmp_path))
    assert [r["id"] for r in spark.table("info_copy").collect()] == [2]


def test_declaring_tables_is_idempotent(spark, tmp_path):
    create_layers(spark, str(tmp_path), ["declared"])
    for _ in range(2):
        create_staging_tables(spark, "declared")
    assert {t.name for t in spark.catalog.listTables("declared") if not t.isTemporary} == {
        "listings_latest", "quotes", "categories", "category_details", "map", "info",
    }
    assert layer_name(None) == "analytics" and layer_name(" olap ") == "olap"


def test_landed_runs_are_ingested_incrementally(spark, tmp_path):
    layout = Layout(str(tmp_path / "landing"), str(tmp_path / "warehouse"))

    def land_run(run, records):
        land(f"{layout.landing}/category_details", f"run_ts={run.isoformat(sep=' ').replace(':', '%3A')}", records)

    def stamps():
        ingest_dataset(spark, layout, "category_details")
        history = read_history(spark, layout.history("category_details"))
        return sorted((r["inserted_at"], r["coins_id"]) for r in history.collect())

    land_run(RUN2, [category("x", [1])])  # repeats the first run
    land_run(RUN1, [category("x", [1])])
    assert stamps() == [(RUN1, 1)]
    land_run(RUN3, [category("x", [1, 2])])
    assert stamps() == [(RUN1, 1), (RUN3, 1), (RUN3, 2)]


def test_csv_history_can_be_moved_in_and_out(spark, layout, market, tmp_path, as_rows):
    path = str(tmp_path / "categories.csv")
    export_csv(spark, layout, "categories", path)
    other = Layout(str(tmp_path / "landing"), str(tmp_path / "warehouse"))
    import_csv(spark, other, "categories", path, RUN3)
    names = staging_schema("categories").names
    moved, kept = (read_history(spark, x.history("categories")).select(*names) for x in (other, layout))
    assert as_rows(moved) == as_rows(kept)
    assert moved.first()["description"] == 'multi\nline, "quoted"'


def test_csv_without_stamps_is_stamped(spark, tmp_path):
    layout = Layout(str(tmp_path / "landing"), str(tmp_path / "warehouse"))
    columns = [n for n in staging_schema("categories").names if n != "inserted_at"]
    (tmp_path / "old.csv").write_text(",".join(columns) + "\nx,Sector x,T,,1.5,3,,7,,,2024-01-01T00:00:00.000Z\n")
    import_csv(spark, layout, "categories", str(tmp_path / "old.csv"), RUN1)
    row = read_history(spark, layout.history("categories")).first()
    assert row["inserted_at"] == RUN1 and row["last_updated"] == datetime(2024, 1, 1) and row["num_tokens"] == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        import_csv(spark, layout, "categories", str(tmp_path / "absent.csv"), RUN1)


def test_bad_value_fails_without_ansi_casts(spark):
    from snapmart.sources.tables import conform

    df = spark.createDataFrame([("12.0", "1e3")], "num_tokens string, volume string")
    schema = staging_schema("categories")
    volume, tokens = ([f for f in schema.fields if f.name == n] for n in ("volume", "num_tokens"))
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        assert conform(df, type(schema)(volume)).first()["volume"] == 1000
        over = df.selectExpr("'1e40' as volume")
        with pytest.raises(Exception, match="bad value for volume: 1e40"):
            conform(over, type(schema)(volume)).collect()
        with pytest.raises(Exception, match="bad value for num_tokens: x"):
            conform(df.selectExpr("'x' as num_tokens"), type(schema)(tokens)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)


def test_per_entity_and_batched_payloads_are_landed_as_one(spark, tmp_path):
    layout = Layout(
        str(tmp_path / "landing"), str(tmp_path / "warehouse"), frozenset({"quotes", "category_details", "info"})
    )
    fetched = str(tmp_path / "fetched")
    for key, data in (("x", category("x", [1, 2])), ("y", category("y", []))):
        land(fetched, key, data)
    (tmp_path / "fetched" / "empty").mkdir()
    (tmp_path / "fetched" / "empty" / "payload.json").write_text('{"status": {"error_code": 500}}')
    land_entities(spark, layout, "category_details", [f"{fetched}/{k}" for k in ("x", "y", "empty")])
    land(fetched, "first", {"1": info(1), "2": info(2)})
    land(fetched, "second", {"2": {**info(2), "category": "token"}, "3": info(3)})
    land_keyed_batches(spark, layout, "info", [f"{fetched}/{k}" for k in ("first", "empty", "second")])
    with pytest.raises(RuntimeError, match="no info record"):
        land_keyed_batches(spark, layout, "info", [f"{fetched}/empty"])
    land(layout.landing, "map", [mapped(1), mapped(2)])
    assert load_group(spark, layout, "monthly", RUN1)[0] == {"map": 2, "info": 3}
    counts_, errors = load_group(spark, layout, "weekly", RUN1)
    assert (counts_, errors) == ({"category_details": 3}, {})
    dim = by(Models(staging_tables(spark, layout), RUN1)["dim_coins"], "coin_id")
    assert dim[1]["coin_category"] == "coin" and dim[2]["coin_category"] == "token"
