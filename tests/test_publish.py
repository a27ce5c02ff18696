"""Staging tables and models by name, from other sessions of the catalog and after further loads."""

import uuid
from datetime import date, datetime

import pytest

from snapmart.operators.history import add_rows, read_history, stored_state
from snapmart.plans.refresh import MATERIALISED, Layout, Models, declare_warehouse, publish, run_pipeline, staging_tables
from snapmart.schemas import DATASETS
from snapmart.sources.tables import staging_schema
from tests.market import category, info, land, listing, mapped

RUN1, RUN2 = datetime(2024, 5, 1, 6), datetime(2024, 5, 2, 6)


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "landing"), str(tmp_path / "warehouse"), prefix=f"t{uuid.uuid4().hex[:8]}_")


def land_first(layout):
    landing = layout.landing
    land(landing, "map", [mapped(1), mapped(2), mapped(3, is_active=0)])
    land(landing, "info", {"1": info(1), "2": info(2)})
    land(landing, "categories", [category("x", [1, 2]), category("y", [9])])
    land(landing, "category_details", [category("x", [1, 2]), category("y", [9]), category("z", [])])
    land(landing, "listings_latest", [listing(k, k, 10.0 * k, quoted=k != 3) for k in (1, 2, 3, 9)])


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_all_names_resolve_in_a_second_session(spark, layout):
    land_first(layout)
    run_pipeline(spark, layout, None, RUN1)
    land(layout.landing, "listings_latest", [listing(2, 1, 110.0), listing(1, 2, 90.0), listing(8, 5, 2.0)])
    run_pipeline(spark, layout, "daily", RUN2)
    other = spark.newSession()
    models = Models(staging_tables(spark, layout), RUN2)
    for name in [*MATERIALISED, *(f"stg_{n}" for n in DATASETS)]:
        found = other.table(layout.model(name))
        assert sorted(found.columns) == sorted(models[name].columns), name
        assert content(found.select(*models[name].columns)) == content(models[name]), name
    for name in DATASETS:
        found = other.table(layout.staging(name))
        days = ["snapshot_date"] if DATASETS[name].historical else []
        assert found.columns == [*staging_schema(name).names, *days] and found.count() > 0
    assert not [t for t in other.catalog.listTables() if t.isTemporary]


def test_declaration_load_and_second_declaration(spark, layout):
    declare_warehouse(spark, layout)
    assert spark.table(layout.staging("quotes")).count() == 0
    land_first(layout)
    run_pipeline(spark, layout, None, RUN1)
    declare_warehouse(spark, layout)
    quotes = spark.table(layout.staging("quotes"))
    assert quotes.count() == 3
    kinds = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {layout.staging('quotes')}").collect()}
    assert kinds["symbol"] == "varchar(20)" and kinds["quote_price"] == "decimal(30,10)" and kinds["snapshot_date"] == "date"
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {layout.staging('quotes')}").collect()]
    assert parts == ["snapshot_date=2024-05-01"]


def test_filters_on_the_day_reach_the_partitions(spark, layout):
    land_first(layout)
    run_pipeline(spark, layout, None, RUN1)
    land(layout.landing, "listings_latest", [listing(2, 1, 110.0)])
    run_pipeline(spark, layout, "daily", RUN2)
    newest = spark.table(layout.model("stg_quotes")).where("snapshot_date = DATE '2024-05-02'")
    assert len(newest.inputFiles()) == 1 and "snapshot_date=2024-05-02" in newest.inputFiles()[0]


def test_view_that_is_open_keeps_its_rows_and_sees_the_next_load_when_asked_again(spark, layout):
    land_first(layout)
    run_pipeline(spark, layout, None, RUN1)
    name = layout.model("stg_quotes")
    before = spark.table(name)
    rows = content(before)
    land(layout.landing, "listings_latest", [listing(1, 1, 500.0)])
    run_pipeline(spark, layout, "daily", RUN1.replace(hour=9))
    assert content(before) == rows
    assert [r["price"] for r in spark.table(name).collect()] == [500]


def test_days_of_several_versions_and_days_taken_back(spark, layout):
    land_first(layout)
    run_pipeline(spark, layout, None, RUN1)
    path = layout.history("quotes")
    add_rows(read_history(spark, path).drop("snapshot_date").limit(1), path)
    publish(spark, layout)
    assert spark.table(layout.staging("quotes")).count() == 4
    assert {len(v) for v in stored_state(spark, path).days.values()} == {1}
    other = Layout(layout.landing, f"{layout.warehouse}-2", prefix=layout.prefix)
    run_pipeline(spark, other, None, RUN2)  # the names now show the other warehouse
    days = [r[0] for r in spark.table(layout.staging("quotes")).select("snapshot_date").distinct().collect()]
    assert days == [date(2024, 5, 2)]
    assert read_history(spark, path).count() == 4
