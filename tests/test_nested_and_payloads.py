import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from snapmart.operators.nested import drop_columns, explode_flatten, explode_list, flatten
from snapmart.schemas import datasets_of, record_schema
from snapmart.sources.files import read_csv, write_csv
from snapmart.sources.payloads import (
    derive_quotes,
    first_source_keys,
    land_records,
    merge_keyed,
    read_entity_payloads,
    read_envelope,
    read_if_landed,
    read_keyed_envelope,
    require_rows,
)

ID = StructType().add("id", LongType())


def put(path, payload):
    path.write_text(json.dumps(payload, indent=2), encoding="utf-8")
    return str(path)


def listing(key, **usd):
    quote = {"price": 100.0, "volume_24h": 1.0, "market_cap": 11.0, "tvl": None, "last_updated": "2026-07-22T00:00:00.000Z"}
    return {
        "id": key, "name": f"Coin {key}", "symbol": f"C{key}", "slug": f"coin-{key}", "minted_market_cap": 999.0,
        "tags": ["x"], "quote": {"USD": {**quote, **usd}},
    }


def test_flatten_joins_paths_and_keeps_lists(spark):
    df = spark.sql("select named_struct('a', 1, 'b', named_struct('c', 2, 'd.e', array(3))) as r, 4 as s")
    assert flatten(df).columns == ["r_a", "r_b_c", "r_b_d.e", "s"]
    assert list(flatten(df).first()) == [1, 2, [3], 4]


def test_explode_keeps_parents_without_children(spark, as_rows):
    df = spark.createDataFrame([(1, [(5,), (6,)]), (2, []), (3, None)], "id int, coins array<struct<id:int>>")
    assert as_rows(explode_flatten(df, "coins")) == [(1, 5), (1, 6), (2, None), (3, None)]
    assert explode_list(df, "absent") is df


def test_drop_ignores_absent_columns(spark):
    assert drop_columns(spark.createDataFrame([(1, 2)], "a int, b int"), ["b", "zzz"]).columns == ["a"]


def test_envelope_gives_records_in_order(spark, tmp_path):
    path = put(tmp_path / "p.json", {"status": {"error_code": 0}, "data": [{"id": 7}, {"id": 3}]})
    assert [(r["_pos"], r["id"]) for r in read_envelope(spark, path, ID).orderBy("_pos").collect()] == [(0, 7), (1, 3)]


def test_envelope_without_data_names_the_path(spark, tmp_path):
    path = put(tmp_path / "broken.json", {"status": {"error_code": 1}})
    with pytest.raises(Exception, match=r"no 'data' key in .*broken\.json"):
        read_envelope(spark, path, ID).collect()
    with pytest.raises(Exception, match="no 'data' key"):
        read_keyed_envelope(spark, path, ID).collect()


def test_keyed_envelope(spark, tmp_path, as_rows):
    path = put(tmp_path / "info.json", {"data": {"1": {"id": 1}, "9": {"id": 9}}})
    assert as_rows(read_keyed_envelope(spark, path, ID)) == [(1,), (9,)]


def test_entity_payloads_skip_missing_ones(spark, tmp_path, as_rows):
    paths = [
        put(tmp_path / "a.json", {"data": {"id": 1}}),
        put(tmp_path / "b.json", {"status": {}}),
        put(tmp_path / "c.json", {"data": {"id": 2}}),
    ]
    assert as_rows(read_entity_payloads(spark, paths, ID)) == [(1,), (2,)]
    with pytest.raises(RuntimeError, match="no entity payload"):
        read_entity_payloads(spark, [paths[1]], ID)


def test_first_available_source_wins(spark, as_rows):
    empty, full = spark.createDataFrame([], "id int"), spark.createDataFrame([(5,)], "id int")
    other = spark.createDataFrame([(6,)], "id int")
    assert as_rows(first_source_keys([full, other])) == [(5,)]
    assert as_rows(first_source_keys([None, empty, other])) == [(6,)]
    with pytest.raises(RuntimeError, match="no source holds keys"):
        first_source_keys([None, empty])


def test_later_batches_overwrite(spark, as_rows):
    one = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "id int, s string, n int")
    two = spark.createDataFrame([(None, 2, "B"), (7, 3, "c")], "n int, id int, s string")
    assert as_rows(merge_keyed([one, two], "id")) == [(1, "a", None), (2, "B", None), (3, "c", 7)]


def read_listings(spark, tmp_path, records):
    return read_envelope(spark, put(tmp_path / "l.json", {"data": records}), record_schema("listings_latest"))


def test_derived_quote_shape(spark, tmp_path):
    row = derive_quotes(read_listings(spark, tmp_path, [listing(1)])).first()
    quote = row["quote"][0]
    assert (row["id"], row["is_fiat"], len(row["quote"])) == (1, 0, 1)
    assert (quote["id"], quote["symbol"]) == (2781, "USD")
    assert (float(quote["price"]), float(quote["minted_market_cap"]), quote["tvl"]) == (100.0, 999.0, None)


def test_derivation_limit_keeps_source_order(spark, tmp_path, as_rows):
    records = [listing(k) for k in (9, 2, 7, 1)]
    assert as_rows(derive_quotes(read_listings(spark, tmp_path, records), limit=3), "id") == [(2,), (7,), (9,)]


def test_derivation_skips_records_without_usd_after_the_limit(spark, tmp_path, as_rows):
    empty = {**listing(3), "quote": {"USD": {}}}
    null_price = {**listing(4), "quote": {"USD": {"price": None}}}  # not empty: kept
    records = [listing(1), {"id": 99, "name": "NoQuote"}, empty, null_price, listing(5)]
    assert as_rows(derive_quotes(read_listings(spark, tmp_path, records), limit=4), "id") == [(1,), (4,)]


def test_nothing_derived_is_an_error(spark, tmp_path):
    quotes = derive_quotes(read_listings(spark, tmp_path, [{"id": 1, "name": "NoQuote"}]))
    with pytest.raises(RuntimeError, match="nothing"):
        require_rows(quotes, "nothing derived")


def test_empty_payload_is_not_landed(spark, tmp_path):
    path = tmp_path / "landed"
    assert land_records(spark.createDataFrame([], "id int"), str(path)) is False
    assert not path.exists()
    assert land_records(spark.range(3), str(path)) is True
    assert spark.read.json(str(path)).count() == 3


def test_absent_payload_is_none(spark, tmp_path):
    assert read_if_landed(spark, str(tmp_path / "nothing.json"), ID) is None


def test_csv_keeps_commas_quotes_and_line_breaks(spark, tmp_path, as_rows):
    rows = [(1, 'a "quoted", text\nwith lines', None), (2, " ", "\\"), (3, None, "x,y\r\nz")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    write_csv(df, str(tmp_path / "csv"), rows_per_file=2)
    assert as_rows(read_csv(spark, str(tmp_path / "csv"), df.schema)) == as_rows(df)


def test_empty_csv_text_is_null(spark, tmp_path, as_rows):
    (tmp_path / "t.csv").write_text('id,a,b\n1,,""\n')
    assert as_rows(read_csv(spark, str(tmp_path / "t.csv"), "id INT, a STRING, b STRING")) == [(1, None, None)]


def test_bad_csv_value_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id\nseven\n")
    with pytest.raises(Exception, match="MALFORMED|seven|FAILED_READ"):
        read_csv(spark, str(tmp_path / "bad.csv"), "id INT").agg(F.sum("id")).collect()


def test_cadence_groups():
    assert [d.name for d in datasets_of("weekly")] == ["categories", "category_details"]
    assert len(datasets_of(None)) == 6
    with pytest.raises(ValueError, match="unknown group 'hourly'"):
        datasets_of("hourly")


def test_lines_and_documents_have_the_same_places(spark, tmp_path):
    from snapmart.plans.refresh import Layout, land_lines
    from snapmart.schemas import record_schema
    from snapmart.sources.payloads import derive_quotes, placed, read_envelope
    from tests.market import land, listing

    records = [listing(k, k, 1.0 * k, quoted=k % 3 > 0) for k in range(1, 41)]
    land(tmp_path, "document", records)
    schema = record_schema("listings_latest")
    document = read_envelope(spark, str(tmp_path / "document"), schema)
    layout = Layout(str(tmp_path), str(tmp_path))
    land_lines(document.drop("_pos").repartitionByRange(7, "id").sortWithinPartitions("id"), layout, "listings_latest")
    lines = read_envelope(spark, layout.payload("listings_latest"), schema, whole_file=False)
    assert sorted((r["_pos"], r["id"]) for r in lines.collect()) == [(k, k + 1) for k in range(40)]
    for limit in (None, 0, 1, 13, 99):
        found = [sorted(r["id"] for r in derive_quotes(df, limit).collect()) for df in (document, lines)]
        assert found[0] == found[1] == [k for k in range(1, 41) if k % 3 and (limit is None or k <= limit)]
    numbers = placed(spark.range(1000).repartition(9).where("id % 7 > 0"))
    assert sorted(r["place"] for r in numbers.collect()) == list(range(numbers.count()))
