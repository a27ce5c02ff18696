"""One refresh of the warehouse: landed payloads to staging, models and reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType, TimestampNTZType

from snapmart.operators.history import backfill_stamp, load_snapshot, newest_batch, read_history, replace_days
from snapmart.operators.latest import DAY
from snapmart.operators.nested import explode_flatten, flatten
from snapmart.plans import core, marts
from snapmart.plans.staging import staged
from snapmart.plans.views import create_views, staging_view, view_sql
from snapmart.schemas import DATASETS, DataSet, datasets_of, record_schema
from snapmart.sources.files import read_csv_split, write_csv
from snapmart.sources.payloads import (
    derive_quotes,
    land_records,
    merge_keyed,
    placed,
    read_entity_payloads,
    read_if_landed,
    read_keyed_envelope,
    require_rows,
)
from snapmart.sources.tables import (
    conform,
    create_layers,
    create_staging_tables,
    layer_name,
    publish_history,
    replace_table,
    staging_schema,
    stored_schema,
)
from snapmart.streaming.ingest import commit_runs, ingest_available


@dataclass(frozen=True)
class Layout:
    """Folders of one warehouse. Payloads are documents that span lines, apart from the data sets in
    ``lines``, whose files hold one envelope per line (derived and merged payloads are landed so).
    ``prefix`` stands before the names of its namespaces, for warehouses that share a catalog."""

    landing: str
    warehouse: str
    lines: frozenset[str] = frozenset({"quotes"})
    prefix: str = ""

    def payload(self, name: str) -> str:
        return f"{self.landing}/{name}"

    def whole_file(self, name: str) -> bool:
        return name not in self.lines

    def history(self, name: str) -> str:
        return f"{self.warehouse}/staging_layer/{name}"

    def staging(self, name: str) -> str:
        """Full name of a staging table."""
        return f"{self.prefix}staging_layer.{name}"

    def model(self, name: str) -> str:
        """Full name of a model; staging models are in the default namespace."""
        layer, _ = MATERIALISED.get(name, (None, "view"))
        return f"{self.prefix}{layer_name(layer)}.{name}"


def parse(records: DataFrame, dataset: DataSet) -> DataFrame:
    """Flat, typed rows of one data set, before they are stamped."""
    flat = flatten(records)
    if dataset.explode:
        flat = explode_flatten(flat, dataset.explode)
    return conform(flat, staging_schema(dataset.name, stamped=False))


def land_quotes(spark: SparkSession, layout: Layout, limit: int | None = None) -> None:
    """Derive the quotes payload from the landed listings; ``limit`` as in ``derive_quotes``."""
    name = "listings_latest"
    listings = read_if_landed(
        spark, layout.payload(name), record_schema(name), whole_file=layout.whole_file(name)
    )
    if listings is None:
        raise RuntimeError("listings are not landed; quotes are derived from them")
    quotes = require_rows(derive_quotes(listings, limit), "no quotes could be derived from the listings")
    land_lines(quotes, layout, "quotes")


def land_lines(records: DataFrame, layout: Layout, name: str) -> None:
    """Land records as one envelope per line: an array of one record with its place in source order, or a map of one for
    a keyed payload, whose records have no order."""
    record = F.struct(*records.columns)
    if DATASETS[name].keyed:
        lines = records.select(F.create_map(F.col("id").cast("string"), record).alias("data"))
    else:
        lines = placed(records.select(F.array(record).alias("data"))).select("place", "data")
    land_records(lines, layout.payload(name))


def land_entities(spark: SparkSession, layout: Layout, name: str, paths: Sequence[str]) -> None:
    """Land one payload from per-entity payloads; those without data are skipped."""
    land_lines(read_entity_payloads(spark, paths, record_schema(name)), layout, name)


def land_keyed_batches(spark: SparkSession, layout: Layout, name: str, paths: Sequence[str]) -> None:
    """Land one keyed payload from several; a record of a later payload replaces an earlier one, and
    payloads without data are skipped."""
    batches = [read_keyed_envelope(spark, path, record_schema(name), required=False) for path in paths]
    land_lines(require_rows(merge_keyed(batches, "id"), f"no {name} record in any payload"), layout, name)


def load_dataset(spark: SparkSession, layout: Layout, dataset: DataSet, run_ts: datetime) -> int | None:
    """Load one landed payload into its staging table; None when nothing was landed.

    Stamped data sets join their history, current-state ones replace their table as a unit.
    """
    name = dataset.name
    records = read_if_landed(
        spark, layout.payload(name), record_schema(name), dataset.keyed, layout.whole_file(name)
    )
    if records is None:
        return None
    rows = parse(records, dataset)
    if dataset.historical:
        return load_snapshot(rows, layout.history(dataset.name), run_ts, list(dataset.keys))[1]
    create_layers(spark, layout.warehouse, prefix=layout.prefix)
    return replace_table(rows, layout.staging(dataset.name), layout.warehouse).count()


def ingest_dataset(spark: SparkSession, layout: Layout, name: str) -> None:
    """Commit the runs of a stamped data set that have landed since the last call.

    Streaming form of ``load_dataset``: each run is a folder ``run_ts=<time>`` below the payload's
    folder, and is parsed, compared and committed in the order of the runs.
    """
    dataset = DATASETS[name]
    schema = StructType().add("data", ArrayType(record_schema(name))).add("run_ts", TimestampNTZType())
    payloads = spark.readStream.schema(schema).option("multiLine", layout.whole_file(name)).json(layout.payload(name))
    records = payloads.select("run_ts", F.explode("data").alias("_record")).select("run_ts", "_record.*")
    commit = commit_runs(layout.history(name), list(dataset.keys), "run_ts", lambda rows: parse(rows, dataset))
    ingest_available(records, commit, f"{layout.warehouse}/checkpoints/{name}")


def import_csv(spark: SparkSession, layout: Layout, name: str, path: str, run_ts: datetime) -> None:
    """Load a CSV file with header into its staging table, by column name; a large file is read by several tasks.

    A history keeps its stamps, and each of its days is replaced; one that predates stamping is stamped
    with this run. A current-state table is replaced as a unit. A missing file is an error.
    """
    rows = read_csv_split(spark, path)
    if DATASETS[name].historical:
        replace_days(conform(backfill_stamp(rows, run_ts), staging_schema(name)), layout.history(name))
    else:
        create_layers(spark, layout.warehouse, prefix=layout.prefix)
        replace_table(conform(rows, staging_schema(name)), layout.staging(name), layout.warehouse)


def export_csv(spark: SparkSession, layout: Layout, name: str, path: str) -> None:
    """Write a staging table as CSV files with header."""
    write_csv(staging_tables(spark, layout)[name].select(*staging_schema(name).names), path)


def load_group(
    spark: SparkSession, layout: Layout, group: str | None, run_ts: datetime
) -> tuple[dict[str, int], dict[str, str]]:
    """Row counts and errors per data set of a cadence group. One bad data set does not stop others;
    it is an error when none could be loaded."""
    counts: dict[str, int] = {}
    errors: dict[str, str] = {}
    for dataset in datasets_of(group):
        try:
            if dataset.name == "quotes":
                land_quotes(spark, layout)
            rows = load_dataset(spark, layout, dataset, run_ts)
            if rows is not None:
                counts[dataset.name] = rows
        except Exception as error:  # noqa: BLE001 - reported per data set
            errors[dataset.name] = str(error)
    if not counts:
        raise RuntimeError(f"no data set was loaded: {errors or 'nothing landed'}")
    return counts, errors


def staging_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The staging tables as they are now; a data set without a load is an empty table."""
    tables = {}
    for name, dataset in DATASETS.items():
        if dataset.historical:
            schema = stored_schema(name, DAY)
            df = read_history(spark, layout.history(name), schema)
        else:
            schema = stored_schema(name)
            table = layout.staging(name)
            df = spark.table(table) if spark.catalog.tableExists(table) else None
        tables[name] = df if df is not None else spark.createDataFrame([], schema)
    return tables


def newest_batches(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The newest run of each history. Its day and time come from the history's state, so no other day is looked at;
    a history without a load is an empty table."""
    found = {}
    for name, dataset in DATASETS.items():
        if dataset.historical:
            rows = newest_batch(spark, layout.history(name))
            found[name] = rows if rows is not None else spark.createDataFrame([], stored_schema(name, DAY))
    return found


Model = Callable[["Models"], DataFrame]

# Namespace and materialisation of each model. Intermediate models and marts are views;
# dimensions and bridge are tables; the fact is a view, so that it always shows the newest load.
MATERIALISED = {
    "int_coins": ("intermediate_layer", "view"),
    "int_category_snapshot": ("intermediate_layer", "view"),
    "int_coin_market_snapshot": ("intermediate_layer", "view"),
    "int_category_coin_bridge": ("intermediate_layer", "view"),
    "dim_coins": ("olap", "table"),
    "dim_categories": ("olap", "table"),
    "fact_coin_market": ("olap", "view"),
    "bridge_category_coin": ("olap", "table"),
    "vw_market_overview_daily": ("analytics", "view"),
    "vw_coin_explorer": ("analytics", "view"),
    "vw_sector_performance": ("analytics", "view"),
    "vw_coin_momentum_daily": ("analytics", "view"),
    "vw_coin_momentum_latest": ("analytics", "view"),
}


def model_functions(as_of: datetime) -> dict[str, Model]:
    """Each model as a function of the models it reads."""
    return {
        "int_coins": lambda m: core.coins(m["stg_map"], m["stg_info"]),
        "int_category_snapshot": lambda m: core.categories(m["stg_categories"]),
        "int_coin_market_snapshot": lambda m: core.coin_market(m["stg_listings_latest"], m["stg_quotes"], m.tracked),
        "int_category_coin_bridge": lambda m: core.bridge(m["stg_category_details"], m.tracked),
        "dim_coins": lambda m: m["int_coins"].select(*core.DIM_COINS),
        "dim_categories": lambda m: m["int_category_snapshot"].select(*core.DIM_CATEGORIES),
        "fact_coin_market": lambda m: m["int_coin_market_snapshot"].select(*core.FACT),
        "bridge_category_coin": lambda m: m["int_category_coin_bridge"].select(*core.BRIDGE),
        "vw_market_overview_daily": lambda m: marts.market_overview_daily(m["stg_quotes"]),
        "vw_coin_explorer": lambda m: marts.coin_explorer(m["fact_coin_market"], m["dim_coins"], as_of),
        "vw_sector_performance": lambda m: marts.sector_performance(
            m["bridge_category_coin"], m["fact_coin_market"], m["dim_categories"]
        ),
        "vw_coin_momentum_daily": lambda m: marts.coin_momentum_daily(
            m["stg_listings_latest"], m["stg_quotes"], m["dim_coins"]
        ),
        "vw_coin_momentum_latest": lambda m: marts.coin_momentum_latest(
            m["stg_listings_latest"], m["stg_quotes"], m["dim_coins"]
        ),
    }


class Models(dict):
    """Models by name, each declared from the staging tables when it is first asked for."""

    def __init__(self, tables: Mapping[str, DataFrame], as_of: datetime):
        super().__init__()
        self._tables = tables
        self._functions = model_functions(as_of)

    @cached_property
    def tracked(self) -> DataFrame:
        return core.tracked_coins(self["stg_map"])

    def __missing__(self, name: str) -> DataFrame:
        if name in self._functions:
            self[name] = self._functions[name](self)
        else:
            table = name.removeprefix("stg_")
            self[name] = staged(self._tables[table], table)
        return self[name]


def declare_warehouse(spark: SparkSession, layout: Layout) -> None:
    """Namespaces and staging tables; what exists stays as it is."""
    create_layers(spark, layout.warehouse, prefix=layout.prefix)
    create_staging_tables(spark, f"{layout.prefix}staging_layer")


def publish(spark: SparkSession, layout: Layout, as_of: datetime | None = None) -> None:
    """Make the warehouse known by name to every session of the catalog: the histories as tables partitioned by day, and
    all models that aren't tables as views in their namespaces, in the order in which they read each other."""
    declare_warehouse(spark, layout)
    for name, dataset in DATASETS.items():
        if dataset.historical:
            publish_history(spark, layout.history(name), layout.staging(name))
    texts = {f"stg_{name}": staging_view(name, layout.staging(name)) for name in DATASETS}
    create_views(spark, texts | view_sql(layout.model, as_of), layout.model)


def build_models(spark: SparkSession, layout: Layout, as_of: datetime) -> Models:
    """Materialise the models: tables are written and replaced as a unit, the rest become views, both of the catalog
    (``publish``) and, by their bare names, of this session."""
    create_layers(spark, layout.warehouse, prefix=layout.prefix)
    models = Models(staging_tables(spark, layout), as_of)
    for name in DATASETS:
        models[f"stg_{name}"].createOrReplaceTempView(f"stg_{name}")
    for name, (_, kind) in MATERIALISED.items():
        if kind == "table":
            models[name] = replace_table(models[name], layout.model(name), layout.warehouse)
        else:
            models[name].createOrReplaceTempView(name)
    publish(spark, layout, as_of)
    return models


def run_pipeline(spark: SparkSession, layout: Layout, group: str | None, run_ts: datetime) -> DataFrame:
    """Load a cadence group, rebuild the models, and return the row counts per data set."""
    counts, errors = load_group(spark, layout, group, run_ts)
    build_models(spark, layout, run_ts)
    rows = [(n, counts.get(n), errors.get(n)) for n in (d.name for d in datasets_of(group))]
    return spark.createDataFrame(rows, "dataset string, row_count bigint, error string")
