"""Typed staging tables and layer namespaces."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DateType, NullType, StringType, StructField, StructType, VarcharType

from snapmart.operators.history import replace_days, stored_day, stored_state
from snapmart.operators.latest import DAY
from snapmart.operators.versions import NO_DAY, folders
from snapmart.schemas import DATASETS, STAGING_DDL

# Layer namespaces and the default one.
LAYERS = ("staging_layer", "intermediate_layer", "olap", "analytics")
DEFAULT_LAYER = "analytics"


def layer_name(custom: str | None) -> str:
    """The namespace of a model: its own name, or the default."""
    return DEFAULT_LAYER if custom is None else custom.strip()


def create_layers(spark: SparkSession, root: str, names: Iterable[str] = LAYERS, prefix: str = "") -> None:
    """Declare the namespaces below the warehouse folder; existing ones are left as they are."""
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{name} LOCATION '{root.rstrip('/')}/{name}'")


def create_staging_tables(spark: SparkSession, database: str = "staging_layer") -> None:
    """Declare the six staging tables; existing ones, and what they hold, are left as they are.

    A history is partitioned by day; ``publish_history`` points its partitions to what has been loaded.
    """
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    for name, ddl in STAGING_DDL.items():
        day = f", {DAY} DATE" if DATASETS[name].historical else ""
        partitioned = f"PARTITIONED BY ({DAY})" if DATASETS[name].historical else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}{day}) USING parquet {partitioned} LOCATION '{root}/{name}'"
        )


def publish_history(spark: SparkSession, path: str, table: str) -> None:
    """Point the partitions of a declared table to the days of a stored history, as its newest state has them.

    Each day changes in one step and queries that are running keep what they have. Only days that changed since the table
    was last published are touched; a table that showed another history is emptied first (its files stay, as
    the table is external). A day that was added to in several steps is written as one version before.
    """
    state = stored_state(spark, path)
    for day, versions in state.days.items():
        if len(versions) > 1 and day != NO_DAY:
            replace_days(stored_day(spark, path, date.fromisoformat(day), state), path)
    state = stored_state(spark, path)
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    known = json.loads(shown["published_days"]) if shown.get("published_history") == path else {}
    stored = {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    places = {day: folders(path, DAY, {day: versions}) for day, versions in state.days.items() if day != NO_DAY}
    for day in sorted(stored - set(places) | (stored if not known else set())):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({DAY} = DATE '{day}')")
    for day, (versioned, plain) in sorted(places.items()):
        if known.get(day) != state.days[day]:
            place = (versioned + plain)[0]
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({DAY} = DATE '{day}') LOCATION '{place}'")
            spark.sql(f"ALTER TABLE {table} PARTITION ({DAY} = DATE '{day}') SET LOCATION '{place}'")
    days = json.dumps({day: state.days[day] for day in places})
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('published_history' = '{path}', 'published_days' = '{days}')")
    spark.catalog.refreshTable(table)


@cache
def staging_schema(name: str, stamped: bool = True) -> StructType:
    schema = StructType.fromDDL(STAGING_DDL[name])
    return schema if stamped else StructType([f for f in schema.fields if f.name != "inserted_at"])


def stored_schema(name: str, *partitions: str) -> StructType:
    """The staging schema as read back from files: sized texts are plain strings there."""
    fields = [
        StructField(f.name, StringType() if isinstance(f.dataType, VarcharType) else f.dataType)
        for f in staging_schema(name).fields
    ]
    return StructType(fields + [StructField(day, DateType()) for day in partitions])


def _typed(field: StructField, source: DataType) -> str:
    name, kind = f"`{field.name}`", field.dataType
    if isinstance(kind, VarcharType):
        text = f"cast({name} as string)"
        error = f"raise_error('{field.name} is longer than {kind.length}')"
        return f"if(length({text}) > {kind.length}, {error}, {text}) as {name}"
    if source in (kind, NullType()):
        return f"cast({name} as {kind.simpleString()}) as {name}"
    # Checked by hand, so that a bad value also fails in a session without ANSI casts.
    value = f"try_cast({name} as {kind.simpleString()})"
    error = f"raise_error(concat('bad value for {field.name}: ', cast({name} as string)))"
    return f"if({name} is not null and {value} is null, {error}, {value}) as {name}"


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns by name, cast to their declared types; other source columns are ignored.

    A value that does not fit its type fails the query.
    """
    return df.selectExpr(*[_typed(f, df.schema[f.name].dataType) for f in schema.fields])


def replace_table(df: DataFrame, table: str, root: str) -> DataFrame:
    """Replace a table's content as a unit.

    The new content is written in full to a folder of its own; only then is the table pointed to it.
    If a value is bad or a task is lost for good, the table keeps its old content.
    """
    spark = df.sparkSession
    version = f"{root.rstrip('/')}/{table.replace('.', '/')}/v-{uuid.uuid4().hex[:12]}"
    df.write.parquet(version)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{version}'")
    return spark.table(table)
