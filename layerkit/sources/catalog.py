"""Catalog sources (S3–S9): tables, existence, namespaces, named sources,
inline relations and the column-level schema harvest used by drift checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

# The columns of the schema registry.
REGISTRY_SCHEMA = StructType([
    StructField("schema_name", StringType(), False),
    StructField("table_name", StringType(), False),
    StructField("column_name", StringType(), False),
    StructField("data_type", StringType(), False),
    StructField("is_nullable", BooleanType(), False),
])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by (qualified) name."""
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    """S7."""
    return spark.catalog.tableExists(name)


def use_database(spark: SparkSession, name: str) -> None:
    """Select the session's current namespace."""
    spark.catalog.setCurrentDatabase(name)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """A namespace whose managed tables live under ``location`` (shared storage)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")
    return name


def register_sources(spark: SparkSession, sources: dict) -> None:
    """Name → DataFrame or table name, exposed as temp views for SQL models."""
    for view, src in sources.items():
        df = spark.table(src) if isinstance(src, str) else src
        df.createOrReplaceTempView(view)


def snapshot_schema(spark: SparkSession, database: str, exclude=(), unreadable: list | None = None) -> DataFrame:
    """One row per column of every (non-temporary) table in ``database``.

    Only catalog metadata crosses the driver (column names and types).
    Types are ``simpleString`` text (``string``, ``decimal(10,2)``).
    Control tables named in ``exclude`` are skipped. A table whose schema
    cannot be read is added to ``unreadable`` as (table, error), so that the
    others are still harvested; without that list it raises.
    """
    skip = {e.lower() for e in exclude}
    rows = []
    for tb in spark.catalog.listTables(database):
        if tb.isTemporary or tb.name.lower() in skip:
            continue
        try:
            fields = spark.table(f"`{database}`.`{tb.name}`").schema.fields
        except Exception as e:  # noqa: BLE001 - isolate one table's failure
            if unreadable is None:
                raise
            unreadable.append((tb.name, f"{type(e).__name__}: {e}"))
            continue
        rows += [(database, tb.name, f.name, f.dataType.simpleString(), f.nullable) for f in fields]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)
