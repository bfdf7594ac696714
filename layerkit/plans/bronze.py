"""Raw-layer ingestion (B1–B3): text columns plus audit stamps, appended."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.columns import stamp
from ..sinks.tables import write_table
from ..sources.files import read_csv

STATUS_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("status", StringType(), False),
    StructField("row_count", LongType(), True),
    StructField("error", StringType(), True),
])


@dataclass(frozen=True)
class CsvSource:
    """Where raw CSV files land and how raw tables are named."""
    base_path: str
    target_database: str
    prefix: str

    def path(self, table: str) -> str:
        return os.path.join(self.base_path, f"{table}.csv")

    def target(self, table: str) -> str:
        return f"{self.target_database}.{self.prefix}_{table}"


def ingest(df: DataFrame, source_label: str, target_table: str, mode: str = "append") -> int:
    """Stamp ``_ingested_at`` and ``_source_file``; write; return rows."""
    stamped = stamp(df, "_ingested_at", "_source_file", source_label)
    return write_table(stamped, target_table, mode=mode)


def ingest_csv_table(spark: SparkSession, src: CsvSource, table: str, **csv_options) -> int:
    """B1: one CSV file (all columns text) into its raw table."""
    path = src.path(table)
    return ingest(read_csv(spark, path, **csv_options), path, src.target(table))


def ingest_all(spark: SparkSession, src: CsvSource, tables, stop_on_error: bool = False,
               parallel: int = 4, **csv_options) -> DataFrame:
    """Ingest many tables; one status row per table (see :func:`ingest_status`)."""
    rows = ingest_status(spark, src, tables, stop_on_error, parallel, **csv_options)
    return spark.createDataFrame([tuple(r.values()) for r in rows], STATUS_SCHEMA)


def ingest_status(spark: SparkSession, src: CsvSource, tables, stop_on_error: bool = False,
                  parallel: int = 4, **csv_options) -> list[dict]:
    """Ingest many tables; one status record per table.

    A failing table does not stop the others (unless ``stop_on_error``);
    its row shows ``status = 'error'`` and the message, so callers can
    decide before cleaning runs on stale raw data. Each table is its own
    distributed job; up to ``parallel`` of them are submitted together.
    """
    def one(table):
        try:
            return (table, "ok", ingest_csv_table(spark, src, table, **csv_options), None)
        except Exception as e:  # noqa: BLE001 - isolate one table's failure
            if stop_on_error:
                raise
            return (table, "error", None, f"{type(e).__name__}: {e}")

    tables = list(tables)
    if parallel <= 1 or len(tables) <= 1:
        status = [one(t) for t in tables]
    else:
        with ThreadPoolExecutor(max_workers=min(parallel, len(tables))) as pool:
            status = list(pool.map(one, tables))
    return [dict(zip(STATUS_SCHEMA.names, row)) for row in status]


def ingest_table_source(spark: SparkSession, source_table: str, target_table: str) -> int:
    """A catalog table (typed) into the raw layer with the same stamps."""
    return ingest(spark.table(source_table), source_table, target_table)
