"""File sources (S1, S2): parquet tables and raw CSV with every column as text."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_parquet_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One parquet table ``{base_dir}/{name}.parquet`` (vectorised, pushdown)."""
    return spark.read.parquet(os.path.join(base_dir, f"{name}.parquet"))


def read_csv(spark: SparkSession, path: str, columns=None, **options) -> DataFrame:
    """Header CSV, every column a string (no schema inference pass).

    ``columns`` gives an explicit all-string schema (skips reading the
    header for names); other keyword options go to the CSV reader
    (``multiLine``, ``quote``, ``escape``, ``mode`` …).
    """
    reader = spark.read.option("header", True)
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType(), True) for c in columns]))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)
