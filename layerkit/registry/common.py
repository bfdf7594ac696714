"""Shared helpers for the registered driver-table queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import read_parquet_table

# Fixed reference day for age-style derivations, so results repeat.
AS_OF = "2024-06-30"


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_table(spark, sf_dir, name)


def iso_z_text(c):
    """A zone-free timestamp as ``yyyy-MM-ddTHH:mm:ssZ`` text (whole seconds).

    Built from the plain string cast, which does not involve the session
    zone (``date_format`` would convert through it).
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.concat(F.regexp_replace(F.substring(col.cast("string"), 1, 19), " ", "T"), F.lit("Z"))


def money(c: str, precision: int = 12, scale: int = 2):
    """Driver money columns are doubles with two decimals; sum them exactly."""
    return F.col(c).cast(f"decimal({precision},{scale})")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order's customer and date (an equi-join on the key)."""
    li = t(spark, sf_dir, "lineitem")
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
