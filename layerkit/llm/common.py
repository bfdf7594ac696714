"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.session import ensure_checkpoint_dir


def scratch_uri(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder that spark.checkpoint.dir names.

    The URI keeps its scheme, so executors on other machines reach it.
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage.

    A lost executor recomputes from these files, and every consumer sees the
    same rows.
    """
    spark = df.sparkSession
    path = scratch_uri(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(c: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def shuffle_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
