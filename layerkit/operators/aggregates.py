"""Aggregation helpers (A1–A10) and model-test style quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frequency(df: DataFrame, c: str, name: str = "count") -> DataFrame:
    """A10: value frequency (NULL is its own group)."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias(name))


def quality_checks(df: DataFrame, key, not_null=(), parent: DataFrame | None = None,
                   parent_key: str | None = None, fk: str | None = None) -> DataFrame:
    """Unique / not-null / referential checks as one summary row.

    ``duplicate_keys``   key values that occur more than once
    ``null_<c>``         NULL count per listed column
    ``orphan_rows``      rows whose ``fk`` has no ``parent_key`` in ``parent``
    Keys and NULLs are counted in one keyed pass (map-side combined) that
    is rolled up; the orphan check is the second and last scan.
    """
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"__null_{i}") for i, c in enumerate(not_null)])
    zero = F.lit(0).cast("long")
    out = per_key.agg(
        F.coalesce(F.sum("__n"), zero).alias("row_count"),
        *[F.coalesce(F.sum(f"__null_{i}"), zero).alias(f"null_{c}") for i, c in enumerate(not_null)],
        F.count(F.when(F.col("__n") > 1, 1)).alias("duplicate_keys"))
    if parent is not None:
        pk = parent.select(F.col(parent_key).alias("__pk")).dropDuplicates()
        orphans = (df.select(F.col(fk).alias("__fk")).filter(F.col("__fk").isNotNull())
                     .join(pk, F.col("__fk") == F.col("__pk"), "left_anti")
                     .agg(F.count(F.lit(1)).alias("orphan_rows")))
        out = out.withColumn("orphan_rows", orphans.scalar())
    return out
