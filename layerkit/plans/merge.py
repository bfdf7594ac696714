"""Upsert on plain parquet tables.

Parquet tables have no MERGE. The target's rows and the new batch are
unioned and reduced to the latest version per key with
:func:`keep_latest` (partial top-1 before the shuffle, so hot keys stay
cheap). Re-running the same batch is idempotent.

Two write scopes:

* whole table (default): the merged result is written to a staging table
  and swapped in by renames; an interrupted swap is finished first.
* ``scoped=True`` for partitioned tables: only the touched partitions are
  read, merged and rewritten. Touched are those in the batch and those
  that hold one of its keys now (a key may move to another partition; the
  search reads the key and partition columns only). NULL is a partition
  like any other. A partition that loses its last row is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import keep_latest
from ..sinks.tables import drop_partitions, overwrite_from_self, recover_swap, replace_partitions, write_table


def _in_partitions(df: DataFrame, parts: DataFrame, cols) -> DataFrame:
    """Rows of ``df`` in the listed partitions, NULL matching NULL.

    Partitions without NULLs go through an ordinary semi join, which prunes
    the scan at run time; those with a NULL through a NULL-safe one over
    the partitions that have one.
    """
    has_null = None
    for c in cols:
        has_null = F.col(c).isNull() if has_null is None else has_null | F.col(c).isNull()
    plain = df.join(parts.filter(~has_null), on=list(cols), how="left_semi")
    renamed = parts.filter(has_null).select(*[F.col(c).alias(f"__p_{c}") for c in cols])
    same = None
    for c in cols:
        eq = F.col(c).eqNullSafe(F.col(f"__p_{c}"))
        same = eq if same is None else same & eq
    return plain.unionByName(df.filter(has_null).join(renamed, same, "left_semi"))


def upsert(df: DataFrame, table: str, keys, order, tiebreak=None, partition_by=(),
           scoped: bool = False, moves: bool = True) -> int:
    """Insert new keys and replace existing ones by the latest ``order``.

    Returns the number of rows written (whole table, or the touched
    partitions when ``scoped``). Repeating a batch after a failure at any
    step gives the same table. ``moves=False``: the partition is made of the
    key, so no key of the batch can lie in a partition that the batch does
    not name, and the table is not searched for one.
    """
    spark = df.sparkSession
    partition_by = list(partition_by)
    keys = [keys] if isinstance(keys, str) else list(keys)
    recover_swap(spark, table)
    if not spark.catalog.tableExists(table):
        return write_table(keep_latest(df, keys, order, tiebreak), table, "overwrite",
                           partition_by=partition_by)
    current = spark.table(table)
    if not scoped:
        merged = keep_latest(current.unionByName(df, allowMissingColumns=True), keys, order, tiebreak)
        return overwrite_from_self(merged, table, partition_by=partition_by)
    if not partition_by:
        raise ValueError("scoped upsert needs the table's partition columns")
    touched = df.select(*partition_by)
    if moves:
        held = current.select(*keys, *[c for c in partition_by if c not in keys])
        touched = touched.unionByName(
            held.join(df.select(*keys).distinct(), on=keys, how="left_semi").select(*partition_by))
    touched = touched.distinct()
    # partition values are catalog metadata: the driver lists them for every table anyway
    parts = touched.collect()
    touched = spark.createDataFrame(parts, df.select(*partition_by).schema)
    affected = _in_partitions(current, touched, partition_by)
    merged = keep_latest(affected.unionByName(df, allowMissingColumns=True), keys, order, tiebreak)
    # A plan may not overwrite partitions it reads: stage, then replace.
    staging = f"{table}__merge"
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    n = write_table(merged, staging, "overwrite", partition_by=partition_by)
    # dealt by partition already: copied file by file, not shuffled again
    replace_partitions(spark.table(staging).select(*current.columns), table)
    filled = {tuple(r) for r in spark.table(staging).select(*partition_by).distinct().collect()}
    drop_partitions(spark, table, [r.asDict() for r in parts if tuple(r) not in filled])
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    return n
