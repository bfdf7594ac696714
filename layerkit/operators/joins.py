"""Joins and set differences.

A broadcast hint is given only for a driver-side mapping under a row
bound. For DataFrames the plan is left to Spark: its byte threshold and
AQE's runtime statistics decide, without extra jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Mappings with more entries than this get no broadcast hint.
MAX_BROADCAST_ENTRIES = 10_000


def mapping_frame(spark, mapping: dict, key: str, value: str,
                  key_type=StringType(), value_type=StringType()) -> DataFrame:
    """A driver-side dict as a two-column relation (explicit schema)."""
    schema = StructType([StructField(key, key_type, False),
                         StructField(value, value_type, True)])
    return spark.createDataFrame(list(mapping.items()), schema)


def lookup(df: DataFrame, table, on: str, value: str | None = None,
           key_expr: Column | None = None, check_unique: bool = True,
           ignore_case: bool = False) -> DataFrame:
    """Left equi-join to a lookup; unmatched and NULL keys keep a NULL value.

    ``table``    a dict (broadcast up to ``MAX_BROADCAST_ENTRIES`` entries)
                 or a DataFrame (a plain join; Spark picks the strategy)
    ``key_expr`` derives the join key on ``df`` first (e.g. a code prefix)
    ``ignore_case`` upper-cases the derived key (mapping keys must be upper)
    ``check_unique`` (DataFrame tables) fails on repeated mapping keys, which
                 would otherwise multiply the joined rows; one aggregate
                 over the mapping table. NULL keys never match and may repeat
    The join key comes first in the output, as with ``join(on=name)``.
    """
    if key_expr is not None:
        df = df.withColumn(on, key_expr)
    if ignore_case:
        df = df.withColumn(on, F.upper(F.col(on)))
    if isinstance(table, dict):
        if value is None:
            raise ValueError("value column name required for a dict lookup")
        small = mapping_frame(df.sparkSession, table, on, value)
        small = F.broadcast(small) if len(table) <= MAX_BROADCAST_ENTRIES else small
    else:
        if check_unique:
            dups = table.filter(F.col(on).isNotNull()).groupBy(on).count().filter("count > 1")
            if not dups.isEmpty():
                raise ValueError(f"lookup key {on!r} is not unique")
        small = table
    return df.join(small, on=on, how="left")


def left_join_split(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """J4 with skew protection: ``left LEFT JOIN right`` as two branches.

    AQE can split a skewed partition on either side of an *inner* join but
    not the right side of a left outer join. So the matched rows come from
    an inner join (skew-splittable), and the unmatched left rows from an
    anti join against the right side's *distinct* keys (map-side combined,
    so a hot key costs one row per task). The union is the left join.
    The left side is the "one" side of a one-to-many relation (unique keys).
    """
    on = [on] if isinstance(on, str) else list(on)
    matched = left.join(right, on=on, how="inner")
    right_keys = right.select(*on).dropDuplicates(on)
    unmatched = left.join(right_keys, on=on, how="left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def keyed_diff(old: DataFrame, new: DataFrame, keys, value: str,
               labels=("ADDED", "REMOVED", "CHANGED"),
               change_col: str = "change", old_col: str = "old_value",
               new_col: str = "new_value", duplicate_label: str = "DUPLICATE") -> DataFrame:
    """Compare two versions of a keyed relation.

    Both versions are tagged and unioned, then reduced by one aggregate on
    the key: rows per side and each side's value. This gives the rows of
    the two-anti-joins-plus-inner-join form with one shuffle and no join.
    A key that holds a large share of rows is combined map-side, and no
    old × new pairs are ever built. Values are compared NULL-safely, so
    NULL → x is a change.

    Keys are expected to be unique per version. A key that repeats on
    either side is reported once, as ``duplicate_label``, with the largest
    value of each side, and is not multiplied out.
    Output: keys, change, old value, new value.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    added, removed, changed = labels
    tagged = (old.select(*keys, F.col(value).alias("__v"), F.lit(0).alias("__side"))
              .unionByName(new.select(*keys, F.col(value).alias("__v"), F.lit(1).alias("__side"))))
    is_old, is_new = F.col("__side") == 0, F.col("__side") == 1
    g = tagged.groupBy(*keys).agg(
        F.count(F.when(is_old, 1)).alias("__n_old"),
        F.count(F.when(is_new, 1)).alias("__n_new"),
        F.max(F.when(is_old, F.col("__v"))).alias(old_col),
        F.max(F.when(is_new, F.col("__v"))).alias(new_col))
    n_old, n_new = F.col("__n_old"), F.col("__n_new")
    change = (F.when((n_old > 1) | (n_new > 1), F.lit(duplicate_label))
               .when(n_old == 0, F.lit(added))
               .when(n_new == 0, F.lit(removed))
               .when(~F.col(old_col).eqNullSafe(F.col(new_col)), F.lit(changed)))
    return (g.withColumn(change_col, change)
             .filter(F.col(change_col).isNotNull())
             .select(*keys, change_col, old_col, new_col))


def with_scalar(df: DataFrame, scalar: DataFrame, name: str) -> DataFrame:
    """Attach a one-value relation as a constant column.

    Uses an uncorrelated scalar subquery (``DataFrame.scalar``): evaluated
    once per query, no join at all.
    """
    return df.withColumn(name, scalar.scalar())
