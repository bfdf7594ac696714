"""Table sinks.

Row counts come from an :class:`Observation` attached to the write, so the
plan runs once (the count does not re-scan the source). Partitioned
writes use a ``REBALANCE`` hint on the partition columns: AQE then splits
a partition value that holds a large share of rows over several tasks
and merges tiny ones, instead of one task per value.
"""

from __future__ import annotations

import datetime as dt
import decimal
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

ANY_SCOPE = object()
GLOBAL_TEMP = "global_temp"
_STAGING, _PREVIOUS = "__staging", "__previous"


def _observed(df: DataFrame):
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _rows(obs) -> int:
    return int(obs.get.get("rows", 0))


def write_table(df: DataFrame, table: str, mode: str = "append", partition_by=(),
                fmt: str = "parquet", bucket_by: tuple | None = None, dealt: bool = False) -> int:
    """K1/K2/K3/K6/K7: save as a managed table; returns rows written.

    ``overwrite`` drops and re-creates the table (schema replaced); the old
    rows are gone before the new ones are complete, and a failed write is
    repeated from its source. :func:`overwrite_from_self` keeps the old
    table until the new one is written.
    ``bucket_by=(n, [cols])`` stores the table in ``n`` hash buckets on
    ``cols``: later joins and aggregates on those columns against another
    table bucketed the same way read co-located buckets and skip the
    shuffle. The rows are hash-partitioned on the bucket columns first, so
    each task writes one file per bucket. ``dealt`` says that the rows are
    rebalanced by the partition columns already.
    """
    partition_by = list(partition_by)
    if bucket_by:
        n, cols = bucket_by[0], list(bucket_by[1])
        df = df.repartition(n, *cols)
    elif partition_by and not dealt:
        df = df.hint("rebalance", *partition_by)
    obs_df, obs = _observed(df)
    w = obs_df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(n, *cols)
    w.saveAsTable(table)
    return _rows(obs)


def sql_literal(value) -> str:
    """A SQL literal of a Python value (NULL, booleans, numbers, dates, stamps, quoted text)."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def drop_partitions(spark, table: str, partitions) -> None:
    """Drop the listed partitions (dicts of column → value)."""
    for part in partitions:
        spec = ", ".join(f"`{c}` = {sql_literal(v)}" for c, v in part.items())
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def replace_partitions(df: DataFrame, table: str, rebalance_by=()) -> int:
    """Overwrite just the partitions that occur in ``df``; returns rows written.

    Dynamic overwrite is a session setting (a write option does not reach
    ``insertInto``), so the insert runs in a session of its own: the
    caller's setting is never touched, and writers in other threads neither
    see nor undo it. Settings and current database are carried over.
    """
    spark = df.sparkSession
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    view = f"lk_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        obs_df, obs = _observed(own.table(f"{GLOBAL_TEMP}.{view}"))
        if rebalance_by:
            obs_df = obs_df.hint("rebalance", *rebalance_by)
        obs_df.write.insertInto(table, overwrite=True)
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(table)
    return _rows(obs)


def replace_scope(df: DataFrame, table: str, scope_col: str, scope_value=ANY_SCOPE) -> int:
    """Replace only the rows of the scopes present in ``df``.

    The table is partitioned by ``scope_col``; only the partitions that
    occur in ``df`` are rewritten, other scopes stay. With ``scope_value``
    (any type, NULL included) rows of another scope fail the write, and an
    empty ``df`` drops that scope's partition, which an overwrite alone
    would not touch. The first run creates the table.
    """
    spark = df.sparkSession
    cols = [c for c in df.columns if c != scope_col] + [scope_col]
    df = df.select(*cols)
    if scope_value is not ANY_SCOPE:
        scope = F.col(scope_col)
        wanted = F.lit(scope_value).cast(df.schema[scope_col].dataType)
        df = df.withColumn(scope_col, F.when(scope.eqNullSafe(wanted), scope).otherwise(
            F.raise_error(F.lit(f"rows outside the scope {scope_value!r}")).cast(df.schema[scope_col].dataType)))
    if not spark.catalog.tableExists(table):
        return write_table(df, table, mode="overwrite", partition_by=[scope_col])
    if df.isEmpty():
        if scope_value is not ANY_SCOPE:
            drop_partitions(spark, table, [{scope_col: scope_value}])
        return 0
    return replace_partitions(df.select(*spark.table(table).columns), table, [scope_col])


def _kept_whole(name: str, old, new):
    """The column as type ``new``; a value that the cast would change fails the query."""
    c = F.col(f"`{name}`")
    if old == new or "map<" in old.simpleString() or old.simpleString() == "void":
        return c.cast(new)
    cast = c.try_cast(new)
    changed = c.isNotNull() & ~cast.try_cast(old).eqNullSafe(c)
    says = F.concat(F.lit(f"{name}: a value does not fit {new.simpleString()}: "), F.coalesce(c.cast("string"), F.lit("null")))
    return F.when(changed, F.raise_error(says).cast(new)).otherwise(cast)


def append_evolving(df: DataFrame, table: str, skip_empty: bool = True) -> int:
    """K5/K8: append, adding new columns to the table first.

    Columns only in ``df`` are added with ``ALTER TABLE ADD COLUMNS``;
    columns only in the table are filled with NULL. With ``skip_empty`` an
    empty batch writes nothing (and creates no table). A value that would
    not come back from the table's type as it was (1.75 into an int column)
    fails the append; :func:`layerkit.sinks.evolving.append_widening` widens
    the column instead.
    """
    spark = df.sparkSession
    if skip_empty and df.isEmpty():
        return 0
    if not spark.catalog.tableExists(table):
        return write_table(df, table, mode="overwrite")
    target = spark.table(table).schema
    have = {f.name.lower() for f in target.fields}
    extra = [f for f in df.schema.fields if f.name.lower() not in have]
    if extra:
        spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({spec})")
        target = spark.table(table).schema
    present = {c.lower(): c for c in df.columns}
    given = {f.name: f.dataType for f in df.schema.fields}
    aligned = df.select(*[
        (_kept_whole(present[f.name.lower()], given[present[f.name.lower()]], f.dataType) if f.name.lower() in present
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target.fields])
    obs_df, obs = _observed(aligned)
    obs_df.write.insertInto(table)
    return _rows(obs)


def recover_swap(spark, table: str) -> None:
    """Finish or undo a swap that was cut off (see :func:`overwrite_from_self`).

    Table missing, old copy there: the new copy was complete when the old
    one moved, so the swap is finished. Table there: leftovers are dropped.
    """
    staging, previous = f"{table}{_STAGING}", f"{table}{_PREVIOUS}"
    exists = spark.catalog.tableExists
    if not exists(table) and exists(previous):
        spark.sql(f"ALTER TABLE {staging if exists(staging) else previous} RENAME TO {table}")
    if exists(table):
        relocate_partitions(spark, table)
        for left in (staging, previous):
            spark.sql(f"DROP TABLE IF EXISTS {left}")


def relocate_partitions(spark, table: str) -> None:
    """Let a renamed table's partitions follow it.

    A rename moves the folder of a managed table; some catalogs (Spark's
    in-memory one) leave the partitions at their old places, where nothing
    is any more. Partitions that are under the table's folder are not touched.
    """
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "# Partition Information" not in about:
        return
    home = about["Location"].rstrip("/")
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = ", ".join(f"`{k}` = {'NULL' if v == '__HIVE_DEFAULT_PARTITION__' else sql_literal(unquote(v))}"
                         for k, v in (p.split("=", 1) for p in r[0].split("/")))
        place = {x[0]: x[1] for x in spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").collect()}["Location"]
        if not place.startswith(f"{home}/"):
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {sql_literal(f'{home}/{r[0]}')}")
    spark.catalog.refreshTable(table)


def overwrite_from_self(df: DataFrame, table: str, partition_by=()) -> int:
    """H7: overwrite a table with a plan that reads it.

    Spark refuses to overwrite a table its own plan reads, so the result is
    written to ``<table>__staging`` first; then the old table moves to
    ``<table>__previous``, the new one takes its name, the old one is
    dropped. The names are fixed: after a failure between the renames,
    :func:`recover_swap` (called by ``upsert`` before it looks at the
    table, and here) finds both copies and finishes the swap. One writer
    per table at a time.
    """
    spark = df.sparkSession
    staging, previous = f"{table}{_STAGING}", f"{table}{_PREVIOUS}"
    recover_swap(spark, table)
    n = write_table(df, staging, mode="overwrite", partition_by=partition_by)
    spark.sql(f"ALTER TABLE {table} RENAME TO {previous}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    if partition_by:
        relocate_partitions(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {previous}")
    return n


def show_preview(df: DataFrame, n: int = 20) -> None:
    """K9: console preview (an action; for notebooks and logs)."""
    df.show(n, truncate=False)
