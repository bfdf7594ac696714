"""Incremental reads (E2): high-water marks, batch and streaming forms.

Both forms are idempotent under retries, so a lost executor, a failed
job or a restarted driver never duplicates or drops rows:

Batch form: a control table holds the marks (typed like the watched
column; one control table per column type). A run first fixes its upper
bound, the largest stamp it can see now, and reads only the rows after the
mark and up to that bound; a row that arrives meanwhile has a later stamp
or is found by the next run. The rows go into the target partition named
by the starting mark (``_since``); the bound becomes the new mark. If the
run dies before the mark is recorded, the re-run starts from the same mark
and replaces the same partition. No rows reach the driver.

Rows that carry the mark's own stamp but arrive after it was set are
missed by a strict comparison. With ``keys`` a run also reads the rows
equal to the mark and leaves out those already loaded (by key). Rows
without a stamp have no place in the order: every run replaces the
partition ``unstamped`` by all rows that have none now, so none is lost.

Streaming form: a file-source ``readStream`` with ``trigger(availableNow)``
processes every file not yet recorded in the checkpoint, then stops. Each
micro-batch overwrites its own ``_batch`` partition, so a batch replayed
after a failure replaces itself. The checkpoint lives in the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.tables import replace_scope, write_table

SINCE_COL = "_since"
BATCH_COL = "_batch"
_EPOCH = "1900-01-01 00:00:00"
UNSTAMPED = "unstamped"


def read_since(df: DataFrame, col: str, mark: str | None) -> DataFrame:
    """Rows with ``col`` strictly after ``mark`` (all rows if mark is None).

    ``mark`` is Spark's own text form of a value of the column's type; it
    is cast back to that type, so the filter is a literal that reaches the
    parquet scan (row groups and files older than the mark are skipped)
    and, for zone-free timestamps, does not depend on the session zone.
    """
    if mark is None:
        return df
    return df.filter(F.col(col) > F.lit(mark).cast(df.schema[col].dataType))


def current_mark(spark: SparkSession, control: str, source: str) -> str | None:
    """The source's high-water mark as text (one aggregate row)."""
    if not spark.catalog.tableExists(control):
        return None
    row = (spark.table(control).filter(F.col("source") == source)
           .agg(F.max("mark").cast("string").alias("m")).first())
    return row["m"] if row else None


def incremental_append(df: DataFrame, col: str, target: str, control: str, source: str,
                       keys=None) -> int:
    """Load the rows that are new since the source's mark, then record the new mark.

    ``keys`` (names) identify a row among those that carry the mark's own
    stamp; without them such late rows are not loaded. Returns the number
    of stamped rows written.
    """
    spark = df.sparkSession
    mark = current_mark(spark, control, source)
    typ = df.schema[col].dataType
    top = df.agg(F.max(col).cast("string").alias("top")).first()["top"]
    since = mark if mark is not None else _EPOCH
    bound = F.lit(top).cast(typ)
    new = read_since(df, col, mark).filter(F.col(col) <= bound)
    keys = [keys] if isinstance(keys, str) else list(keys or ())
    if keys and mark is not None and spark.catalog.tableExists(target):
        at_mark = F.col(col) == F.lit(mark).cast(typ)
        # this run's own partition is about to be replaced, so it does not count as loaded
        loaded = spark.table(target).filter(at_mark & (F.col(SINCE_COL) != since)).select(*keys).distinct()
        new = new.unionByName(df.filter(at_mark).join(loaded, on=keys, how="left_anti").select(*df.columns))
        staging = f"{target}__load"          # the plan reads the table it writes to
        write_table(new.withColumn(SINCE_COL, F.lit(since)), staging, mode="overwrite")
        new = spark.table(staging).drop(SINCE_COL)
    n = replace_scope(new.withColumn(SINCE_COL, F.lit(since)), target, SINCE_COL, since)
    replace_scope(df.filter(F.col(col).isNull()).withColumn(SINCE_COL, F.lit(UNSTAMPED)),
                  target, SINCE_COL, UNSTAMPED)
    if keys:
        spark.sql(f"DROP TABLE IF EXISTS {target}__load")
    if top is not None and top != mark:
        write_table(spark.range(1).select(F.lit(source).alias("source"), bound.alias("mark")), control, mode="append")
    return n


def stream_new_files(spark: SparkSession, path: str, schema, target: str,
                     checkpoint: str, fmt: str = "parquet") -> None:
    """Process all not-yet-seen files under ``path`` into ``target``, then stop."""
    stream = spark.readStream.format(fmt).schema(schema).load(path)

    def _write(batch: DataFrame, epoch: int) -> None:
        replace_scope(batch.withColumn(BATCH_COL, F.lit(epoch).cast("long")),
                      target, BATCH_COL, epoch)

    q = (stream.writeStream.foreachBatch(_write)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    # micro-batches run in a session of their own; this one may have listed the table's files before
    if spark.catalog.tableExists(target):
        spark.catalog.refreshTable(target)
