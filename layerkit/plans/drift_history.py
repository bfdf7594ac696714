"""History of schema baselines (D1, K4): what each column was, and from when to when.

A capture of a schema replaces the last baseline, so that drift can only
be told against it. Here captures are kept: each appends the columns
it found (``record_schema``), and the history is read off them
(``schema_history``): one row for each stretch of captures that saw a column
with the same type and nullability, valid from its first capture until the
first one that saw it otherwise or not at all.

Stretches are gaps and islands: captures of a schema are numbered by their
instant; within (column, type, nullability) the capture's number less the
row's number is the same as long as no capture is missing. So captures may
be recorded in any order, and one recorded later with an earlier instant is
fitted in. A capture that is recorded twice replaces itself.

Instants are compared as they are stored (zone-free timestamps).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sinks.tables import drop_partitions, replace_scope
from ..sources.catalog import snapshot_schema
from .drift import KEYS, UNREADABLE, diff_schema

CAPTURE = "_capture"
_MARK = "\x00"  # no table has this name: the row that says a capture took place, even of an empty schema


def record_schema(spark: SparkSession, database: str, log: str, at: dt.datetime | None = None,
                  control_tables=("schema_registry", "schema_drift_log")) -> DataFrame:
    """Append what ``database`` looks like at ``at`` (default: now, UTC) to the captures in ``log``.

    Control tables and the log itself are left out. A table that cannot be
    read is noted with its error, and what was known of it stays in force.
    """
    at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    unreadable: list = []
    snap = snapshot_schema(spark, database, exclude=set(control_tables) | {log.split(".")[-1].strip("`")}, unreadable=unreadable)
    return record_snapshot(snap, database, log, at, unreadable)


def record_snapshot(snap: DataFrame, database: str, log: str, at: dt.datetime, unreadable=()) -> DataFrame:
    """Append a harvested schema (the registry's five columns) as the capture of ``database`` at ``at``."""
    spark = snap.sparkSession
    notes = [(database, _MARK, "", "", True, None)] + [(database, table, "", UNREADABLE, True, error) for table, error in unreadable]
    rows = snap.select(*KEYS, "data_type", "is_nullable", F.lit(None).cast("string").alias("note")).unionByName(spark.createDataFrame(
        notes, "schema_name string, table_name string, column_name string, data_type string, is_nullable boolean, note string"))
    name = f"{database}|{at.isoformat(timespec='microseconds')}"
    rows = rows.withColumns({"captured_at": F.lit(at).cast("timestamp_ntz"), CAPTURE: F.lit(name)})
    replace_scope(rows, log, CAPTURE, name)
    return rows


def forget_capture(spark: SparkSession, database: str, log: str, at: dt.datetime) -> None:
    """Take a capture back, as if it had never been recorded."""
    drop_partitions(spark, log, [{CAPTURE: f"{database}|{at.isoformat(timespec='microseconds')}"}])


def schema_history(captures: DataFrame) -> DataFrame:
    """schema, table, column, data_type, is_nullable, valid_from, valid_to (null: still so), captures.

    A column of a table that a capture could not read counts as seen
    unchanged, if the capture before saw it.
    """
    per_schema = Window.partitionBy("schema_name").orderBy("captured_at")
    # one row for each capture: its number, and when the next one was
    times = (captures.select("schema_name", "captured_at").distinct()
             .withColumns({"seq": F.row_number().over(per_schema), "next_at": F.lead("captured_at").over(per_schema)}))
    seen = captures.filter((F.col("table_name") != _MARK) & (F.col("data_type") != UNREADABLE)).join(times, ["schema_name", "captured_at"])
    seen = seen.select(*KEYS, "data_type", "is_nullable", "seq", "captured_at", "next_at", F.lit(True).alias("read"))
    failed = (captures.filter(F.col("data_type") == UNREADABLE).join(times, ["schema_name", "captured_at"])
              .select("schema_name", "table_name", "seq", "captured_at", "next_at"))
    # a table that could not be read repeats its last columns: numbered runs of failures after a readable capture
    by_table = Window.partitionBy("schema_name", "table_name").orderBy("seq")
    before = Window.partitionBy("schema_name", "table_name").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    states = (seen.select("schema_name", "table_name", "seq", F.lit(True).alias("ok")).distinct()
              .unionByName(failed.select("schema_name", "table_name", "seq", F.lit(False).alias("ok")))
              .withColumns({"step": F.row_number().over(by_table), "first_seq": F.min("seq").over(by_table)})
              .withColumn("last_ok", F.last(F.when(F.col("ok"), F.col("seq")), ignorenulls=True).over(before)))
    # only an unbroken run of failures directly after a capture that read the table
    gone = states.filter("not ok and last_ok is not null and step - 1 >= 1").withColumn(
        "unbroken", F.col("seq") - F.col("last_ok") == F.row_number().over(Window.partitionBy("schema_name", "table_name", "last_ok").orderBy("seq")))
    carried = (gone.filter("unbroken").select("schema_name", "table_name", F.col("last_ok").alias("from_seq"), "seq")
               .join(seen.select(*KEYS, "data_type", "is_nullable", F.col("seq").alias("from_seq")), ["schema_name", "table_name", "from_seq"])
               .join(times, ["schema_name", "seq"])
               .select(*KEYS, "data_type", "is_nullable", "seq", "captured_at", "next_at", F.lit(False).alias("read")))
    every = seen.unionByName(carried)
    same = Window.partitionBy(*KEYS, "data_type", "is_nullable").orderBy("seq")
    islands = every.withColumn("island", F.col("seq") - F.row_number().over(same))
    return islands.groupBy(*KEYS, "data_type", "is_nullable", "island").agg(
        F.min("captured_at").alias("valid_from"), F.max_by("next_at", "seq").alias("valid_to"),
        F.count(F.when(F.col("read"), 1)).alias("captures")).drop("island")


def schema_as_of(history: DataFrame, instants: DataFrame, at: str = "at") -> DataFrame:
    """The columns in force at each of ``instants`` (schema_name, ``at``): instants' columns, then the history's.

    The as-of join is an equi-join on the schema; instants are few (a run,
    an audit), histories are metadata. Before the first capture there is
    nothing.
    """
    named = instants.select(F.col("schema_name").alias("__schema"), *[F.col(c) for c in instants.columns if c != "schema_name"])
    held = history.join(named, history["schema_name"] == named["__schema"]).filter(
        (F.col("valid_from") <= F.col(at)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col(at))))
    return held.drop("__schema")


def drift_between(history: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """COLUMN_ADDED, COLUMN_REMOVED and TYPE_CHANGED from ``start`` to ``end``, over all schemas of the history.

    Rows as of :func:`layerkit.plans.drift.diff_schema`. What changed and
    changed back in between does not show; see the history itself for that.
    """
    def held(at: dt.datetime) -> DataFrame:
        when = F.lit(at).cast("timestamp_ntz")
        return history.filter((F.col("valid_from") <= when) & (F.col("valid_to").isNull() | (F.col("valid_to") > when)))
    return diff_schema(held(start), held(end))
