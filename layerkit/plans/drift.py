"""Schema drift (D1–D3): registry snapshot, three-way diff, append-only log.

The registry is partitioned by ``schema_name`` so capturing one schema
replaces only its own baseline (dynamic partition overwrite). The diff is
the generic :func:`keyed_diff` on (schema, table, column) over the type
text; nullability is recorded but, as in the original rule, not compared.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import keyed_diff
from ..sinks.tables import append_evolving, replace_scope
from ..sources.catalog import snapshot_schema

DRIFT_LABELS = ("COLUMN_ADDED", "COLUMN_REMOVED", "TYPE_CHANGED")
UNREADABLE = "TABLE_UNREADABLE"
KEYS = ["schema_name", "table_name", "column_name"]


def _now_literal():
    # One fixed instant per call: every re-evaluation of the plan (count,
    # write, show) sees the same stamp.
    return F.lit(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")


def _short(name: str) -> str:
    return name.split(".")[-1].strip("`")


def capture_schema(spark: SparkSession, database: str, registry: str,
                   control_tables=("schema_registry", "schema_drift_log")) -> DataFrame:
    """Snapshot ``database`` into ``registry`` (replacing its own scope).

    A table that cannot be read does not stop the others: it keeps the
    baseline it had, and its error is printed.
    """
    exclude = set(control_tables) | {_short(registry)}
    unreadable: list = []
    snap = snapshot_schema(spark, database, exclude=exclude, unreadable=unreadable)
    ts = _now_literal()
    snap = snap.withColumns({"_registered_at": ts, "updated_at": ts})
    for name, error in unreadable:
        print(f"{database}.{name}: {UNREADABLE}: {error}")
    if unreadable and spark.catalog.tableExists(registry):
        kept = spark.table(registry).filter((F.col("schema_name") == database) & F.col("table_name").isin([name for name, _ in unreadable]))
        # driver-side rows: the plan may not read the partition it replaces; a few rows for each unreadable table
        snap = snap.unionByName(spark.createDataFrame(kept.select(*snap.columns).collect(), snap.schema))
    replace_scope(snap, registry, "schema_name", database)
    return snap


def diff_schema(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """D2 core: ADDED / REMOVED / TYPE_CHANGED rows between two snapshots."""
    d = keyed_diff(baseline.select(*KEYS, "data_type"), current.select(*KEYS, "data_type"),
                   KEYS, "data_type", labels=DRIFT_LABELS, change_col="drift_type")
    return d.select(*KEYS, "drift_type", "old_value", "new_value")


def detect_drift(spark: SparkSession, database: str, registry: str, log: str,
                 control_tables=("schema_registry", "schema_drift_log")) -> DataFrame:
    """Compare ``database`` with its baseline; append events to ``log``.

    Raises when no baseline exists for the schema. The log is written only
    when there are events (K8) and gains new columns additively (K5).
    """
    if not spark.catalog.tableExists(registry):
        raise ValueError(f"no schema baseline: {registry} does not exist")
    baseline = spark.table(registry).filter(F.col("schema_name") == database)
    if baseline.isEmpty():
        raise ValueError(f"no schema baseline for {database!r} in {registry}")
    exclude = set(control_tables) | {_short(registry), _short(log)}
    unreadable: list = []
    current = snapshot_schema(spark, database, exclude=exclude, unreadable=unreadable)
    if unreadable:
        # neither removed nor unchanged: not compared, and reported with its error
        baseline = baseline.filter(~F.col("table_name").isin([name for name, _ in unreadable]))
    drift = diff_schema(baseline, current)
    failed = spark.createDataFrame([(database, name, "", UNREADABLE, None, error) for name, error in unreadable], drift.schema)
    drift = (drift.unionByName(failed) if unreadable else drift).withColumn("_detected_at", _now_literal())
    append_evolving(drift, log, skip_empty=True)
    return drift


def run_drift_check(spark: SparkSession, databases, registry: str, log: str) -> DataFrame:
    """D3: drift over several schemas, one combined result."""
    out = None
    for db in databases:
        d = detect_drift(spark, db, registry, log)
        out = d if out is None else out.unionByName(d)
    return out
