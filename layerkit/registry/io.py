"""Source, sink, drift and incremental queries on the driver tables.

Every query writes into a fresh namespace whose managed tables live under
the session's shared scratch folder (``spark.checkpoint.dir``), then
returns a read of what it wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..plans.bronze import CsvSource, ingest_all, ingest_csv_table, ingest_table_source
from ..plans.drift import capture_schema, run_drift_check
from ..plans.merge import upsert
from ..operators.aggregates import quality_checks
from ..session import scratch_path
from ..sinks.tables import append_evolving, replace_scope, write_table
from ..sources.catalog import create_database, register_sources, table_exists, use_database
from ..streaming.incremental import incremental_append, stream_new_files
from ..streaming.latest import keep_latest_stream, read_latest
from .common import t
from .models import ORACLE as MODEL_SQL
from .models import supplier_metrics


def scratch_db(spark, label: str) -> str:
    name = f"lk_{label}_{uuid.uuid4().hex[:10]}"
    return create_database(spark, name, scratch_path(spark, name))


def _customer_text_ready(spark, sf_dir):
    return t(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))


def csv_scan_audit(spark, sf_dir):
    """CSV landed from ``customer`` → text raw table with stamps."""
    db = scratch_db(spark, "csv")
    land = scratch_path(spark, "landing")
    _customer_text_ready(spark, sf_dir).write.option("header", True).csv(f"{land}/customer.csv")
    src = CsvSource(land, db, "raw")
    ingest_csv_table(spark, src, "customer")
    raw = spark.table(src.target("customer"))
    return raw.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                      F.col("_source_file").endswith("customer.csv").alias("source_is_csv"),
                      F.col("_ingested_at").isNotNull().alias("has_ingest_time"))


def csv_batch_ingest(spark, sf_dir):
    """Several CSV tables, one missing → per-table status rows."""
    db = scratch_db(spark, "batch")
    land = scratch_path(spark, "landing")
    _customer_text_ready(spark, sf_dir).write.option("header", True).csv(f"{land}/customer.csv")
    t(spark, sf_dir, "nation").write.option("header", True).csv(f"{land}/nation.csv")
    t(spark, sf_dir, "orders").write.option("header", True).csv(f"{land}/orders.csv")
    status = ingest_all(spark, CsvSource(land, db, "raw"),
                        ["customer", "nation", "orders", "claims"])
    return status.select("table_name", "status", "row_count")


def table_scan(spark, sf_dir):
    """Managed table → raw copy → named source → SQL."""
    db = scratch_db(spark, "scan")
    write_table(t(spark, sf_dir, "orders"), f"{db}.orders", mode="overwrite")
    previous = spark.catalog.currentDatabase()
    use_database(spark, db)
    try:
        # an unqualified name: found only in the namespace just selected
        if not table_exists(spark, "orders"):
            raise RuntimeError("table was not created, or the namespace was not selected")
        ingest_table_source(spark, "orders", f"{db}.raw_orders")
    finally:
        use_database(spark, previous)
    view = f"src_orders_{db}"
    register_sources(spark, {view: f"{db}.raw_orders"})
    return spark.sql(f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               _ingested_at IS NOT NULL AS has_stamp, endswith(_source_file, 'orders') AS from_orders
        FROM {view}""")


def append_roundtrip(spark, sf_dir):
    """K1: the same batch appended twice is kept twice."""
    db = scratch_db(spark, "append")
    o = t(spark, sf_dir, "orders")
    write_table(o, f"{db}.orders", mode="append")
    write_table(o, f"{db}.orders", mode="append")
    return spark.table(f"{db}.orders")


def overwrite_partitioned(spark, sf_dir):
    """K2/K3/DER4: partitioned overwrite by year/month, run twice (no duplicates)."""
    db = scratch_db(spark, "part")
    o = t(spark, sf_dir, "orders").withColumns(
        {"order_year": F.year("o_orderdate"), "order_month": F.month("o_orderdate")})
    write_table(o, f"{db}.orders", mode="overwrite", partition_by=["order_year", "order_month"])
    write_table(o, f"{db}.orders", mode="overwrite", partition_by=["order_year", "order_month"])
    return spark.table(f"{db}.orders")


def scoped_replace(spark, sf_dir):
    """Replace one scope, empty another, leave the rest untouched."""
    db = scratch_db(spark, "scope")
    tbl = f"{db}.customers"
    c = t(spark, sf_dir, "customer").withColumn("c_mktsegment", F.when(
        F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).otherwise(F.lit("O'MACHINE")))
    replace_scope(c, tbl, "c_mktsegment")
    replace_scope(c.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 0)),
                  tbl, "c_mktsegment", "BUILDING")
    replace_scope(c.filter(F.col("c_mktsegment") == "O'MACHINE").filter(F.lit(False)),
                  tbl, "c_mktsegment", "O'MACHINE")
    return spark.table(tbl)


def append_evolve(spark, sf_dir):
    """K5/K8: a later batch adds a column; an empty batch writes nothing."""
    db = scratch_db(spark, "evolve")
    tbl = f"{db}.orders"
    o = t(spark, sf_dir, "orders")
    append_evolving(o.filter(F.lit(False)), tbl)
    made = table_exists(spark, tbl)
    append_evolving(o.filter(F.col("o_orderstatus") == "F").drop("o_orderpriority"), tbl)
    append_evolving(o.filter(F.col("o_orderstatus") != "F"), tbl)
    append_evolving(o.filter(F.lit(False)), tbl)
    return spark.table(tbl).withColumn("made_by_empty_batch", F.lit(made))


def materialise_model(spark, sf_dir):
    """K6: a summary model materialised as a table (CTAS)."""
    db = scratch_db(spark, "model")
    write_table(supplier_metrics(spark, sf_dir), f"{db}.supplier_metrics", mode="overwrite")
    return spark.table(f"{db}.supplier_metrics")


def observed_count(spark, sf_dir):
    """K7/A2: rows counted by an observation on the write vs. rows in the table."""
    db = scratch_db(spark, "count")
    n = write_table(t(spark, sf_dir, "lineitem"), f"{db}.lineitem", mode="overwrite")
    return (spark.table(f"{db}.lineitem").agg(F.count(F.lit(1)).alias("rows_in_table"))
            .select(F.lit(n).cast("bigint").alias("rows_written"), "rows_in_table"))


def schema_drift(spark, sf_dir):
    """Baselines for two schemas; one drifts (add / drop /
    retype columns, new table), the other stays as it was."""
    db = scratch_db(spark, "drift")
    steady = scratch_db(spark, "steady")
    ctl = scratch_db(spark, "ctl")
    registry, log = f"{ctl}.schema_registry", f"{ctl}.schema_drift_log"
    write_table(t(spark, sf_dir, "orders"), f"{db}.orders_t", mode="overwrite")
    write_table(t(spark, sf_dir, "customer"), f"{db}.customer_t", mode="overwrite")
    write_table(t(spark, sf_dir, "supplier"), f"{steady}.supplier_t", mode="overwrite")
    capture_schema(spark, db, registry)
    capture_schema(spark, steady, registry)
    changed = (t(spark, sf_dir, "orders").drop("o_orderpriority")
               .withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
               .withColumn("order_year", F.year("o_orderdate")))
    write_table(changed, f"{db}.orders_t", mode="overwrite")
    write_table(t(spark, sf_dir, "nation"), f"{db}.nation_t", mode="overwrite")
    run_drift_check(spark, [db, steady], registry, log)
    return spark.table(log).select("table_name", "column_name", "drift_type",
                                   "old_value", "new_value",
                                   F.col("_detected_at").isNotNull().alias("has_detected_at"))


def upsert_q(spark, sf_dir):
    """Two overlapping batches merged; the later batch wins per key."""
    db = scratch_db(spark, "upsert")
    tbl = f"{db}.orders"
    o = t(spark, sf_dir, "orders")
    b1 = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
          .withColumn("batch_no", F.lit(1))
    b2 = (o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
           .withColumn("o_orderpriority",
                       F.when(F.col("o_orderstatus") == "O", F.lit("1-URGENT"))
                        .otherwise(F.col("o_orderpriority")))
           .withColumn("batch_no", F.lit(2)))
    upsert(b1, tbl, "o_orderkey", "batch_no")
    upsert(b2, tbl, "o_orderkey", "batch_no")
    return spark.table(tbl)


def upsert_partitioned(spark, sf_dir):
    """E1 at scale: only touched partitions are rewritten. The year is NULL for
    some orders, and some orders move to the next year with the second batch."""
    db = scratch_db(spark, "upsertp")
    tbl = f"{db}.orders"
    o = t(spark, sf_dir, "orders")
    year = F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate"))
    moved = F.when(F.col("o_orderkey") % 10 == 0, year + 1).otherwise(year)
    b1 = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
          .withColumns({"batch_no": F.lit(1), "order_year": year})
    b2 = (o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
           .filter(~((F.col("o_orderstatus") == "P") & (F.col("o_custkey") % 2 == 1)))
           .withColumn("o_orderpriority",
                       F.when(F.col("o_orderstatus") == "O", F.lit("1-URGENT"))
                        .otherwise(F.col("o_orderpriority")))
           .withColumns({"batch_no": F.lit(2), "order_year": moved}))
    upsert(b1, tbl, "o_orderkey", "batch_no", partition_by=["order_year"], scoped=True)
    upsert(b2, tbl, "o_orderkey", "batch_no", partition_by=["order_year"], scoped=True)
    return spark.table(tbl)


def incremental_read(spark, sf_dir):
    """E2 (batch): stamps are months, so the second snapshot brings rows with the
    mark's own stamp; some rows have no stamp; the third run finds nothing new."""
    db = scratch_db(spark, "incr")
    o = t(spark, sf_dir, "orders").withColumn(
        "stamp", F.when(F.col("o_orderkey") % 97 != 0, F.trunc("o_orderdate", "month")))
    first = o.filter(F.col("o_orderdate") < F.lit("1997-12-15").cast("timestamp_ntz"))
    for snapshot in (first, o, o):
        incremental_append(snapshot, "stamp", f"{db}.orders", f"{db}.marks", "orders", keys="o_orderkey")
    return spark.table(f"{db}.orders").drop("_since")


def stream_ingest(spark, sf_dir):
    """E2 (streaming): files landed in two drops, each processed exactly once."""
    db = scratch_db(spark, "stream")
    land = scratch_path(spark, "stream-landing")
    ckpt = scratch_path(spark, "stream-checkpoint")
    o = t(spark, sf_dir, "orders")
    cutoff = F.lit("1998-01-01").cast("timestamp_ntz")
    o.filter(F.col("o_orderdate") < cutoff).write.parquet(f"{land}/drop1")
    stream_new_files(spark, f"{land}/*", o.schema, f"{db}.orders", ckpt)
    o.filter(F.col("o_orderdate") >= cutoff).write.parquet(f"{land}/drop2")
    stream_new_files(spark, f"{land}/*", o.schema, f"{db}.orders", ckpt)
    return spark.table(f"{db}.orders").drop("_batch")


def stream_keep_latest(spark, sf_dir):
    """W1 under E2: three drops of versions with repeats, rows out of order and late ones; a restart before each."""
    db, land, ckpt = scratch_db(spark, "latest"), scratch_path(spark, "latest-landing"), scratch_path(spark, "latest-checkpoint")
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").alias("changed_at"))
    drops = [o.filter("o_orderstatus = 'F'"),
             o.filter("o_orderkey % 3 = 0").withColumns({"o_orderpriority": F.lit("CHANGED"), "changed_at": F.col("changed_at") + F.expr("interval 10 days")})
             .unionByName(o.filter("o_orderkey % 4 = 0")),
             o.withColumns({"o_orderpriority": F.lit("LATE"), "changed_at": F.col("changed_at") - F.expr("interval 100 days")})
             .unionByName(o.filter("o_orderkey % 10 = 0").withColumn("o_orderpriority", F.lit("TIED")))]
    for n, rows in enumerate(drops):
        rows.write.parquet(f"{land}/drop{n}")
        keep_latest_stream(spark.readStream.schema(o.schema).parquet(f"{land}/*"), "o_orderkey", "changed_at", f"{db}.orders", ckpt,
                           buckets=4)
    return read_latest(spark, f"{db}.orders")


def quality_checks_q(spark, sf_dir):
    """Duplicate keys, NULL counts and orphans for line items."""
    return quality_checks(t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                          not_null=["l_partkey", "l_shipdate"],
                          parent=t(spark, sf_dir, "orders"), parent_key="o_orderkey",
                          fk="l_orderkey")


QUERIES = {
    "csv_scan_audit": csv_scan_audit,
    "csv_batch_ingest": csv_batch_ingest,
    "table_scan": table_scan,
    "append_roundtrip": append_roundtrip,
    "overwrite_partitioned": overwrite_partitioned,
    "scoped_replace": scoped_replace,
    "append_evolve": append_evolve,
    "materialise_model": materialise_model,
    "observed_count": observed_count,
    "schema_drift": schema_drift,
    "upsert": upsert_q,
    "upsert_partitioned": upsert_partitioned,
    "incremental_read": incremental_read,
    "stream_ingest": stream_ingest,
    "stream_keep_latest": stream_keep_latest,
    "quality_checks": quality_checks_q,
}

_ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

ORACLE = {
    "csv_scan_audit": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal, c_mktsegment,
       TRUE AS source_is_csv, TRUE AS has_ingest_time
FROM customer
""",
    "csv_batch_ingest": """
SELECT 'customer' AS table_name, 'ok' AS status, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 'nation', 'ok', COUNT(*) FROM nation
UNION ALL SELECT 'orders', 'ok', COUNT(*) FROM orders
UNION ALL SELECT 'claims', 'error', CAST(NULL AS BIGINT)
""",
    "table_scan": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       TRUE AS has_stamp, TRUE AS from_orders
FROM orders
""",
    "append_roundtrip": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "overwrite_partitioned": """
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_month
FROM orders
""",
    "scoped_replace": """
SELECT * FROM customer
WHERE (c_mktsegment <> 'BUILDING' OR c_acctbal > 0) AND c_mktsegment <> 'MACHINERY'
""",
    "append_evolve": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority, FALSE AS made_by_empty_batch
FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT {_ORDERS_COLS}, FALSE FROM orders WHERE o_orderstatus <> 'F'
""",
    "observed_count": "SELECT COUNT(*) AS rows_written, COUNT(*) AS rows_in_table FROM lineitem",
    "schema_drift": """
SELECT * FROM (VALUES
  ('orders_t', 'o_orderpriority', 'COLUMN_REMOVED', 'string', NULL, TRUE),
  ('orders_t', 'o_totalprice', 'TYPE_CHANGED', 'double', 'decimal(12,2)', TRUE),
  ('orders_t', 'order_year', 'COLUMN_ADDED', NULL, 'int', TRUE),
  ('nation_t', 'n_nationkey', 'COLUMN_ADDED', NULL, 'int', TRUE),
  ('nation_t', 'n_name', 'COLUMN_ADDED', NULL, 'string', TRUE),
  ('nation_t', 'n_regionkey', 'COLUMN_ADDED', NULL, 'int', TRUE))
  AS v(table_name, column_name, drift_type, old_value, new_value, has_detected_at)
""",
    "upsert": f"""
SELECT {_ORDERS_COLS}, 1 AS batch_no FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderstatus = 'O' THEN '1-URGENT' ELSE o_orderpriority END, 2
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
""",
    "upsert_partitioned": f"""
WITH o AS (SELECT *, o_orderdate >= TIMESTAMP '1997-01-01'
                     AND NOT (o_orderstatus = 'P' AND o_custkey % 2 = 1) AS second FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN second AND o_orderstatus = 'O' THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN second THEN 2 ELSE 1 END AS batch_no,
       CAST(CASE WHEN o_orderstatus <> 'P'
                 THEN year(o_orderdate) + CASE WHEN second AND o_orderkey % 10 = 0 THEN 1 ELSE 0 END END AS INTEGER)
         AS order_year
FROM o WHERE second OR o_orderdate < TIMESTAMP '1998-01-01'
""",
    "incremental_read": """
SELECT *, CASE WHEN o_orderkey % 97 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS stamp FROM orders
""",
    "stream_ingest": "SELECT * FROM orders",
    "stream_keep_latest": """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate AS changed_at FROM orders),
v AS (SELECT * FROM o WHERE o_orderstatus = 'F' OR o_orderkey % 4 = 0
      UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 'CHANGED', changed_at + INTERVAL 10 DAY FROM o WHERE o_orderkey % 3 = 0
      UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 'LATE', changed_at - INTERVAL 100 DAY FROM o
      UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 'TIED', changed_at FROM o WHERE o_orderkey % 10 = 0)
SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY changed_at DESC, o_custkey DESC, o_orderstatus DESC, o_orderpriority DESC) = 1
""",
    "quality_checks": """
SELECT (SELECT COUNT(*) FROM lineitem) AS row_count,
       (SELECT COUNT(*) FROM lineitem WHERE l_partkey IS NULL) AS null_l_partkey,
       (SELECT COUNT(*) FROM lineitem WHERE l_shipdate IS NULL) AS null_l_shipdate,
       (SELECT COUNT(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem
                              GROUP BY ALL HAVING COUNT(*) > 1)) AS duplicate_keys,
       (SELECT COUNT(*) FROM lineitem l WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS
          (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)) AS orphan_rows
""",
}
ORACLE["materialise_model"] = MODEL_SQL["supplier_metrics"]
