"""History of schema baselines on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans.drift_history import drift_between, record_schema, schema_history
from ..sinks.tables import write_table
from .common import t
from .io import scratch_db

DAYS = [dt.datetime(2024, 1, d, 12) for d in (1, 2, 3, 4, 5)]


def _captures(spark, sf_dir):
    """Five captures of one schema while its tables change, recorded out of order, and two of a steady one."""
    db, steady, ctl = scratch_db(spark, "hist"), scratch_db(spark, "steady"), scratch_db(spark, "ctl")
    log = f"{ctl}.schema_captures"
    orders, customer = t(spark, sf_dir, "orders"), t(spark, sf_dir, "customer")
    write_table(t(spark, sf_dir, "supplier"), f"{steady}.supplier_t", mode="overwrite")
    states = [
        {"orders_t": orders, "customer_t": customer},
        {"orders_t": orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)")), "customer_t": customer},
        {"orders_t": orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)")), "nation_t": t(spark, sf_dir, "nation")},
        {"orders_t": orders.drop("o_orderpriority"), "customer_t": customer.withColumn("c_note", F.lit("x"))},
        {"orders_t": orders, "customer_t": customer.withColumn("c_note", F.lit("x"))},
    ]
    for n in (4, 0, 2, 1, 3, 3):      # the last one twice
        for r in spark.catalog.listTables(db):
            if not r.isTemporary:      # temporary views of the session are listed, too
                spark.sql(f"DROP TABLE {db}.{r.name}")
        for name, df in states[n].items():
            write_table(df, f"{db}.{name}", mode="overwrite")
        record_schema(spark, db, log, DAYS[n])
    for n in (1, 3):
        record_schema(spark, steady, log, DAYS[n])
    names = F.when(F.col("schema_name") == db, F.lit("changing")).otherwise(F.lit("steady"))
    return spark.table(log).withColumn("schema_name", names)


def schema_intervals(spark, sf_dir):
    """D1 with history: each column's types with the instants from and to which they held."""
    return schema_history(_captures(spark, sf_dir)).drop("is_nullable")


def schema_drift_between(spark, sf_dir):
    """D2 between any two instants: two pairs, the second one backwards in time."""
    history = schema_history(_captures(spark, sf_dir))
    forth = drift_between(history, DAYS[0], DAYS[3] + dt.timedelta(hours=1)).withColumn("pair", F.lit("forth"))
    back = drift_between(history, DAYS[2], DAYS[0]).withColumn("pair", F.lit("back"))
    return forth.unionByName(back)


QUERIES = {"schema_intervals": schema_intervals, "schema_drift_between": schema_drift_between}


def _day(n: int | None) -> str:
    return "NULL" if n is None else f"TIMESTAMP '{DAYS[n]}'"


# what the steps above leave, column by column: type, first capture, capture at which it ended, captures that saw it
_EXPECTED = [
    *[("changing", "orders_t", c, k, 0, None, 5) for c, k in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                                                              ("o_orderdate", "timestamp_ntz"))],
    ("changing", "orders_t", "o_totalprice", "double", 0, 1, 1), ("changing", "orders_t", "o_totalprice", "decimal(12,2)", 1, 3, 2),
    ("changing", "orders_t", "o_totalprice", "double", 3, None, 2),
    ("changing", "orders_t", "o_orderpriority", "string", 0, 3, 3), ("changing", "orders_t", "o_orderpriority", "string", 4, None, 1),
    *[("changing", "customer_t", c, k, *x) for c, k in (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                                                        ("c_mktsegment", "string")) for x in ((0, 2, 2), (3, None, 2))],
    ("changing", "customer_t", "c_note", "string", 3, None, 2),
    *[("changing", "nation_t", c, k, 2, 3, 1) for c, k in (("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int"))],
    *[("steady", "supplier_t", c, k, 1, None, 2) for c, k in (("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double"))],
]

ORACLE = {
    "schema_intervals": "SELECT * FROM (VALUES " + ", ".join(
        f"('{s}', '{a}', '{c}', '{k}', {_day(x)}, {_day(y)}, CAST({n} AS BIGINT))" for s, a, c, k, x, y, n in _EXPECTED)
        + ") AS v(schema_name, table_name, column_name, data_type, valid_from, valid_to, captures)",
    "schema_drift_between": """
SELECT * FROM (VALUES
  ('forth', 'changing', 'orders_t', 'o_orderpriority', 'COLUMN_REMOVED', 'string', NULL),
  ('forth', 'changing', 'customer_t', 'c_note', 'COLUMN_ADDED', NULL, 'string'),
  ('forth', 'steady', 'supplier_t', 's_suppkey', 'COLUMN_ADDED', NULL, 'bigint'),
  ('forth', 'steady', 'supplier_t', 's_name', 'COLUMN_ADDED', NULL, 'string'),
  ('forth', 'steady', 'supplier_t', 's_nationkey', 'COLUMN_ADDED', NULL, 'int'),
  ('forth', 'steady', 'supplier_t', 's_acctbal', 'COLUMN_ADDED', NULL, 'double'),
  ('back', 'changing', 'orders_t', 'o_totalprice', 'TYPE_CHANGED', 'decimal(12,2)', 'double'),
  ('back', 'steady', 'supplier_t', 's_suppkey', 'COLUMN_REMOVED', 'bigint', NULL),
  ('back', 'steady', 'supplier_t', 's_name', 'COLUMN_REMOVED', 'string', NULL),
  ('back', 'steady', 'supplier_t', 's_nationkey', 'COLUMN_REMOVED', 'int', NULL),
  ('back', 'steady', 'supplier_t', 's_acctbal', 'COLUMN_REMOVED', 'double', NULL),
  ('back', 'changing', 'nation_t', 'n_nationkey', 'COLUMN_REMOVED', 'int', NULL),
  ('back', 'changing', 'nation_t', 'n_name', 'COLUMN_REMOVED', 'string', NULL),
  ('back', 'changing', 'nation_t', 'n_regionkey', 'COLUMN_REMOVED', 'int', NULL),
  ('back', 'changing', 'customer_t', 'c_custkey', 'COLUMN_ADDED', NULL, 'bigint'),
  ('back', 'changing', 'customer_t', 'c_name', 'COLUMN_ADDED', NULL, 'string'),
  ('back', 'changing', 'customer_t', 'c_nationkey', 'COLUMN_ADDED', NULL, 'int'),
  ('back', 'changing', 'customer_t', 'c_acctbal', 'COLUMN_ADDED', NULL, 'double'),
  ('back', 'changing', 'customer_t', 'c_mktsegment', 'COLUMN_ADDED', NULL, 'string'))
  AS v(pair, schema_name, table_name, column_name, drift_type, old_value, new_value)
""",
}
