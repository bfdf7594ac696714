"""Clean-layer and end-to-end layered-run queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import gold
from ..plans.layered import Layers, run_layers, to_raw
from ..plans.silver import apply_spec, driver_specs
from .common import t
from .io import scratch_db


def clean_tables(spark, sf_dir):
    """T*: raw text line items → typed, keyed, latest-per-key clean rows."""
    raw = to_raw(t(spark, sf_dir, "lineitem"), "lineitem")
    clean = apply_spec(raw, driver_specs()["lineitem"])
    return clean.select(
        "line_id", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        F.col("_source_file").alias("source_label"),
        F.col("_silver_processed_at").isNotNull().alias("has_processed_at"))


def _summary_model(clean):
    lines = clean["lineitem"].join(
        clean["orders"].select(F.col("order_id").alias("l_orderkey"), "customer_id"),
        on="l_orderkey", how="inner")
    out = gold.entity_summary(
        clean["customer"], clean["orders"], lines, entity_id="customer_id",
        entity_cols=("segment", "nation_id"), event_entity="customer_id",
        event_id="order_id", event_cost="order_cost", event_start="order_date",
        fact_entity="customer_id", fact_code="l_partkey",
        names={"total": "order_count", "unique": "distinct_parts", "spend": "total_spend",
               "first": "first_order_date", "last": "last_order_date"})
    return out.withColumn("total_spend", F.col("total_spend").cast("double"))


def layered_run(spark, sf_dir):
    """M1: land → raw → clean → summary on customer / orders / line items."""
    layers = Layers(scratch_db(spark, "raw"), scratch_db(spark, "clean"),
                    scratch_db(spark, "summary"))
    sources = {n: t(spark, sf_dir, n) for n in ("customer", "orders", "lineitem")}
    # No bucketing here: under the hot-key assumption one order may hold a
    # large share of lines, and a bucketed scan cannot be skew-split by AQE.
    run_layers(spark, sources, driver_specs(), layers, {"customer_summary": _summary_model})
    return spark.table(f"{layers.summary}.customer_summary")


QUERIES = {
    "clean_tables": clean_tables,
    "layered_run": layered_run,
}

_LATEST_LINES = """
  (SELECT * FROM lineitem
   QUALIFY row_number() OVER (
     PARTITION BY l_orderkey, l_linenumber
     ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
              l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
              l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
              l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1)
"""

ORACLE = {
    "clean_tables": f"""
SELECT md5(concat_ws('_', l_orderkey, l_linenumber)) AS line_id,
       l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
       'lineitem' AS source_label, TRUE AS has_processed_at
FROM {_LATEST_LINES} x
""",
    "layered_run": f"""
WITH li AS {_LATEST_LINES},
ev AS (
  SELECT o_custkey, COUNT(o_orderkey) AS order_count,
         CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(12,2))), 2) AS DOUBLE) AS total_spend,
         MIN(CAST(o_orderdate AS DATE)) AS first_order_date,
         MAX(CAST(o_orderdate AS DATE)) AS last_order_date
  FROM orders GROUP BY o_custkey),
fa AS (
  SELECT o.o_custkey, COUNT(DISTINCT li.l_partkey) AS distinct_parts
  FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey GROUP BY o.o_custkey)
SELECT c.c_custkey AS customer_id, ev.order_count, fa.distinct_parts, ev.total_spend,
       ev.first_order_date, ev.last_order_date, c.c_mktsegment AS segment,
       c.c_nationkey AS nation_id
FROM customer c
LEFT JOIN ev ON ev.o_custkey = c.c_custkey
LEFT JOIN fa ON fa.o_custkey = c.c_custkey
""",
}
