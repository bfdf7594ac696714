"""Summary-model queries (G1–G5) on the driver tables.

Role map: patient → customer, encounter → order, condition → line item
(code = part), provider → supplier.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import minutes_between
from ..plans import gold
from .common import money, order_lines, t


def supplier_metrics(spark, sf_dir):
    """G4 (flagship): per supplier — lines, distinct customers, ship delay, revenue."""
    lines = order_lines(spark, sf_dir).select(
        F.col("l_suppkey").alias("supplier_id"), "l_orderkey", "o_custkey",
        minutes_between("o_orderdate", "l_shipdate").alias("ship_minutes"),
        money("l_extendedprice").alias("revenue"))
    out = gold.group_metrics(
        lines, group="supplier_id", event_id="l_orderkey", entity="o_custkey",
        duration="ship_minutes", cost="revenue",
        names={"total": "line_count", "distinct": "customer_count",
               "avg": "avg_ship_minutes", "sum": "total_revenue"})
    return out.withColumn("total_revenue", F.col("total_revenue").cast("double"))


def customer_summary(spark, sf_dir):
    """G1: one row per customer with order aggregates and distinct parts bought."""
    customers = t(spark, sf_dir, "customer")
    orders = t(spark, sf_dir, "orders").withColumn("order_cost", money("o_totalprice"))
    facts = order_lines(spark, sf_dir).select("o_custkey", "l_partkey")
    out = gold.entity_summary(
        customers, orders, facts, entity_id="c_custkey",
        entity_cols=("c_mktsegment", "c_nationkey"),
        event_entity="o_custkey", event_id="o_orderkey", event_cost="order_cost",
        event_start="o_orderdate", fact_entity="o_custkey", fact_code="l_partkey",
        names={"total": "order_count", "unique": "distinct_parts", "spend": "total_spend",
               "first": "first_order_date", "last": "last_order_date"})
    return out.withColumn("total_spend", F.col("total_spend").cast("double"))


def order_line_summary(spark, sf_dir):
    """Orders ⟕ line items ⋈ customers — one row per (order, line)."""
    orders = t(spark, sf_dir, "orders").withColumns({
        "order_year": F.year("o_orderdate"), "order_month": F.month("o_orderdate")})
    return gold.event_detail(
        orders, t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "customer"),
        event_cols={"order_id": "o_orderkey", "customer_id": "o_custkey",
                    "order_date": "o_orderdate", "order_cost": "o_totalprice",
                    "order_priority": "o_orderpriority", "order_year": "order_year",
                    "order_month": "order_month"},
        fact_cols={"part_id": "l_partkey", "line_number": "l_linenumber",
                   "return_flag": "l_returnflag"},
        entity_cols={"segment": "c_mktsegment", "nation_id": "c_nationkey"},
        event_id="o_orderkey", event_entity="o_custkey", fact_event="l_orderkey",
        entity_id="c_custkey", flag_col="has_line")


def order_line_counts(spark, sf_dir):
    """G2 at order grain: each order once, with its line counts (cost summable)."""
    return gold.event_summary(
        t(spark, sf_dir, "orders"), t(spark, sf_dir, "lineitem"),
        event_cols={"order_id": "o_orderkey", "customer_id": "o_custkey",
                    "order_cost": "o_totalprice"},
        event_id="o_orderkey", fact_event="l_orderkey", fact_code="l_partkey",
        count_name="line_count", distinct_name="distinct_parts", flag_col="has_line")


def part_prevalence(spark, sf_dir):
    """Share of all customers that bought each (brand, type)."""
    part = t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    lines = order_lines(spark, sf_dir).select("l_partkey", "o_custkey")
    facts = lines.join(part, lines["l_partkey"] == part["p_partkey"], "inner")
    out = gold.prevalence(facts, t(spark, sf_dir, "customer"), ["p_brand", "p_type"],
                          entity="o_custkey", count_name="customer_count",
                          total_name="total_customers", pct_name="pct_customers")
    return out.withColumn("pct_customers", F.col("pct_customers").cast("double"))


def reorder_risk(spark, sf_dir):
    """Each order with the customer's next order date and a 30-day flag."""
    return gold.next_event_risk(
        t(spark, sf_dir, "orders"), event_id="o_orderkey", entity="o_custkey",
        start="o_orderdate", window_days=30,
        names={"id": "order_id", "entity": "customer_id", "start": "order_date",
               "next": "next_order_date", "days": "days_to_next_order",
               "flag": "is_reorder_risk"})


def prevalence_sql(spark, sf_dir):
    """S8/P11/J7 through SQL: named sources, a CTE and scalar subqueries."""
    from ..sources.catalog import register_sources
    import uuid
    sfx = uuid.uuid4().hex[:8]
    names = {f"conditions_{sfx}": order_lines(spark, sf_dir),
             f"codes_{sfx}": t(spark, sf_dir, "part"),
             f"patients_{sfx}": t(spark, sf_dir, "customer")}
    register_sources(spark, names)
    return spark.sql(f"""
        WITH facts AS (
          SELECT p.p_brand AS code, p.p_type AS description, c.o_custkey AS patient_id
          FROM conditions_{sfx} c JOIN codes_{sfx} p ON c.l_partkey = p.p_partkey)
        SELECT code AS p_brand, description AS p_type,
               COUNT(DISTINCT patient_id) AS customer_count,
               (SELECT COUNT(*) FROM patients_{sfx}) AS total_customers,
               CAST(ROUND(COUNT(DISTINCT patient_id) * 100.0
                          / (SELECT COUNT(*) FROM patients_{sfx}), 2) AS DOUBLE) AS pct_customers
        FROM facts
        GROUP BY code, description""")


QUERIES = {
    "supplier_metrics": supplier_metrics,
    "customer_summary": customer_summary,
    "order_line_summary": order_line_summary,
    "order_line_counts": order_line_counts,
    "part_prevalence": part_prevalence,
    "reorder_risk": reorder_risk,
    "prevalence_sql": prevalence_sql,
}

_ORDER_LINES = """
  (SELECT l.*, o.o_custkey, o.o_orderdate
   FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""

ORACLE = {
    "supplier_metrics": f"""
SELECT l_suppkey AS supplier_id,
       COUNT(l_orderkey) AS line_count,
       COUNT(DISTINCT o_custkey) AS customer_count,
       ROUND(AVG(CAST(TRUNC(date_diff('second', o_orderdate, l_shipdate) / 60.0) AS INTEGER)), 2)
         AS avg_ship_minutes,
       CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(12,2))), 2) AS DOUBLE) AS total_revenue
FROM {_ORDER_LINES} x
GROUP BY l_suppkey
""",
    "customer_summary": f"""
WITH ev AS (
  SELECT o_custkey, COUNT(o_orderkey) AS order_count,
         CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(12,2))), 2) AS DOUBLE) AS total_spend,
         MIN(CAST(o_orderdate AS DATE)) AS first_order_date,
         MAX(CAST(o_orderdate AS DATE)) AS last_order_date
  FROM orders GROUP BY o_custkey),
fa AS (
  SELECT o_custkey, COUNT(DISTINCT l_partkey) AS distinct_parts
  FROM {_ORDER_LINES} x GROUP BY o_custkey)
SELECT c.c_custkey, ev.order_count, fa.distinct_parts, ev.total_spend,
       ev.first_order_date, ev.last_order_date, c.c_mktsegment, c.c_nationkey
FROM customer c
LEFT JOIN ev ON ev.o_custkey = c.c_custkey
LEFT JOIN fa ON fa.o_custkey = c.c_custkey
""",
    "order_line_summary": """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, o.o_orderdate AS order_date,
       o.o_totalprice AS order_cost, o.o_orderpriority AS order_priority,
       CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o.o_orderdate) AS INTEGER) AS order_month,
       l.l_partkey AS part_id, l.l_linenumber AS line_number, l.l_returnflag AS return_flag,
       CASE WHEN l.l_partkey IS NOT NULL THEN TRUE ELSE FALSE END AS has_line,
       c.c_mktsegment AS segment, c.c_nationkey AS nation_id
FROM orders o
LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
""",
    "part_prevalence": f"""
SELECT p.p_brand, p.p_type,
       COUNT(DISTINCT x.o_custkey) AS customer_count,
       (SELECT COUNT(*) FROM customer) AS total_customers,
       CAST(ROUND(CAST(COUNT(DISTINCT x.o_custkey) AS DECIMAL(38,0)) * 100.0
                  / (SELECT COUNT(*) FROM customer), 2) AS DOUBLE) AS pct_customers
FROM {_ORDER_LINES} x JOIN part p ON x.l_partkey = p.p_partkey
GROUP BY p.p_brand, p.p_type
""",
    "reorder_risk": """
WITH seq AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
         LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
           AS next_order_date
  FROM orders)
SELECT order_id, customer_id, order_date, next_order_date,
       CAST(date_diff('day', CAST(order_date AS DATE), CAST(next_order_date AS DATE)) AS INTEGER)
         AS days_to_next_order,
       CASE WHEN date_diff('day', CAST(order_date AS DATE), CAST(next_order_date AS DATE)) <= 30
            THEN TRUE ELSE FALSE END AS is_reorder_risk
FROM seq
""",
}
ORACLE["prevalence_sql"] = ORACLE["part_prevalence"]
ORACLE["order_line_counts"] = """
WITH c AS (SELECT l_orderkey, COUNT(*) AS line_count, COUNT(DISTINCT l_partkey) AS distinct_parts
           FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, o.o_totalprice AS order_cost,
       COALESCE(c.line_count, 0) AS line_count, COALESCE(c.distinct_parts, 0) AS distinct_parts,
       COALESCE(c.line_count, 0) > 0 AS has_line
FROM orders o LEFT JOIN c ON c.l_orderkey = o.o_orderkey
"""
