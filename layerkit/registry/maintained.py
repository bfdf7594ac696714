"""Summary models kept up by batches: three batches with changes and deletions, one of them repeated."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import minutes_between
from ..plans.maintained import SIGN, Maintained, Measure, apply_changes, fold_state, read_model, signed_changes
from ..session import fine_session
from ..sinks.tables import write_table
from .common import money, order_lines, t
from .io import scratch_db
from .models import _ORDER_LINES

LATER = "1997-01-01"


def _signed(df, sign):
    return df.withColumn(SIGN, F.lit(sign))


def _batches(rows, later, changed, corrected, gone):
    """Signed rows of three batches: the earlier rows; the later ones and corrections of earlier ones; deletions.

    Each batch reads ``rows`` once, a corrected row goes out twice there.
    """
    columns = rows.columns
    as_is = F.struct(*[F.col(c) for c in columns])
    fixed = F.struct(*[(corrected[c] if c in corrected else F.col(c)).alias(c) for c in columns])
    signed = lambda row, sign: F.struct(row.alias("row"), F.lit(sign).alias(SIGN))
    out = F.when(later, F.array(signed(as_is, 1))).when(~later & changed, F.array(signed(as_is, -1), signed(fixed, 1)))
    now = F.when(later | (~later & ~changed), as_is).when(~later & changed, fixed)
    return [_signed(rows.filter(~later), 1),
            rows.select(F.explode(out).alias("__o")).select("__o.row.*", f"__o.{SIGN}"),
            _signed(rows.select(now.alias("__now")).filter(F.col("__now").isNotNull()).select("__now.*").filter(gone), -1)]


def _stored(df, table):
    """``df`` written once: a batch is evaluated more than once, and its joins need not be."""
    write_table(df, table, mode="overwrite")
    return df.sparkSession.table(table)


def maintained_supplier_metrics(spark, sf_dir):
    """G4 under E2: prices corrected by the second batch (applied twice), every fifth order deleted by the third."""
    caller, spark = spark, fine_session(spark)
    db = scratch_db(spark, "kept")
    spec = Maintained(f"{db}.supplier_metrics", ("supplier_id",), (
        Measure("line_count", "count", "l_orderkey"), Measure("customer_count", "distinct", "o_custkey"),
        Measure("avg_ship_minutes", "avg", "ship_minutes"), Measure("total_revenue", "sum", "revenue")),
        inputs={"events": ("l_suppkey",)}, buckets=8)
    lines = _stored(order_lines(spark, sf_dir).select(
        "l_suppkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderdate",
        minutes_between("o_orderdate", "l_shipdate").alias("ship_minutes"), money("l_extendedprice").alias("revenue")), f"{db}.lines")
    later = F.col("o_orderdate") >= F.lit(LATER).cast("timestamp_ntz")
    batches = _batches(lines, later, F.col("l_partkey") % 7 == 0, {"revenue": (F.col("revenue") * 2).cast("decimal(12,2)")},
                       F.col("l_orderkey") % 5 == 0)
    for n, rows in [(0, batches[0]), (1, batches[1]), (1, batches[1]), (2, batches[2])]:
        apply_changes(spark, spec, n, {"events": rows})
    return read_model(caller, spec).withColumns({"avg_ship_minutes": F.round("avg_ship_minutes", 2),
                                                "total_revenue": F.round("total_revenue", 2).cast("double")})


def maintained_customer_summary(spark, sf_dir):
    """G1 under E2: customers, orders and lines change on their own; the state is folded between batches."""
    caller, spark = spark, fine_session(spark)
    db = scratch_db(spark, "kept")
    spec = Maintained(f"{db}.customer_summary", ("c_custkey",), (
        Measure("order_count", "count", "o_orderkey", "orders"), Measure("distinct_parts", "distinct", "l_partkey", "lines"),
        Measure("total_spend", "sum", "order_cost", "orders"), Measure("first_order_date", "min", "order_day", "orders"),
        Measure("last_order_date", "max", "order_day", "orders"), Measure("c_mktsegment", "attribute", "c_mktsegment", "customers"),
        Measure("c_nationkey", "attribute", "c_nationkey", "customers")),
        inputs={"customers": ("c_custkey",), "orders": ("o_custkey",), "lines": ("o_custkey",)}, base="customers", buckets=8)
    customers = t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", money("o_totalprice").alias("order_cost"),
                                               F.to_date("o_orderdate").alias("order_day"))
    later = F.col("order_day") >= F.lit(LATER).cast("date")
    lines = _stored(order_lines(spark, sf_dir).select("l_orderkey", "l_partkey", "o_custkey", F.to_date("o_orderdate").alias("order_day")), f"{db}.lines")
    # customers move to another segment with the second batch and some are gone with the third
    moved = customers.filter("c_custkey % 4 = 0").withColumn("c_mktsegment", F.lit("MOVED"))
    write_table(customers, f"{db}.customers", mode="overwrite")
    second = signed_changes(spark.table(f"{db}.customers"), moved, "c_custkey")
    gone = spark.table(f"{db}.customers").filter("c_custkey % 11 = 3").withColumn("gone", F.lit(True))
    third = signed_changes(spark.table(f"{db}.customers").filter("c_custkey % 4 != 0").unionByName(moved),
                           gone.withColumn("c_mktsegment", F.lit(None).cast("string")), "c_custkey", deleted="gone")
    order_batches = _batches(orders, later, F.col("o_orderkey") % 6 == 0, {"order_day": F.date_add("order_day", -400)}, F.col("o_orderkey") % 5 == 0)
    line_batches = _batches(lines, later, F.col("l_orderkey") % 6 == 0, {"l_partkey": (F.col("l_partkey") % 50).cast("int")},
                            F.col("l_orderkey") % 5 == 0)
    for n, rows in enumerate([_signed(customers, 1), second, third]):
        apply_changes(spark, spec, n, {"customers": rows, "orders": order_batches[n], "lines": line_batches[n]})
        if n == 1:
            fold_state(spark, spec)
    return read_model(caller, spec).withColumn("total_spend", F.col("total_spend").cast("double"))


def maintained_part_prevalence(spark, sf_dir):
    """G3 under E2: distinct customers per kind of part; the number of customers is a model of one group."""
    caller, spark = spark, fine_session(spark)
    db = scratch_db(spark, "kept")
    spec = Maintained(f"{db}.prevalence", ("p_brand", "p_type"), (Measure("customer_count", "distinct", "o_custkey"),),
                      inputs={"events": ("p_brand", "p_type")}, buckets=8)
    total = Maintained(f"{db}.population", ("everyone",), (Measure("total_customers", "count", "c_custkey"),),
                       inputs={"events": ("everyone",)}, buckets=1)
    part = t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    lines = order_lines(spark, sf_dir).select("l_partkey", "l_orderkey", "o_custkey", "o_orderdate")
    facts = _stored(lines.join(part, lines["l_partkey"] == part["p_partkey"]), f"{db}.facts")
    later = F.col("o_orderdate") >= F.lit(LATER).cast("timestamp_ntz")
    batches = _batches(facts, later, F.col("l_partkey") % 7 == 0, {"p_type": F.lit("RENAMED")}, F.col("l_orderkey") % 2 == 0)
    customers = t(spark, sf_dir, "customer").select("c_custkey", F.lit(1).alias("everyone"))
    people = [_signed(customers, 1), _signed(customers.filter("c_custkey % 10 = 1"), -1)]
    for n, rows in enumerate(batches):
        apply_changes(spark, spec, n, {"events": rows})
    for n, rows in enumerate(people):
        apply_changes(spark, total, n, {"events": rows})
    pct = F.round(F.col("customer_count") * F.lit(100.0).cast("decimal(4,1)") / F.col("total_customers"), 2).cast("double")
    one = read_model(caller, total).select("total_customers")
    return read_model(caller, spec).withColumn("total_customers", one.scalar()).withColumn("pct_customers", pct)


QUERIES = {
    "maintained_supplier_metrics": maintained_supplier_metrics,
    "maintained_customer_summary": maintained_customer_summary,
    "maintained_part_prevalence": maintained_part_prevalence,
}

ORACLE = {
    "maintained_supplier_metrics": f"""
SELECT l_suppkey AS supplier_id, COUNT(l_orderkey) AS line_count, COUNT(DISTINCT o_custkey) AS customer_count,
       ROUND(AVG(CAST(TRUNC(date_diff('second', o_orderdate, l_shipdate) / 60.0) AS BIGINT)), 2) AS avg_ship_minutes,
       CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(12,2))
                      * CASE WHEN o_orderdate < DATE '{LATER}' AND l_partkey % 7 = 0 THEN 2 ELSE 1 END), 2) AS DOUBLE) AS total_revenue
FROM {_ORDER_LINES} x WHERE l_orderkey % 5 <> 0 GROUP BY l_suppkey
""",
    "maintained_customer_summary": f"""
WITH ev AS (
  SELECT o_custkey, COUNT(o_orderkey) AS order_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_spend,
         MIN(d) AS first_order_date, MAX(d) AS last_order_date
  FROM (SELECT *, CAST(o_orderdate AS DATE) - CASE WHEN o_orderdate < DATE '{LATER}' AND o_orderkey % 6 = 0 THEN 400 ELSE 0 END AS d
        FROM orders WHERE o_orderkey % 5 <> 0) GROUP BY o_custkey),
fa AS (
  SELECT o_custkey, COUNT(DISTINCT CASE WHEN o_orderdate < DATE '{LATER}' AND l_orderkey % 6 = 0 THEN l_partkey % 50 ELSE l_partkey END)
           AS distinct_parts
  FROM {_ORDER_LINES} x WHERE l_orderkey % 5 <> 0 GROUP BY o_custkey)
SELECT c.c_custkey, ev.order_count, fa.distinct_parts, ev.total_spend, ev.first_order_date, ev.last_order_date,
       CASE WHEN c_custkey % 4 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, c.c_nationkey
FROM customer c LEFT JOIN ev ON ev.o_custkey = c.c_custkey LEFT JOIN fa ON fa.o_custkey = c.c_custkey
WHERE c_custkey % 11 <> 3
""",
    "maintained_part_prevalence": f"""
WITH f AS (SELECT p.p_brand, CASE WHEN o_orderdate < DATE '{LATER}' AND l_partkey % 7 = 0 THEN 'RENAMED' ELSE p.p_type END AS p_type, x.o_custkey
           FROM {_ORDER_LINES} x JOIN part p ON x.l_partkey = p.p_partkey WHERE l_orderkey % 2 <> 0),
n AS (SELECT COUNT(*) AS total_customers FROM customer WHERE c_custkey % 10 <> 1)
SELECT p_brand, p_type, COUNT(DISTINCT o_custkey) AS customer_count, any_value(total_customers) AS total_customers,
       CAST(ROUND(CAST(COUNT(DISTINCT o_custkey) AS DECIMAL(38,0)) * 100.0 / any_value(total_customers), 2) AS DOUBLE) AS pct_customers
FROM f, n GROUP BY p_brand, p_type
""",
}
