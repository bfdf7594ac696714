"""Evolving types, files taken once and quarantined records, on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.ledger import ingest_new_files
from ..plans.quarantine import accepted, ingest_checked, rejected
from ..session import fine_session, scratch_path
from ..sinks.evolving import append_widening, read_widened
from .common import t
from .io import scratch_db


def widening_append(spark, sf_dir):
    """K5: keys int then bigint; amounts int, decimal, double; a nested field that comes and goes."""
    table = f"{scratch_db(spark, 'widen')}.orders"
    o = t(spark, sf_dir, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    status, priority = F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    batches = [("F", key.cast("int"), F.floor(price).cast("int"), F.struct(status)),
               ("O", key, price.cast("decimal(12,2)"), F.struct(status, priority)),
               ("P", key, price, F.struct(status))]
    for s, k, amount, about in batches:
        append_widening(o.filter(F.col("o_orderstatus") == s).select(k.alias("o_orderkey"), amount.alias("amount"), about.alias("about")), table)
    return read_widened(spark, table).select("o_orderkey", "amount", F.col("about.status").alias("status"), F.col("about.priority").alias("priority"))


def land_file(df, path: str) -> None:
    """``df`` as one CSV file of that name."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.parts")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}.parts")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs.delete(there, False)
    fs.rename(part, there)


def ledger_ingest(spark, sf_dir):
    """Five files; run, run again, one file replaced and one more landed, run twice."""
    db, land = scratch_db(spark, "ledger"), scratch_path(spark, "ledger-landing")
    customer = t(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    run = lambda: ingest_new_files(spark, f"{land}/*.csv", f"{db}.raw_customer", f"{db}.ledger")
    for n in range(4):
        land_file(customer.filter(F.col("c_custkey") % 5 == n), f"{land}/customer {n}.csv")
    run()
    run()
    land_file(customer.filter("c_custkey % 5 = 2").withColumn("c_name", F.lit("replaced")), f"{land}/customer 2.csv")
    land_file(customer.filter("c_custkey % 5 = 4"), f"{land}/customer 4.csv")
    run()
    run()
    return spark.table(f"{db}.raw_customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.regexp_extract("_source_file", "([^/]*)$", 1).alias("file"), F.col("_ingested_at").isNotNull().alias("stamped"))


def quarantine(spark, sf_dir):
    """Orders as CSV lines, some short, long, with an open quote, a bad number or a bad date; all come out once."""
    caller, spark = spark, fine_session(spark)
    table, land = f"{scratch_db(spark, 'bad')}.orders", scratch_path(spark, "bad-landing")
    o = t(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 17
    price = F.when(kind == 3, F.lit("12x")).when(kind == 5, F.lit("")).otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    day = F.when(kind.isin(3, 4), F.lit("1998-13-01")).otherwise(F.to_date("o_orderdate").cast("string"))
    priority = F.when(kind == 2, F.concat(F.lit('"'), "o_orderpriority")).otherwise(F.concat(F.lit('"'), "o_orderpriority", F.lit(', ""x""' + '"')))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), price, day, priority)
    line = F.when(kind == 0, F.concat_ws(",", F.col("o_orderkey").cast("string"), price)).when(kind == 1, F.concat(line, F.lit(",more"))).otherwise(line)
    o.select(line.alias("value")).write.text(f"{land}/orders")
    ingest_checked(spark, f"{land}/orders", table, {"o_orderkey": "bigint", "o_totalprice": "decimal(12,2)", "o_orderdate": "date"},
                   columns=["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    good = accepted(caller, table).select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderdate", "o_orderpriority",
                                         F.lit(None).cast("string").alias("line"), F.lit("").alias("reasons"))
    none = {c: F.lit(None).cast(k).alias(c) for c, k in good.dtypes[:4]}
    bad = rejected(caller, table).select(*none.values(), F.col("_line").alias("line"), F.array_join("_reasons", "; ").alias("reasons"))
    return good.unionByName(bad)


QUERIES = {"quarantine": quarantine, "widening_append": widening_append, "ledger_ingest": ledger_ingest}

ORACLE = {
    "quarantine": r'''
WITH o AS (SELECT *, o_orderkey % 17 AS kind, CASE WHEN o_orderkey % 17 = 3 THEN '12x' WHEN o_orderkey % 17 = 5 THEN ''
             ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
             CASE WHEN o_orderkey % 17 IN (3, 4) THEN '1998-13-01' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS d FROM orders)
SELECT CASE WHEN kind > 4 THEN o_orderkey END AS o_orderkey,
       CASE WHEN kind > 5 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS o_totalprice,
       CASE WHEN kind > 4 THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
       CASE WHEN kind > 4 THEN o_orderpriority || ', "x"' END AS o_orderpriority,
       CASE kind WHEN 0 THEN o_orderkey || ',' || price
                 WHEN 1 THEN o_orderkey || ',' || price || ',' || d || ',"' || o_orderpriority || ', ""x""",more'
                 WHEN 2 THEN o_orderkey || ',' || price || ',' || d || ',"' || o_orderpriority
                 WHEN 3 THEN o_orderkey || ',' || price || ',' || d || ',"' || o_orderpriority || ', ""x"""'
                 WHEN 4 THEN o_orderkey || ',' || price || ',' || d || ',"' || o_orderpriority || ', ""x"""' END AS line,
       CASE kind WHEN 0 THEN 'too few fields' WHEN 1 THEN 'too many fields' WHEN 2 THEN 'unclosed quote'
                 WHEN 3 THEN 'not typed: o_totalprice; not typed: o_orderdate' WHEN 4 THEN 'not typed: o_orderdate' ELSE '' END AS reasons
FROM o
''',
    "widening_append": """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN floor(o_totalprice) WHEN 'O' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE)
                   ELSE o_totalprice END AS amount, o_orderstatus AS status,
       CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS priority
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
""",
    "ledger_ingest": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_custkey % 5 = 2 THEN 'replaced' ELSE c_name END AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal, c_mktsegment,
       'customer ' || CAST(c_custkey % 5 AS VARCHAR) || '.csv' AS file, TRUE AS stamped
FROM customer
""",
}
