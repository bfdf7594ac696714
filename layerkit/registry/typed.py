"""Values of every tag and compacted partitions, on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.variants import extract, merged_schemas, read_merged, typed_values
from ..sinks.compaction import compact, table_files
from ..sinks.tables import write_table
from .common import t
from .io import scratch_db


def _readings(spark, sf_dir):
    """Events as tagged text: numbers, JSON documents, days, flags, texts, and a tag that nobody lists."""
    e = t(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    money = F.col("value").cast("decimal(12,2)").cast("string")
    document = F.concat(F.lit('{"k": '), k.cast("string"), F.lit(', "at": {"user": '), F.col("user_id").cast("string"),
                        F.when(k % 2 == 0, F.concat(F.lit(', "amount": '), money)).otherwise(""), F.lit("}}"))
    kind = F.col("event_type")
    value = (F.when(kind == "purchase", F.when(k % 10 == 0, F.lit("n/a")).otherwise(money))
             .when(kind == "view", F.when(k % 10 == 0, F.col("props").substr(1, 4)).otherwise(document))
             .when(kind == "click", F.to_date("ts").cast("string"))
             .when(kind == "signup", F.when(k % 10 != 0, (k % 3 == 0).cast("string")))
             .otherwise(F.concat(F.lit("code "), k.cast("string"))))
    tag = (F.when(kind == "purchase", F.lit("numeric")).when(kind == "view", F.lit("json")).when(kind == "click", F.lit("day"))
           .when(kind == "signup", F.lit("flag")).otherwise(F.when(k % 2 == 0, F.lit("text")).otherwise("code")))
    return e.select("event_id", tag.alias("value_type"), value.alias("value"))


def typed_readings(spark, sf_dir):
    """Numbers and texts as ever, every other value kept typed in one stored column and read back by path."""
    table = f"{scratch_db(spark, 'typed')}.readings"
    write_table(typed_values(_readings(spark, sf_dir), "value", "value_type", {"json": "json", "day": "date", "flag": "boolean"}), table)
    read = extract(spark.table(table), {
        "k": ("$.k", "int"), "user_id": ("$.at.user", "bigint"), "amount": ("$.at.amount", "double"), "any_text": ("$", "string")})
    read = read.withColumns({
        "day": F.when(F.col("value_type") == "day", F.try_variant_get("typed_value", "$", "date")),
        "flag": F.when(F.col("value_type") == "flag", F.try_variant_get("typed_value", "$", "boolean")),
        "any_text": F.when(F.col("value_type").isin("code", "text") | ~F.col("is_typed"), F.col("any_text"))})
    return read.select("event_id", "value_type", "numeric_value", "text_value", "is_typed", "k", "user_id", "amount", "day", "flag", "any_text")


def typed_documents(spark, sf_dir):
    """The JSON values as one struct of the schema merged over all of them, and that schema."""
    kept = typed_values(_readings(spark, sf_dir), "value", "value_type", {"json": "json"}).filter("value_type = 'json' and is_typed")
    read = read_merged(kept, "doc")
    schema = merged_schemas(kept).select(F.regexp_replace("schema", r"DECIMAL\([0-9]+,2\)", "DECIMAL").alias("schema"))
    sums = read.groupBy((F.col("doc.k") % 10).alias("k")).agg(
        F.count("*").alias("values"), F.sum("doc.at.user").alias("users"), F.sum(F.col("doc.at.amount").cast("decimal(12,2)")).cast("double").alias("amount"))
    return sums.withColumn("schema", schema.scalar())


APPENDS = 6


def compacted_appends(spark, sf_dir):
    """K3: orders appended in six batches by status, then compacted: the same rows, and no partition with a file too many."""
    table, target = f"{scratch_db(spark, 'compact')}.orders", 128 << 20
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    for n in range(APPENDS):
        write_table(o.filter(F.col("o_orderkey") % APPENDS == n), table, partition_by=["o_orderstatus"])
    compact(spark, table, target)
    left = table_files(spark, table).filter(F.col("size") < target * 3 // 4).groupBy("folder").agg(F.count("*").alias("small"))
    worst = left.agg(F.coalesce(F.max("small"), F.lit(0)) <= 1).first()[0]
    return spark.table(table).withColumn("few_files", F.lit(worst))


QUERIES = {"typed_readings": typed_readings, "typed_documents": typed_documents, "compacted_appends": compacted_appends}

_READINGS = r"""
e AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS kk, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS money FROM events),
r AS (SELECT *, CASE event_type WHEN 'purchase' THEN 'numeric' WHEN 'view' THEN 'json' WHEN 'click' THEN 'day' WHEN 'signup' THEN 'flag'
                ELSE CASE WHEN kk % 2 = 0 THEN 'text' ELSE 'code' END END AS value_type FROM e)
"""

ORACLE = {
    "typed_readings": f"""
WITH {_READINGS}
SELECT event_id, value_type, CASE WHEN value_type = 'numeric' AND kk % 10 <> 0 THEN money END AS numeric_value,
       CASE WHEN value_type = 'text' THEN 'code ' || kk END AS text_value,
       CASE WHEN value_type IN ('numeric', 'json') THEN kk % 10 <> 0 WHEN value_type IN ('day', 'text') THEN TRUE
            WHEN value_type = 'flag' AND kk % 10 <> 0 THEN TRUE END AS is_typed,
       CASE WHEN value_type = 'json' AND kk % 10 <> 0 THEN kk END AS k,
       CASE WHEN value_type = 'json' AND kk % 10 <> 0 THEN user_id END AS user_id,
       CASE WHEN value_type = 'json' AND kk % 10 <> 0 AND kk % 2 = 0 THEN money END AS amount,
       CASE WHEN value_type = 'day' THEN CAST(ts AS DATE) END AS day,
       CASE WHEN value_type = 'flag' AND kk % 10 <> 0 THEN kk % 3 = 0 END AS flag,
       CASE WHEN value_type IN ('code', 'text') THEN 'code ' || kk WHEN value_type = 'numeric' AND kk % 10 = 0 THEN 'n/a'
            WHEN value_type = 'json' AND kk % 10 = 0 THEN substr(props, 1, 4) END AS any_text
FROM r
""",
    "typed_documents": f"""
WITH {_READINGS}
SELECT CAST(kk % 10 AS BIGINT) AS k, count(*) AS values, CAST(sum(user_id) AS BIGINT) AS users,
       CAST(sum(CASE WHEN kk % 2 = 0 THEN CAST(money AS DECIMAL(12,2)) END) AS DOUBLE) AS amount,
       'OBJECT<at: OBJECT<amount: DECIMAL, user: BIGINT>, k: BIGINT>' AS schema
FROM r WHERE value_type = 'json' AND kk % 10 <> 0 GROUP BY 1
""",
    "compacted_appends": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, TRUE AS few_files FROM orders",
}
