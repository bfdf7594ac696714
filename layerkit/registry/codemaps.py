"""Mapping between code systems on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.codemaps import map_by_interval, map_by_number, map_by_prefix
from .common import t

# The chapters of the ICD-10 classification, and three of its blocks.
CHAPTERS = [
    ("A00", "B99", "Infectious diseases"), ("C00", "D48", "Neoplasms"), ("D50", "D89", "Blood and immune system"),
    ("E00", "E90", "Endocrine and metabolic"), ("F00", "F99", "Mental and behavioural"), ("G00", "G99", "Nervous system"),
    ("H00", "H59", "Eye"), ("H60", "H95", "Ear"), ("I00", "I99", "Circulatory system"), ("J00", "J99", "Respiratory system"),
    ("K00", "K93", "Digestive system"), ("L00", "L99", "Skin"), ("M00", "M99", "Musculoskeletal system"),
    ("N00", "N99", "Genitourinary system"), ("O00", "O99", "Pregnancy and childbirth"), ("P00", "P96", "Perinatal period"),
    ("Q00", "Q99", "Congenital"), ("R00", "R99", "Symptoms and findings"), ("S00", "T98", "Injury and poisoning"),
    ("V01", "Y98", "External causes"), ("Z00", "Z99", "Health status and services"),
    ("C50", "C50", "Breast cancer"), ("E10", "E14", "Diabetes"), ("I20", "I25", "Ischaemic heart disease"),
]
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _diagnosis():
    """A code such as ``D47.3`` from a line's part and order; every 19th line has none."""
    part, order = F.col("l_partkey"), F.col("l_orderkey")
    code = F.concat(F.substring(F.lit(_LETTERS), (part % 26 + 1).cast("int"), F.lit(1)), F.lpad((order % 100).cast("string"), 2, "0"),
                    F.when(order % 3 > 0, F.concat(F.lit("."), (part % 10).cast("string"))).otherwise(F.lit("")))
    return F.when((part + order) % 19 > 0, code)


def _claims(spark, sf_dir):
    return t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", _diagnosis().alias("diagnosis_code"))


def diagnosis_chapters(spark, sf_dir):
    """E3 by interval: chapters share letters, blocks overlap chapters, some codes are in no chapter."""
    table = spark.createDataFrame([*CHAPTERS, (None, "A05", "ignored"), ("B05", "A05", "ignored")], "low string, high string, chapter string")
    return map_by_interval(_claims(spark, sf_dir), "diagnosis_code", table, "low", "high", "chapter", characters=5)


def code_prefixes(spark, sf_dir):
    """E3 by longest prefix: letters, letters with a digit and whole codes, each with a code of another system."""
    lines = _claims(spark, sf_dir)
    codes = lines.filter("diagnosis_code is not null")
    table = (codes.select(F.substring("diagnosis_code", 1, 1).alias("prefix")).filter("prefix < 'T'")
             .union(codes.filter("l_partkey % 5 = 0").select(F.substring("diagnosis_code", 1, 2)))
             .union(codes.filter("l_partkey % 7 = 0").select("diagnosis_code")).distinct()
             .withColumn("target", F.concat(F.lit("T-"), F.reverse("prefix"))))
    return map_by_prefix(lines, "diagnosis_code", table, "prefix", "target")


def price_bands(spark, sf_dir):
    """E3 over numbers: bands from one to ten million cents wide, one for each supplier; the narrowest wins."""
    low = F.round(F.col("s_acctbal") * 4000).cast("long")
    width = F.pow(F.lit(10), F.col("s_suppkey") % 8).cast("long")
    table = t(spark, sf_dir, "supplier").select("s_suppkey", low.alias("low"), F.when(F.col("s_suppkey") % 13 > 0, low + width).alias("high"))
    orders = t(spark, sf_dir, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return map_by_number(orders, "cents", table, "low", "high", "s_suppkey")


QUERIES = {"diagnosis_chapters": diagnosis_chapters, "code_prefixes": code_prefixes, "price_bands": price_bands}

_CLAIMS = f"""
claims AS (SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN (l_partkey + l_orderkey) % 19 > 0 THEN
  substr('{_LETTERS}', CAST(l_partkey % 26 + 1 AS INTEGER), 1) || lpad(CAST(l_orderkey % 100 AS VARCHAR), 2, '0')
  || CASE WHEN l_orderkey % 3 > 0 THEN '.' || CAST(l_partkey % 10 AS VARCHAR) ELSE '' END END AS diagnosis_code FROM lineitem)"""
_NUMBER = " + ".join(f"instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr({{c}}, {i}, 1)) * {37 ** (3 - i)}" for i in (1, 2, 3))

ORACLE = {
    "diagnosis_chapters": f"""
WITH {_CLAIMS},
m(low, high, chapter) AS (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in CHAPTERS)}),
codes AS (SELECT DISTINCT diagnosis_code FROM claims WHERE diagnosis_code IS NOT NULL),
best AS (SELECT diagnosis_code, chapter FROM codes JOIN m ON substr(diagnosis_code, 1, 3) BETWEEN low AND high
         QUALIFY row_number() OVER (PARTITION BY diagnosis_code
           ORDER BY ({_NUMBER.format(c="high")}) - ({_NUMBER.format(c="low")}), low DESC, chapter) = 1)
SELECT claims.*, chapter FROM claims LEFT JOIN best USING (diagnosis_code)
""",
    "code_prefixes": f"""
WITH {_CLAIMS},
p AS (SELECT substr(diagnosis_code, 1, 1) AS prefix FROM claims WHERE diagnosis_code < 'T'
      UNION SELECT substr(diagnosis_code, 1, 2) FROM claims WHERE diagnosis_code IS NOT NULL AND l_partkey % 5 = 0
      UNION SELECT diagnosis_code FROM claims WHERE diagnosis_code IS NOT NULL AND l_partkey % 7 = 0),
codes AS (SELECT DISTINCT diagnosis_code FROM claims WHERE diagnosis_code IS NOT NULL),
best AS (SELECT diagnosis_code, prefix FROM codes JOIN p ON starts_with(diagnosis_code, prefix)
         QUALIFY row_number() OVER (PARTITION BY diagnosis_code ORDER BY length(prefix) DESC) = 1)
SELECT claims.*, prefix AS matched_prefix, 'T-' || reverse(prefix) AS target FROM claims LEFT JOIN best USING (diagnosis_code)
""",
    "price_bands": """
WITH b AS (SELECT s_suppkey, CAST(round(s_acctbal * 4000) AS BIGINT) AS low, s_suppkey % 13 > 0 AS bounded,
                  CAST(power(10, s_suppkey % 8) AS BIGINT) AS width FROM supplier),
o AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
best AS (SELECT cents, s_suppkey FROM (SELECT DISTINCT cents FROM o) JOIN b ON bounded AND low >= 0 AND cents BETWEEN low AND low + width
         QUALIFY row_number() OVER (PARTITION BY cents ORDER BY width, low DESC, s_suppkey) = 1)
SELECT o_orderkey, cents, s_suppkey FROM o LEFT JOIN best USING (cents)
""",
}
