"""Column-function, de-duplication and join queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (age_from_date, age_from_year, cast_columns, decode,
                         difference, flag, full_match, is_present, lenient_int,
                         minutes_between, null_if_token, parse_timestamp,
                         surrogate_key, to_date, truncate_int, try_cast, year_month)
from ..operators import (distinct_on, frequency, keep_latest, keyed_diff, lookup,
                         normalise, preview, split_by_tag)
from ..functions.dates import prefix
from .common import AS_OF, iso_z_text, order_lines, t

# Order status and part-type letter decodes used by the queries.
STATUS_LABELS = {"F": "Fulfilled", "O": "Open"}
PARTIAL_LABELS = {"P": "Partial"}
TYPE_LETTER_CATEGORY = {"E": "Economy", "L": "Large", "M": "Medium", "S": "Small"}
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _price_text(c: str):
    """Money double → its exact two-decimal text (same text in every engine)."""
    return F.col(c).cast("decimal(12,2)").cast("string")


def decode_status(spark, sf_dir):
    """C1 (text default) / C2 (NULL default) / C3 flag / F3 presence flag."""
    o = t(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_orderstatus",
        decode("o_orderstatus", STATUS_LABELS, "Unknown").alias("status_label"),
        decode("o_orderstatus", PARTIAL_LABELS, None).alias("partial_label"),
        flag(F.col("o_orderstatus") == "O").alias("is_open"),
        is_present("o_orderpriority").alias("has_priority"))


def sentinel_date(spark, sf_dir):
    """C4 + C5: a ``-`` sentinel becomes NULL, the rest parses as a date."""
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", F.lit("-"))
         .otherwise(F.to_date("o_orderdate").cast("string")).alias("date_text"))
    return o.select("o_orderkey", "date_text",
                    try_cast(null_if_token("date_text", ["-"]), "date").alias("parsed_date"))


def cast_matrix(spark, sf_dir):
    """Null-tolerant casts of text, with junk for partial orders."""
    o = t(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(_price_text("o_totalprice"))
    k = F.col("o_orderkey") % 7
    whole = (F.when(k == 0, "1.99999").when(k == 1, "-0.99996").when(k == 2, "99999999999.5")
              .when(k == 3, "1.9x").when(k == 4, "1.25e3").otherwise(_price_text("o_totalprice")))
    raw = o.select("o_orderkey", "o_totalprice", "o_orderdate",
                   text.alias("as_double"), whole.alias("as_int"), text.alias("as_decimal"),
                   F.concat(F.lit("9999"), _price_text("o_totalprice")).alias("overflow_decimal"))
    typed = cast_columns(raw, {"as_double": "double", "as_int": "int",
                               "as_decimal": "decimal(10,2)", "overflow_decimal": "decimal(10,2)"})
    return typed.select("o_orderkey", "as_double", "as_int", "as_decimal", "overflow_decimal",
                        truncate_int("o_totalprice").alias("price_int"),
                        to_date("o_orderdate").alias("order_day"))


def parse_timestamp_q(spark, sf_dir):
    """ISO text with a literal Z parsed back; malformed text → NULL."""
    e = t(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("bad:"), F.col("props"))) \
            .otherwise(iso_z_text("ts"))
    parsed = parse_timestamp(text, ISO_Z, ntz=True)
    return e.select("event_id", parsed.alias("parsed_ts"))


def split_value(spark, sf_dir):
    """One text column split into a number and a text by a type tag."""
    e = t(spark, sf_dir, "events")
    tag = (F.when(F.col("event_type").isin("purchase", "error"), F.lit("numeric"))
            .when(F.col("event_type") == "view", F.lit("text"))
            .otherwise(F.col("event_type")))
    value = F.when(F.col("event_type") == "purchase", F.col("value").cast("string")) \
             .otherwise(F.col("props"))
    raw = e.select("event_id", tag.alias("value_type"), value.alias("value"))
    return split_by_tag(raw, "value", "value_type")


def regex_flag(spark, sf_dir):
    """whole-string regex flags on page URLs."""
    p = t(spark, sf_dir, "pages")
    page_no = F.regexp_extract("url", r"/([0-9]+)", 1)
    return p.select(
        "page_id",
        full_match("url", r"https://.*").alias("is_secure"),
        full_match("url", r"https?://[a-z.]+/[a-z]{2}/[0-9]+").alias("is_plain_path"),
        full_match(page_no, r"[0-9]{3}").alias("has_three_digit_id"))


def surrogate_key_q(spark, sf_dir):
    """KEY1: md5 of the natural key parts joined by ``_`` (and the NULL-safe form)."""
    li = t(spark, sf_dir, "lineitem")
    parts = ["l_orderkey", "l_linenumber", F.to_date("l_shipdate")]
    return li.select("l_orderkey", "l_linenumber",
                     surrogate_key(parts).alias("line_key"),
                     surrogate_key(parts + ["l_returnflag"], null_token="\\N").alias("line_key_safe"))


def age_as_of(spark, sf_dir):
    """DER1/DER2: ages at a fixed reference day from a date and from a year."""
    o = t(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        age_from_date("o_orderdate", AS_OF).alias("age_days365"),
        age_from_date("o_orderdate", AS_OF, mode="calendar").alias("age_calendar"),
        age_from_year(F.year("o_orderdate"), AS_OF).alias("age_from_year"))


def duration_minutes(spark, sf_dir):
    """DER3: whole minutes, truncated toward zero (also for negative spans)."""
    lines = order_lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        minutes_between("o_orderdate", "l_shipdate").alias("ship_minutes"),
        minutes_between("o_orderdate", F.lit("9999-12-31 23:59:30").cast("timestamp_ntz")).alias("open_minutes"))
    return lines


def event_minutes(spark, sf_dir):
    """DER3 on sub-second stamps: minutes from the event back to its midnight."""
    e = t(spark, sf_dir, "events")
    midnight = F.to_date("ts").cast("timestamp_ntz")
    return e.select("event_id",
                    minutes_between("ts", midnight).alias("minutes_to_midnight"),
                    minutes_between(midnight, "ts").alias("minutes_since_midnight"))


def money_difference(spark, sf_dir):
    """C10 + DER5: text → decimal(10,2) money, and their difference."""
    li = t(spark, sf_dir, "lineitem")
    raw = li.select("l_orderkey", "l_linenumber",
                    _price_text("l_extendedprice").alias("line_charge"),
                    _price_text("l_quantity").alias("line_allowed"))
    typed = cast_columns(raw, {"line_charge": "decimal(10,2)", "line_allowed": "decimal(10,2)"})
    return typed.withColumn("cost_reduction", difference("line_charge", "line_allowed"))


def year_month_q(spark, sf_dir):
    """DER4: year and month partition columns."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return year_month(o, "o_orderdate", "order").drop("o_orderdate")


def dedup_latest(spark, sf_dir):
    """Keep the latest line per (order, line number) by ship date."""
    li = t(spark, sf_dir, "lineitem")
    return keep_latest(li, ["l_orderkey", "l_linenumber"], "l_shipdate")


def drop_duplicates(spark, sf_dir):
    """Distinct keys (survivor choice is irrelevant on the key projection)."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return distinct_on(li, ["l_orderkey", "l_linenumber"])


def preview_limit(spark, sf_dir):
    """O2: the 20 most expensive orders (top-k is the feature)."""
    o = t(spark, sf_dir, "orders")
    return preview(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20)


def value_frequency(spark, sf_dir):
    """A10: customers per market segment."""
    return frequency(t(spark, sf_dir, "customer"), "c_mktsegment")


def anti_join(spark, sf_dir):
    """Orders that have no line items."""
    o = t(spark, sf_dir, "orders")
    li = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return o.join(li, on="o_orderkey", how="left_anti")


def keyed_diff_q(spark, sf_dir):
    """ADDED / REMOVED / CHANGED between two versions of orders."""
    o = t(spark, sf_dir, "orders")
    old = o.filter(F.col("o_orderstatus") != "P").select("o_orderkey", "o_orderpriority")
    new = (o.filter(F.col("o_orderdate") >= F.lit("1995-06-01").cast("timestamp_ntz"))
            .select("o_orderkey",
                    F.when(F.col("o_orderstatus") == "O", F.lit("1-URGENT"))
                     .otherwise(F.col("o_orderpriority")).alias("o_orderpriority")))
    return keyed_diff(old, new, "o_orderkey", "o_orderpriority")


def inline_lookup(spark, sf_dir):
    """S5 + J1: part-type letter → category via a broadcast mapping (P unmapped)."""
    p = t(spark, sf_dir, "part").select("p_partkey", "p_type")
    return lookup(p, TYPE_LETTER_CATEGORY, on="type_letter", value="type_category",
                  key_expr=prefix("p_type", 1))


def code_mapping(spark, sf_dir):
    """Map codes through a mapping *table* (unique keys checked; broadcast
    only under the row bound, else a shuffle join)."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    mapping = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"),
                                              F.col("p_brand").alias("mapped_brand"))
    return lookup(li, mapping, on="l_partkey", check_unique=True)


def normalise_columns(spark, sf_dir):
    """Mixed-case source → lower-case, renamed, PII dropped, derived."""
    c = t(spark, sf_dir, "customer")
    c = c.toDF(*[n.upper() for n in c.columns])
    n = normalise(c, rename={"c_custkey": "customer_id", "c_mktsegment": "segment"},
                  drop=("c_name",))
    nat = t(spark, sf_dir, "nation").alias("n")
    out = n.alias("c").join(nat, F.col("c.c_nationkey") == F.col("n.n_nationkey"), "left")
    return out.select("c.customer_id", "c.c_nationkey", "c.c_acctbal", "c.segment",
                      F.col("n.n_name").alias("nation_name"),
                      lenient_int(F.col("c.c_acctbal")).alias("acctbal_int"))


QUERIES = {
    "decode_status": decode_status,
    "sentinel_date": sentinel_date,
    "cast_matrix": cast_matrix,
    "parse_timestamp": parse_timestamp_q,
    "split_value": split_value,
    "regex_flag": regex_flag,
    "surrogate_key": surrogate_key_q,
    "age_as_of": age_as_of,
    "duration_minutes": duration_minutes,
    "event_minutes": event_minutes,
    "money_difference": money_difference,
    "year_month": year_month_q,
    "dedup_latest": dedup_latest,
    "drop_duplicates": drop_duplicates,
    "preview_limit": preview_limit,
    "value_frequency": value_frequency,
    "anti_join": anti_join,
    "keyed_diff": keyed_diff_q,
    "inline_lookup": inline_lookup,
    "normalise_columns": normalise_columns,
    "code_mapping": code_mapping,
}

_PRICE_TEXT = "CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)"

ORACLE = {
    "decode_status": """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN 'Fulfilled' WHEN o_orderstatus = 'O' THEN 'Open'
            ELSE 'Unknown' END AS status_label,
       CASE WHEN o_orderstatus = 'P' THEN 'Partial' ELSE NULL END AS partial_label,
       COALESCE(o_orderstatus = 'O', FALSE) AS is_open,
       o_orderpriority IS NOT NULL AS has_priority
FROM orders
""",
    "sentinel_date": """
WITH x AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'O' THEN '-' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
           AS date_text
  FROM orders)
SELECT o_orderkey, date_text, TRY_CAST(NULLIF(date_text, '-') AS DATE) AS parsed_date FROM x
""",
    "cast_matrix": f"""
WITH x AS (
  SELECT o_orderkey, o_totalprice, o_orderdate,
         CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE {_PRICE_TEXT.format(c='o_totalprice')} END AS txt,
         '9999' || {_PRICE_TEXT.format(c='o_totalprice')} AS big
  FROM orders)
SELECT o_orderkey,
       TRY_CAST(txt AS DOUBLE) AS as_double,
       CASE o_orderkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 1250
            ELSE CAST(FLOOR(CAST(o_totalprice AS DECIMAL(12,2))) AS INTEGER) END AS as_int,
       TRY_CAST(txt AS DECIMAL(10,2)) AS as_decimal,
       TRY_CAST(big AS DECIMAL(10,2)) AS overflow_decimal,
       TRY_CAST(TRUNC(o_totalprice) AS INTEGER) AS price_int,
       CAST(o_orderdate AS DATE) AS order_day
FROM x
""",
    "parse_timestamp": """
SELECT event_id,
       TRY_STRPTIME(CASE WHEN event_type = 'error' THEN 'bad:' || props
                         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END,
                    '%Y-%m-%dT%H:%M:%SZ') AS parsed_ts
FROM events
""",
    "split_value": """
WITH x AS (
  SELECT event_id,
         CASE WHEN event_type IN ('purchase', 'error') THEN 'numeric'
              WHEN event_type = 'view' THEN 'text' ELSE event_type END AS value_type,
         CASE WHEN event_type = 'purchase' THEN CAST(value AS VARCHAR) ELSE props END AS value
  FROM events)
SELECT event_id, value_type,
       CASE WHEN value_type = 'numeric' THEN TRY_CAST(value AS DOUBLE) END AS numeric_value,
       CASE WHEN value_type = 'text' THEN value END AS text_value
FROM x
""",
    "regex_flag": """
SELECT page_id,
       regexp_full_match(url, 'https://.*') AS is_secure,
       regexp_full_match(url, 'https?://[a-z.]+/[a-z]{2}/[0-9]+') AS is_plain_path,
       regexp_full_match(regexp_extract(url, '/([0-9]+)', 1), '[0-9]{3}') AS has_three_digit_id
FROM pages
""",
    "surrogate_key": """
SELECT l_orderkey, l_linenumber,
       md5(concat_ws('_', l_orderkey, l_linenumber, CAST(l_shipdate AS DATE))) AS line_key,
       md5(concat_ws('_', COALESCE(CAST(l_orderkey AS VARCHAR), '\\N'),
                          COALESCE(CAST(l_linenumber AS VARCHAR), '\\N'),
                          COALESCE(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), '\\N'),
                          COALESCE(l_returnflag, '\\N'))) AS line_key_safe
FROM lineitem
""",
    "age_as_of": """
WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, DATE '2024-06-30' AS r FROM orders)
SELECT o_orderkey,
       CAST(TRUNC(date_diff('day', d, r) / 365.0) AS INTEGER) AS age_days365,
       CAST(year(r) - year(d)
            - CASE WHEN month(r) < month(d) OR (month(r) = month(d) AND day(r) < day(d))
                   THEN 1 ELSE 0 END AS INTEGER) AS age_calendar,
       CAST(year(r) - year(d) AS INTEGER) AS age_from_year
FROM x
""",
    "duration_minutes": """
SELECT l.l_orderkey, l.l_linenumber,
       CAST(TRUNC((FLOOR(epoch(l.l_shipdate)) - FLOOR(epoch(o.o_orderdate))) / 60.0) AS BIGINT)
         AS ship_minutes,
       (epoch_us(TIMESTAMP '9999-12-31 23:59:30') - epoch_us(o.o_orderdate)) // 60000000 AS open_minutes
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""",
    "event_minutes": """
SELECT event_id,
       CAST(TRUNC((FLOOR(epoch(date_trunc('day', ts))) - FLOOR(epoch(ts))) / 60.0) AS BIGINT)
         AS minutes_to_midnight,
       CAST(TRUNC((FLOOR(epoch(ts)) - FLOOR(epoch(date_trunc('day', ts)))) / 60.0) AS BIGINT)
         AS minutes_since_midnight
FROM events
""",
    "money_difference": f"""
WITH x AS (
  SELECT l_orderkey, l_linenumber,
         TRY_CAST({_PRICE_TEXT.format(c='l_extendedprice')} AS DECIMAL(10,2)) AS line_charge,
         TRY_CAST({_PRICE_TEXT.format(c='l_quantity')} AS DECIMAL(10,2)) AS line_allowed
  FROM lineitem)
SELECT l_orderkey, l_linenumber, line_charge, line_allowed,
       line_charge - line_allowed AS cost_reduction
FROM x
""",
    "year_month": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_month
FROM orders
""",
    "dedup_latest": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
           l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
           l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
           l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1
""",
    "drop_duplicates": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "preview_limit": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "value_frequency": "SELECT c_mktsegment, COUNT(*) AS count FROM customer GROUP BY c_mktsegment",
    "anti_join": """
SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""",
    "keyed_diff": """
WITH old AS (SELECT o_orderkey, o_orderpriority AS v FROM orders WHERE o_orderstatus <> 'P'),
new AS (SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'O' THEN '1-URGENT' ELSE o_orderpriority END AS v
        FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-01')
SELECT n.o_orderkey, 'ADDED' AS change, CAST(NULL AS VARCHAR) AS old_value, n.v AS new_value
FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.o_orderkey = n.o_orderkey)
UNION ALL
SELECT o.o_orderkey, 'REMOVED', o.v, CAST(NULL AS VARCHAR)
FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.o_orderkey = o.o_orderkey)
UNION ALL
SELECT n.o_orderkey, 'CHANGED', o.v, n.v
FROM new n JOIN old o ON o.o_orderkey = n.o_orderkey
WHERE o.v IS DISTINCT FROM n.v
""",
    "inline_lookup": """
SELECT substr(p.p_type, 1, 1) AS type_letter, p.p_partkey, p.p_type, m.type_category
FROM part p
LEFT JOIN (VALUES ('E', 'Economy'), ('L', 'Large'), ('M', 'Medium'), ('S', 'Small'))
  AS m(type_letter, type_category) ON substr(p.p_type, 1, 1) = m.type_letter
""",
    "code_mapping": """
SELECT l.l_partkey, l.l_orderkey, l.l_linenumber, p.p_brand AS mapped_brand
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
""",
    "normalise_columns": """
SELECT c.c_custkey AS customer_id, c.c_nationkey, c.c_acctbal, c.c_mktsegment AS segment,
       n.n_name AS nation_name,
       CAST(TRUNC(c.c_acctbal) AS INTEGER) AS acctbal_int
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
}
