"""The corpus operators over the driver tables, with production parameters.

``QUERIES``: name to ``f(spark, sf_dir) -> DataFrame``. ``ORACLE``: DuckDB
SQL where SQL expresses the operator; the others are tested against a
brute-force version in tests/llm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (audit_queries, cutting_stock, golomb_dedup, hypergeometric_shards, mixing_ipf, multi_index, ordinal_quality, pii_bootstrap,
               simhash_pivots, url_rules, warc_writer)
from .common import read_table, scratch_uri, text_of


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golomb_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


EXACT_DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_pivots.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_bootstrap.find_personal_data(read_table(spark, sf_dir, "documents"))

    def joined(only_base: bool):
        spans = F.filter("spans", lambda x: x["found_by"] == "base") if only_base else F.col("spans")
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: (x["kind"] == kind) & (x["found_by"] == "base"))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii_bootstrap.KINDS), F.sha2(joined(True), 256).alias("base_sha256"), joined(False).alias("spans"))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_of("text")
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = hypergeometric_shards.shuffle_into_shards(docs, shards=24)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    labelled = pages.join(labels, pages["page_id"] == labels["doc_id"]).select("url", "bad")
    return url_rules.judge_urls(pages, labelled, URL_RULES, min_support=0.005, min_pages=5, min_confidence=0.5)


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return multi_index.nearest_neighbours(vectors, vectors.filter("vec_id % 50 = 0"), k=5, centroids=64, reach=0.5)


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = rate_documents(docs, sf_dir)
    return scored.select("doc_id", "expected_grade", F.col("top_probability").alias("tail_probability"),
                         (F.col("top_probability") >= TOP_AT_LEAST).alias("kept"))


TOP_AT_LEAST = 0.5


def rate_documents(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Grades from the labels: 2 good and not toxic, 1 with one fault, 0 with both."""
    ratings = read_table(docs.sparkSession, sf_dir, "labels").select(
        "doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("grade"))
    model = ordinal_quality.train(docs, ratings, max_rows=8000, bits=18)
    return ordinal_quality.score_documents(docs, model)


MIX_TARGETS = {"source": None, "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2, mixing_ipf.REST: mixing_ipf.OWN_SHARE}, "topic": {"process": 0.5, "quality": 0.3, "other": 0.2}}
MIX_LEXICONS = {"process": "tion|ción|ung|ment", "quality": "able|ble|lich|heit|elle|ado"}


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))


MIX = {"size": 0.5, "sweeps": 8, "tolerance": 0.0, "seed": 8}


def mix(docs: DataFrame) -> DataFrame:
    mixed = mixing_ipf.mix_documents(docs, MIX_TARGETS, MIX_LEXICONS, **MIX)
    return mixed.withColumn("epochs", F.round("epochs", 9))


def mixed_documents(docs: DataFrame) -> DataFrame:
    return mixing_ipf.repeat_documents(docs, MIX_TARGETS, MIX_LEXICONS, **MIX)


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def pack_documents(docs: DataFrame) -> DataFrame:
    pieces = cutting_stock.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                        capacity=1024, end_id=0)
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return cutting_stock.pack_pieces(digests, capacity=1024)


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_uri(spark, "warc")
    warc_writer.write_archives(read_table(spark, sf_dir, "pages"), folder)
    return warc_writer.read_archives(spark, folder, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
                  min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p
"""



def _mixing_sql(sweeps: int = 8) -> str:
    """The same fitting as a chain of windowed sums, one step for each margin of each sweep."""
    def shares(margin: str) -> str:
        wanted = MIX_TARGETS[margin]
        if wanted is None:
            return "1.0::DOUBLE"
        return f"CASE {margin} " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in wanted.items() if k != mixing_ipf.REST) + (
            " END" if mixing_ipf.REST in wanted else " ELSE 0.0::DOUBLE END")

    process, quality = (f"len(regexp_extract_all(coalesce(text, ''), '{p}'))" for p in MIX_LEXICONS.values())
    steps = ["""WITH f AS (SELECT doc_id, source, lang, 1 + strlen(coalesce(text, '')) - strlen(replace(coalesce(text, ''), ' ', '')) AS tokens,
  CASE WHEN p > 0 AND p >= q THEN 'process' WHEN q > 0 THEN 'quality' ELSE 'other' END AS topic
  FROM (SELECT *, %s AS p, %s AS q FROM documents)),
c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM f GROUP BY ALL)""" % (process, quality)]
    for m in mixing_ipf.MARGINS:
        # values without a target keep their own share
        steps.append(f"v_{m} AS (SELECT v, coalesce(own, w / sum(w) OVER () * (1 - coalesce(sum(own) OVER (), 0))) AS want FROM (SELECT {m} AS v, "
                     f"{shares(m)} AS w, CASE WHEN {shares(m)} IS NULL THEN sum(tokens) / sum(sum(tokens)) OVER () END AS own FROM c GROUP BY {m}))")
    joins = " ".join(f"LEFT JOIN v_{m} ON c.{m} IS NOT DISTINCT FROM v_{m}.v" for m in mixing_ipf.MARGINS)
    steps.append("w0 AS (SELECT c.*, " + ", ".join(f"v_{m}.want AS want_{m}" for m in mixing_ipf.MARGINS)
                 + f", c.tokens / sum(c.tokens) OVER () AS weight FROM c {joins})")
    n = 0
    for _ in range(sweeps):
        for m in mixing_ipf.MARGINS:
            held = f"sum(weight) OVER (PARTITION BY {m})"
            # materialised: else each step would be planned into the next
            steps.append(f"w{n + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {held} > 0 THEN weight * want_{m} / {held} "
                         f"ELSE 0.0 END AS weight) FROM w{n})")
            n += 1
    return ",\n".join(steps) + f"""
SELECT doc_id, source, lang, topic, tokens, round(e, 9) AS epochs,
       CAST(floor(e + CAST('0x' || substr(md5('8:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) / 281474976710656.0)
            AS BIGINT) AS copies
FROM (SELECT f.*, r.e
      FROM f LEFT JOIN (SELECT *, weight * 0.5 * (SELECT sum(tokens) FROM c) / tokens AS e FROM w{n}) r
      ON f.source IS NOT DISTINCT FROM r.source AND f.lang IS NOT DISTINCT FROM r.lang AND f.topic = r.topic)
"""


URL_SQL = """
WITH RECURSIVE u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(coalesce(url, ''), '^[^?#]*\\?([^#]*)', 1) AS query FROM u),
j AS (SELECT page_id, url, host, path,
  CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
       WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
       WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
  list_distinct([x FOR x IN list_concat(
    ['h:' || split_part(x, '=', 1) FOR x IN string_split(host, '.')],
    ['p:' || split_part(x, '=', 1) FOR x IN string_split(path, '/')],
    ['q:' || split_part(x, '=', 1) FOR x IN string_split(query, '&')]) IF length(x) > 2 AND NOT contains(x, ' ')]) AS tokens
  FROM h),
l AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels GROUP BY 1),
b AS (SELECT row_number() OVER () AS basket, tokens, bad FROM j JOIN l ON page_id = doc_id WHERE bad IS NOT NULL AND len(tokens) > 0),
least AS (SELECT greatest(5, ceil(0.005 * count(*))) AS n FROM b),
t AS (SELECT basket, unnest(tokens) AS token FROM b WHERE bad),
f AS (SELECT token FROM t GROUP BY 1 HAVING count(*) >= (SELECT n FROM least)),
x AS (SELECT basket, list_sort(list(token)) AS tokens FROM t JOIN f USING (token) GROUP BY basket),
s(items, n) AS (SELECT [token], count(*) FROM t JOIN f USING (token) GROUP BY token
  UNION ALL
  SELECT list_append(items, token), count(*)
  FROM (SELECT s.items, unnest([y FOR y IN x.tokens IF y > s.items[-1]]) AS token FROM s JOIN x ON list_has_all(x.tokens, s.items))
  GROUP BY items, token HAVING count(*) >= (SELECT n FROM least)),
r AS (SELECT items FROM (SELECT items, any_value(s.n) AS n, count(*) AS pages FROM s JOIN b ON list_has_all(b.tokens, s.items) GROUP BY items)
      WHERE n >= 0.5 * pages),
short AS (SELECT items FROM r WHERE NOT EXISTS (SELECT 1 FROM r q WHERE len(q.items) < len(r.items) AND list_has_all(r.items, q.items))),
blocked AS (SELECT DISTINCT url FROM j JOIN short ON list_has_all(j.tokens, short.items) WHERE rule IS NULL)
SELECT page_id, url, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN url IN (SELECT url FROM blocked WHERE url IS NOT NULL) THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""


QUERIES = {
    "op1_exact_dedup": exact_dedup,
    "op2_simhash_near_dedup": simhash_near_dedup,
    "op3_personal_data": personal_data,
    "op4_sharding": sharding,
    "op5_url_filter": url_filter,
    "op6_nearest_vectors": nearest_vectors,
    "op7_quality_classifier": quality_classifier,
    "op8_mixing": mixing,
    "op9_packing": packing,
    "op10_warc": warc,
    **audit_queries.QUERIES,
}

ORACLE = {
    "op1_exact_dedup": EXACT_DEDUP_SQL,
    "op5_url_filter": URL_SQL,
    "op8_mixing": _mixing_sql(),
    "op10_warc": WARC_SQL,
    **audit_queries.ORACLE,
}
