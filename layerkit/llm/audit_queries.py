"""Source divergence, filter interaction and toxicity over the driver tables, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import filter_tries, gated_toxicity, transducer_vocabulary
from .common import read_table


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer_vocabulary.divergence_audit(read_table(spark, sf_dir, "documents"), min_docs=30, top_terms=50)


SOURCE_DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
           FROM documents),
tok AS (SELECT r, lang, source, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
        FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS x FROM d)),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM tok JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT g.lang, g.source, coalesce(v.v, 0) AS v, coalesce(u.n, 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN v USING (lang)
      LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) u USING (lang, source)),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * g.v) AS p
      FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT p.lang, p.term, 1 + (1000000000::HUGEINT * (sum(p.n) + 5)) // (any_value(w.n) + 5 * any_value(w.v)) AS q
      FROM p JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM g GROUP BY lang) w USING (lang) GROUP BY p.lang, p.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT s.lang, s.source, o.source AS item, sum(abs(s.p - o.p)) AS value
                     FROM p s JOIN p o ON s.lang = o.lang AND s.term = o.term AND s.source <> o.source GROUP BY ALL) x
          ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
every AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 50
"""


def filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_tries.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


FILTER_INTERACTION_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (SELECT doc_id, part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
             regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) AS e FROM w),
k AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, [x FOR x, i IN ['A', 'B', 'C', 'D', 'E'] IF [a, b, c, d, e][i]] AS fails, count(*) AS n,
             count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN k USING (doc_id) GROUP BY ALL),
s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT s1.x || s2.x || s3.x || s4.x || s5.x AS filter_order FROM s s1, s s2, s s3, s s4, s s5
      WHERE len(list_distinct([s1.x, s2.x, s3.x, s4.x, s5.x])) = 5),
t AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
r AS (SELECT part, filter_order, step, n, good, toxic, substr(filter_order, step, 1) AS filter, fails,
             list_contains(fails, substr(filter_order, step, 1)) AS here,
             len([x FOR x IN fails IF contains(substr(filter_order, 1, step - 1), x)]) > 0 AS gone FROM m, t),
c AS (SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (NOT gone AND NOT here), 0) AS kept,
             coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (here AND gone), 0) AS redundant,
             coalesce(sum(n) FILTER (fails = [filter]), 0) AS unique_fails,
             coalesce(sum(good) FILTER (here AND NOT gone), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (here AND NOT gone), 0) AS toxic_lost
      FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM c
"""


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = gated_toxicity.train(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return gated_toxicity.score_documents(docs, model, threshold=0.3)


QUERIES = {
    "op11_source_divergence": source_divergence,
    "op12_filter_interaction": filter_interaction,
    "op13_toxicity": toxicity,
}

ORACLE = {
    "op11_source_divergence": SOURCE_DIVERGENCE_SQL,
    "op12_filter_interaction": FILTER_INTERACTION_SQL,
}
