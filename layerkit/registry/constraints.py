"""Model tests on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.constraints import Check, last_count, record_results, run_checks
from .common import t
from .io import scratch_db

AS_OF = dt.datetime(2001, 6, 1)


def model_tests(spark, sf_dir):
    """Thirteen kinds of test over line items in two scans, after a run over half of the orders was recorded."""
    log = f"{scratch_db(spark, 'tests')}.results"
    lines = t(spark, sf_dir, "lineitem")
    half = run_checks(lines.filter("l_orderkey % 2 = 0"), [Check("rows", "row_count")], "l_orderkey")
    record_results(half, log, "first", dt.datetime(2001, 1, 1))
    checks = [
        Check("part", "not_null", "l_partkey"), Check("flag", "accepted", "l_returnflag", args={"values": ["A", "N"]}),
        Check("status", "rejected", "l_linestatus", args={"values": ["F"]}, where="l_quantity > 45"),
        Check("discount", "range", "l_discount", args={"low": 0.01, "high": 0.09}), Check("one_letter", "matches", "l_returnflag", args={"pattern": "[NR]"}),
        Check("text", "not_blank", "l_linestatus"), Check("tax", "expression", "l_tax <= l_discount or l_quantity < 10"),
        Check("line", "unique", columns=("l_orderkey", "l_linenumber")),
        Check("line_of_flag", "unique", columns=("l_orderkey", "l_linenumber"), where="l_returnflag = 'R'"),
        Check("recent", "fresh", "l_shipdate", args={"as_of": AS_OF, "max_age": 30 * 86400}),
        Check("rows", "row_count", args={"low": 10}), Check("grown", "row_count_change", args={"previous": last_count(spark, log, "rows"), "share": 0.5}),
        Check("varies", "not_constant", "l_linestatus"),
    ]
    found = run_checks(lines, checks, ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), sample=3)
    return found.withColumn("sample", F.array_join("sample", ";")).drop("kind")


QUERIES = {"model_tests": model_tests}


def _row(name: str, holds: str, where: str = "TRUE") -> str:
    bad = f"({where}) AND NOT coalesce({holds}, TRUE)"
    return f"""
SELECT '{name}' AS test, count(*) FILTER ({where}) AS checked, count(*) FILTER ({bad}) AS failed, count(*) FILTER ({bad}) = 0 AS passed,
       CAST(NULL AS VARCHAR) AS value,
       coalesce((SELECT string_agg(k, ';' ORDER BY k) FROM (SELECT DISTINCT k FROM l WHERE {bad} ORDER BY k LIMIT 3)), '') AS sample FROM l"""


def _unique(name: str, where: str = "TRUE") -> str:
    twice = (f"(SELECT '[\"' || l_orderkey || '\",\"' || l_linenumber || '\"]' AS k FROM l WHERE ({where}) AND l_orderkey IS NOT NULL "
             "AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
    return f"""
SELECT '{name}', count(*) FILTER ({where}), (SELECT count(*) FROM {twice}), (SELECT count(*) FROM {twice}) = 0, NULL,
       coalesce((SELECT string_agg(k, ';' ORDER BY k) FROM (SELECT k FROM {twice} ORDER BY k LIMIT 3)), '') FROM l"""


ORACLE = {"model_tests": r"""
WITH l AS (SELECT *, '["' || l_orderkey || '","' || l_linenumber || '","' || l_partkey || '","' || l_suppkey || '"]' AS k FROM lineitem)""" + " UNION ALL ".join([
    _row("part", "l_partkey IS NOT NULL"), _row("flag", "l_returnflag IN ('A', 'N')"), _row("status", "l_linestatus NOT IN ('F')", "l_quantity > 45"),
    _row("discount", "l_discount BETWEEN 0.01::DOUBLE AND 0.09::DOUBLE"), _row("one_letter", "regexp_full_match(l_returnflag, '[NR]')"),
    _row("text", "length(trim(l_linestatus)) > 0"), _row("tax", "l_tax <= l_discount OR l_quantity < 10"),
    _unique("line"), _unique("line_of_flag", "l_returnflag = 'R'"),
    f"""
SELECT 'recent', count(*), CAST(max(l_shipdate) < TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AS BIGINT),
       max(l_shipdate) >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S'), '' FROM l""",
    "\nSELECT 'rows', count(*), CAST(count(*) < 10 AS BIGINT), count(*) >= 10, CAST(count(*) AS VARCHAR), '' FROM l",
    """
SELECT 'grown', count(*), CAST(abs(count(*) - count(*) FILTER (l_orderkey % 2 = 0)) > 0.5 * count(*) FILTER (l_orderkey % 2 = 0) AS BIGINT),
       abs(count(*) - count(*) FILTER (l_orderkey % 2 = 0)) <= 0.5 * count(*) FILTER (l_orderkey % 2 = 0), CAST(count(*) AS VARCHAR), '' FROM l""",
    """
SELECT 'varies', count(*), CAST(min(l_linestatus) = max(l_linestatus) AS BIGINT), min(l_linestatus) <> max(l_linestatus), NULL, '' FROM l"""])}
