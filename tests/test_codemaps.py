"""Mapping by prefix and by interval against brute force."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerkit.operators.codemaps import code_number, interval_blocks, map_by_interval, map_by_number, map_by_prefix


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(0, 300)), min_size=1, max_size=30))
def test_blocks_are_disjoint_and_make_up_the_interval(spark, ends):
    rows = [(min(e), max(e)) for e in ends] + [(0, 0), (0, (1 << 61) - 2), (12345678901, 98765432109876)]
    df = spark.createDataFrame(rows, "a long, b long").withColumn("blocks", interval_blocks(F.col("a"), F.col("b")))
    for r in df.collect():
        runs = sorted((x.block << x.level, (x.block + 1) << x.level) for x in r.blocks)
        assert runs[0][0] == r.a and runs[-1][1] == r.b + 1 and all(p[1] == q[0] for p, q in zip(runs, runs[1:]))
        assert len(runs) <= 2 * 62


def test_numbers_match_the_narrowest_interval(spark):
    rng = random.Random(4)
    table = [(rng.randrange(1000), 0, f"v{i}") for i in range(60)]
    table = [(a, a + rng.choice([0, 1, 5, 50, 400]), v) for a, _, v in table] + [(10, 20, "z"), (10, 20, "y"), (None, 5, "x"), (5, None, "x"), (9, 3, "x"), (-4, 7, "x")]
    numbers = [(i, rng.choice([None, -3, rng.randrange(1500)])) for i in range(400)] + [(1000, 15)] * 50
    got = map_by_number(spark.createDataFrame(numbers, "i int, n long"), "n", spark.createDataFrame(table, "lo long, hi long, v string"), "lo", "hi", "v")

    def want(n):
        fit = [(b - a, -a, v) for a, b, v in table if n is not None and a is not None and b is not None and 0 <= a <= n <= b]
        return min(fit)[2] if fit else None
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in [got.collect()[0].__class__(i=i, n=n, v=want(n)) for i, n in numbers])
    plan = plan_of(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


CHAPTERS = [("C00", "D48", "neoplasms"), ("D50", "D89", "blood"), ("C50", "C50", "breast"), ("H00", "H59", "eye"), ("H60", "H95", "ear"),
            (None, "Z", "no"), ("X", "A", "no"), ("d4", "d4", "all of d4")]


def test_codes_match_intervals_with_all_their_continuations(spark):
    codes = ["C00", "c50.9", "C51", "D48.9", "D49", "D50", "D899", "H59", "H60.0", "H959Z", "H96", None, "", "?", "D 4-8", "D47"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, code string")
    got = map_by_interval(df, "code", spark.createDataFrame(CHAPTERS, "a string, b string, chapter string"), "a", "b", "chapter", characters=5)
    assert {r.code: r.chapter for r in got.collect()} == {
        "C00": "neoplasms", "c50.9": "breast", "C51": "neoplasms", "D48.9": "all of d4", "D49": "all of d4", "D50": "blood", "D899": "blood", "H59": "eye",
        "H60.0": "ear", "H959Z": "ear", "H96": None, None: None, "": None, "?": None, "D 4-8": "all of d4", "D47": "all of d4"}
    with pytest.raises(ValueError, match="more than 2"):
        map_by_interval(df, "code", spark.createDataFrame(CHAPTERS, "a string, b string, chapter string"), "a", "b", "chapter", characters=2)


def test_code_numbers_order_as_text(spark):
    rng = random.Random(2)
    texts = sorted({"".join(rng.choice("09AZK") for _ in range(rng.randint(1, 6))) for _ in range(300)})
    rows = spark.createDataFrame([(t,) for t in texts], "c string").select("c", code_number("c", 6).alias("n")).collect()
    assert [r.c for r in sorted(rows, key=lambda r: r.n)] == texts


def test_longest_prefix(spark):
    rng = random.Random(3)
    table = [("", "any"), ("A", "a"), ("AB", "ab2"), ("AB", "ab1"), ("ABCD", "abcd"), (None, "no"), ("é", "acute")]
    codes = [None, "", "A", "ABC", "ABCDE", "B", "étude", "AC"] + ["".join(rng.choice("ABCD") for _ in range(4)) for _ in range(60)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, code string")
    for listed in (table, table[1:], []):
        got = map_by_prefix(df, "code", spark.createDataFrame(listed, "p string, v string"), "p", "v")
        for r in got.collect():
            fit = [(-len(p), v, p) for p, v in listed if p is not None and r.code is not None and r.code.startswith(p)]
            assert (r.matched_prefix, r.v) == ((min(fit)[2], min(fit)[1]) if fit else (None, None))
        assert "NestedLoop" not in plan_of(got)


def test_rows_are_kept_and_clashing_columns_refused(spark):
    df = spark.createDataFrame([("A1", 1), ("A1", 1), (None, 2)], "code string, v int")
    table = spark.createDataFrame([("A", "x")], "p string, w string")
    assert map_by_prefix(df, "code", table, "p", "w").count() == 3
    assert map_by_prefix(df.limit(0), "code", table, "p", "w").collect() == []
    with pytest.raises(ValueError, match="there already"):
        map_by_prefix(df, "code", table.withColumnRenamed("w", "v"), "p", "v")


def test_a_code_is_numbered_once_and_not_in_each_row(spark):
    df = spark.range(100).select(F.concat(F.lit("A0"), (F.col("id") % 5).cast("string")).alias("code")).localCheckpoint()
    table = spark.createDataFrame([("A00", "A02", "low"), ("A03", "B99", "high")], "low string, high string, name string")
    out = map_by_interval(df, "code", table, "low", "high", "name", characters=5)
    assert {(r["code"], r["name"]) for r in out.collect()} == {("A00", "low"), ("A01", "low"), ("A02", "low"), ("A03", "high"), ("A04", "high")}
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    numbering = [i for i, line in enumerate(lines) if "regexp_replace(code#" in line or "regexp_replace(__code#" in line]
    assert numbering and all("Aggregate [" in "".join(lines[i:i + 3]) for i in numbering)     # over the distinct codes, never over the rows
