"""Model tests compiled into two scans.

Tests are data (:class:`Check`); any number of them over one table become

1. one aggregate over the table: rows looked at and rows that fail, per row
   test, and what table tests need (row count, greatest stamp);
2. one scan that turns each row into its entries - (test, key) for each row
   test it fails, (test, values) for each uniqueness test that it takes part
   in - counted by one grouped aggregate. Repeated values and the keys to
   show come from the same counts.

Both combine in the task before the shuffle, so a value that a third of all
rows share is one entry per task. Of failing keys at most ``sample`` per
test are kept (the least ones): a top-k that each task cuts first.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sinks.tables import write_table

ROW_KINDS = ("not_null", "accepted", "rejected", "range", "matches", "not_blank", "expression", "later_than")
TABLE_KINDS = ("fresh", "row_count", "row_count_change", "not_constant")
RESULT = ("test string, kind string, checked long, failed long, passed boolean, value string, sample array<string>")


@dataclass(frozen=True)
class Check:
    """One test. ``where`` (SQL) limits it to rows for which it is true.

    kind              what must hold                               args
    not_null          ``column`` has a value
    accepted          it is one of the values, or null             values
    rejected          it is none of the values                     values
    range             it lies between, ends included, or is null   low and / or high
    matches           the whole text matches, or is null           pattern
    not_blank         it has something but blanks, or is null
    expression        the SQL in ``column`` is not false
    later_than        it is not before another column              other
    unique            the values of ``columns`` occur once (rows with a null among them take no part)
    fresh             the greatest is at most so old               as_of, max_age (seconds)
    row_count         rows lie between                             low and / or high
    row_count_change  rows differ by at most this share            previous, share
    not_constant      at least two different values
    """
    name: str
    kind: str
    column: str | None = None
    columns: tuple = ()
    where: str | None = None
    args: dict = field(default_factory=dict)


def _holds(check: Check) -> Column:
    """Whether a row passes; null counts as passed."""
    c, a = (F.expr(check.column) if check.kind == "expression" else F.col(f"`{check.column}`")), check.args
    if check.kind == "not_null":
        return c.isNotNull()
    if check.kind == "accepted":
        return c.isin(list(a["values"]))
    if check.kind == "rejected":
        return ~c.isin(list(a["values"]))
    if check.kind == "range":
        out = F.lit(True)
        for end, fits in (("low", lambda x: c >= x), ("high", lambda x: c <= x)):
            if a.get(end) is not None:
                out = out & fits(F.lit(a[end]))
        return out
    if check.kind == "matches":
        return c.rlike(rf"\A(?:{a['pattern']})\z")
    if check.kind == "not_blank":
        return F.length(F.trim(c)) > 0
    if check.kind == "later_than":
        return c >= F.col(f"`{a['other']}`")
    return c


def _looked_at(check: Check) -> Column:
    return F.coalesce(F.expr(check.where), F.lit(False)) if check.where else F.lit(True)


def _fails(check: Check) -> Column:
    return _looked_at(check) & ~F.coalesce(_holds(check), F.lit(True))


def _key(columns) -> Column:
    """Values as one text, told apart whatever they hold."""
    return F.to_json(F.array(*[F.col(f"`{c}`").cast("string") for c in columns]))


def run_checks(df: DataFrame, checks, key, sample: int = 5) -> DataFrame:
    """One row for each check: test, kind, checked, failed, passed, value, sample.

    ``key`` names the columns that tell a row in the sample. ``failed``
    counts rows; for uniqueness, values that occur more than once. ``value``
    is what a table test saw. On an empty table row tests pass, and a
    freshness test fails.
    """
    checks, key = list(checks), [key] if isinstance(key, str) else list(key)
    spark = df.sparkSession
    names = [c.name for c in checks]
    unknown = [c.name for c in checks if c.kind not in (*ROW_KINDS, *TABLE_KINDS, "unique")]
    if len(set(names)) < len(names) or unknown:
        raise ValueError(f"repeated names or unknown kinds: {unknown or names}")
    # first scan
    aggs = []
    for i, c in enumerate(checks):
        aggs.append(F.count(F.when(_looked_at(c), 1)).alias(f"n{i}"))
        if c.kind in ROW_KINDS:
            aggs.append(F.count(F.when(_fails(c), 1)).alias(f"f{i}"))
        elif c.kind == "fresh":
            aggs.append(F.max(F.when(_looked_at(c), F.col(f"`{c.column}`"))).cast("timestamp_ntz").alias(f"v{i}"))
        elif c.kind == "not_constant":
            value = F.when(_looked_at(c), F.col(f"`{c.column}`"))
            aggs.append((F.min(value) != F.max(value)).alias(f"v{i}"))
    seen = df.agg(*aggs).first()
    # second scan
    entries = []
    for i, c in enumerate(checks):
        if c.kind in ROW_KINDS:
            entries.append(F.when(_fails(c), F.struct(F.lit(i).alias("test"), _key(key).alias("key"))))
        elif c.kind == "unique":
            whole = _looked_at(c)
            for x in c.columns:
                whole = whole & F.col(f"`{x}`").isNotNull()
            entries.append(F.when(whole, F.struct(F.lit(i).alias("test"), _key(c.columns).alias("key"))))
    repeated, samples = {}, {}
    if entries:
        unique = [i for i, c in enumerate(checks) if c.kind == "unique"]
        counted = (df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).groupBy("e.test", "e.key")
                   .agg(F.count("*").alias("n")).filter((F.col("n") > 1) | ~F.col("test").isin(unique)))
        kept = F.row_number().over(Window.partitionBy("test").orderBy("key")) <= sample
        # a test's total, and its least keys: two small aggregates over one stored result
        counted = counted.checkpoint()
        repeated = {r["test"]: r["count"] for r in counted.groupBy("test").count().collect()}
        for r in counted.withColumn("kept", kept).filter("kept").select("test", "key").orderBy("test", "key").collect():
            samples.setdefault(r["test"], []).append(r["key"])
    rows = []
    for i, c in enumerate(checks):
        checked, failed, value, a = seen[f"n{i}"], 0, None, c.args
        if c.kind in ROW_KINDS:
            failed = seen[f"f{i}"]
        elif c.kind == "unique":
            failed = repeated.get(i, 0)
        elif c.kind == "fresh":
            top = seen[f"v{i}"]
            value = None if top is None else top.isoformat(sep=" ")
            failed = int(top is None or (a["as_of"] - top) > dt.timedelta(seconds=a["max_age"]))
        elif c.kind == "not_constant":
            failed = int(not seen[f"v{i}"])
        elif c.kind == "row_count":
            value = str(checked)
            failed = int(checked < a.get("low", 0) or (a.get("high") is not None and checked > a["high"]))
        else:
            value = str(checked)
            failed = int(a.get("previous") is not None and abs(checked - a["previous"]) > a["share"] * a["previous"])
        rows.append((c.name, c.kind, checked, failed, failed == 0, value, samples.get(i, [])))
    return spark.createDataFrame(rows, RESULT)


def record_results(results: DataFrame, table: str, run: str, at: dt.datetime) -> int:
    """Append the results of one run to ``table``; returns rows written."""
    return write_table(results.withColumns({"run": F.lit(run), "tested_at": F.lit(at).cast("timestamp_ntz")}), table, mode="append")


def last_count(spark: SparkSession, table: str, test: str) -> int | None:
    """The row count that the last recorded run of a row-count test saw: ``previous`` of the next one."""
    if not spark.catalog.tableExists(table):
        return None
    row = (spark.table(table).filter((F.col("test") == test) & F.col("value").isNotNull())
           .agg(F.max_by("value", "tested_at").alias("value")).first())
    return int(row["value"]) if row and row["value"] is not None else None
