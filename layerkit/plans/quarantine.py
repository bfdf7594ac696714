"""CSV ingestion with a quarantine of bad records.

The plain scan takes what the reader makes of a line: a short line gets
nulls, a long one loses fields, an unclosed quote swallows the rest, and a
value that cannot be typed becomes null. Here every line either becomes a
typed row or is kept as it stands, with its file and all reasons.

Lines are read as text, so the line itself is at hand whatever is wrong with
it, and parsed by Spark's ``from_csv``; fields are counted outside quotes.
Both kinds go through one scan and one write: the table is partitioned by
``_rejected``, and :func:`accepted` and :func:`rejected` read one partition
each. A record is one line (as with the CSV reader's default); null values
that are null tokens, or empty, are no failed casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import cast_expressions, null_if_token
from ..sinks.tables import write_table

REJECTED = "_rejected"
SHORT, LONG, QUOTE, CAST = "too few fields", "too many fields", "unclosed quote", "not typed: "


def parse_lines(lines: DataFrame, columns, types: dict, null_tokens: dict | None = None, formats: dict | None = None,
                sep: str = ",", line: str = "value", kept=()) -> DataFrame:
    """Typed ``columns``, ``_line`` and ``_reasons`` (null and empty for good rows) and the columns ``kept`` of ``lines``.

    ``types``, ``null_tokens`` and ``formats`` as in
    :func:`~layerkit.functions.casts.cast_columns`; other columns stay text.
    Of a rejected line all typed columns are null. Empty lines and lines
    that repeat the header are left out.
    """
    columns, null_tokens = list(columns), null_tokens or {}
    if len(sep) != 1 or sep == '"':
        raise ValueError("the separator is one character, not a quote")
    raw = F.col(line)
    fields = ", ".join(f"`{c}` string" for c in columns)
    outside = F.regexp_replace(raw, '"(?:[^"]|"")*"', "")
    count = F.length(outside) - F.length(F.translate(outside, sep, "")) + 1
    quotes = F.length(raw) - F.length(F.translate(raw, '"', ""))
    rows = lines.filter(F.length(F.trim(raw)) > 0).select(*kept, raw.alias("_line"), count.alias("__fields"), (quotes % 2 == 1).alias("__open"),
                                                          F.from_csv(raw, fields, {"sep": sep, "escape": '"', "mode": "PERMISSIVE"}).alias("__row"))
    is_header = F.lit(True)
    for c in columns:
        is_header = is_header & F.col("__row").getField(c).eqNullSafe(F.lit(c))
    rows = rows.filter(~is_header).select("*", *[F.col("__row").getField(c).alias(c) for c in columns]).drop("__row")
    typed = cast_expressions(types, null_tokens, formats)
    failed = [F.when(null_if_token(c, null_tokens.get(c, ())).isNotNull() & e.isNull(), F.lit(CAST + c)) for c, e in typed.items()]
    shape = [F.when(F.col("__open"), F.lit(QUOTE)), F.when(~F.col("__open") & (F.col("__fields") < len(columns)), F.lit(SHORT)),
             F.when(~F.col("__open") & (F.col("__fields") > len(columns)), F.lit(LONG))]
    # a misshapen line has its values in the wrong columns: only the shape is told
    reasons = F.filter(F.array(*shape), lambda x: x.isNotNull())
    if failed:
        reasons = F.when(F.size(reasons) > 0, reasons).otherwise(F.filter(F.array(*failed), lambda x: x.isNotNull()))
    rows = rows.withColumn("_reasons", reasons)
    good = F.size("_reasons") == 0
    return rows.select(*[F.when(good, typed.get(c, F.col(c))).alias(c) for c in columns], *kept, F.when(~good, F.col("_line")).alias("_line"), "_reasons")


def ingest_checked(spark: SparkSession, path: str, table: str, types: dict, columns=None, null_tokens: dict | None = None,
                   formats: dict | None = None, sep: str = ",", mode: str = "append") -> dict:
    """Read the CSV files at ``path`` into ``table``; returns counts: rows, rejected, and rejected by reason.

    ``columns`` are those of the header unless given. Adds ``_source_file``
    and ``_ingested_at``.
    """
    if columns is None:
        columns = spark.read.option("header", True).option("sep", sep).csv(path).columns
    # read as it is: no white space trimmed, one line one record
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_source_file"))
    rows = parse_lines(lines, columns, types, null_tokens, formats, sep, kept=("_source_file",))
    rows = rows.withColumns({"_ingested_at": F.current_timestamp(), REJECTED: F.size("_reasons") > 0})
    seen = Observation(f"checked_{table.split('.')[-1]}")
    kinds = [QUOTE, SHORT, LONG, *[CAST + c for c in {**types, **(formats or {})}]]
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(REJECTED), 1)).alias("rejected"),
                        *[F.count(F.when(F.array_contains("_reasons", k), 1)).alias(f"r{i}") for i, k in enumerate(kinds)])
    write_table(rows, table, mode=mode, partition_by=[REJECTED])
    got = seen.get
    return {"rows": got["rows"], "rejected": got["rejected"], "reasons": {k: got[f"r{i}"] for i, k in enumerate(kinds) if got[f"r{i}"]}}


def accepted(spark: SparkSession, table: str) -> DataFrame:
    """The typed rows, with their audit columns."""
    return spark.table(table).filter(~F.col(REJECTED)).drop(REJECTED, "_line", "_reasons")


def rejected(spark: SparkSession, table: str) -> DataFrame:
    """file, line, reasons and time of the records that were not taken."""
    return spark.table(table).filter(F.col(REJECTED)).select("_source_file", "_line", "_reasons", "_ingested_at")
