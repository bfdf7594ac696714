"""Raw ingestion that takes each file once.

A plain append takes a file again with every run. Here a ledger knows the
files (path, size, time of change) that are in the table; only others are
read. A file that was replaced under its name is another one: its rows take
the place of those it had before.

The table is partitioned by file (``_file_id``), and a run overwrites just
the partitions of the files it reads, before it writes the ledger. A run
that fails half-way, or between the two, leaves files that the ledger does
not know; the next run reads them again and overwrites the same partitions.
So no row is there twice and none is missing, whatever was cut off. Files
that are gone from the source keep their rows.

Listing is a Spark scan of the files' metadata; their names come to the
driver, as they do for any scan. Landing files should be large (some 100 MB
and more), as each makes a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import normalise
from ..sinks.tables import drop_partitions, replace_partitions, write_table

FILE_ID = "_file_id"


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """path, size and modified of the files that ``pattern`` names; contents are not read."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def new_files(spark: SparkSession, pattern: str, ledger: str) -> DataFrame:
    """The files that the ledger does not know as they are now."""
    found = list_files(spark, pattern)
    if not spark.catalog.tableExists(ledger):
        return found
    return found.join(spark.table(ledger).select("path", "size", "modified").distinct(), ["path", "size", "modified"], "left_anti")


def ingest_new_files(spark: SparkSession, pattern: str, target: str, ledger: str, lower: bool = False, **csv_options) -> DataFrame:
    """Read the CSV files not taken yet into ``target``: all columns text, and where each row came from.

    Adds ``_source_file``, ``_ingested_at`` and the partition ``_file_id``.
    All files must have the same header; one that differs fails the run
    before anything is written. Returns the ledger's rows of this run (path,
    size, modified, row_count, ingested_at, _file_id).
    """
    files = new_files(spark, pattern, ledger).withColumn(FILE_ID, F.md5("path")).collect()
    schema = "path string, size long, modified timestamp, row_count long, ingested_at timestamp, _file_id string"
    if not files:
        return spark.createDataFrame([], schema)
    paths = sorted(f["path"] for f in files)
    reader = spark.read.option("header", True).option("enforceSchema", False)
    for k, v in csv_options.items():
        reader = reader.option(k, v)
    header = reader.csv(paths[0]).schema
    now = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    rows = reader.schema(header).csv(paths).select("*", F.col("_metadata.file_path").alias("__path"))
    if lower:
        rows = normalise(rows)
    # the listing writes file:/x where the reader writes file:///x
    plain = F.regexp_replace("__path", "^file:/+", "file:/")
    rows = rows.select("*", F.url_decode(F.regexp_replace(plain, "[+]", "%2B")).alias("_source_file")).drop("__path")
    ids = spark.createDataFrame([(f["path"], f[FILE_ID]) for f in files], f"listed string, {FILE_ID} string")
    rows = (rows.join(ids, rows["_source_file"] == ids["listed"], "left").drop("listed")
            .withColumns({"_ingested_at": F.lit(now), FILE_ID: F.coalesce(F.col(FILE_ID), F.raise_error(F.lit("a row of a file that was not listed")))}))
    rows = rows.select(*[c for c in rows.columns if c != FILE_ID], FILE_ID)
    if not spark.catalog.tableExists(target):
        write_table(rows, target, mode="overwrite", partition_by=[FILE_ID])
    else:
        replace_partitions(rows.select(*spark.table(target).columns), target, [FILE_ID])
    taken = {f[FILE_ID] for f in files}
    counts = {r[FILE_ID]: r["count"] for r in spark.table(target).filter(F.col(FILE_ID).isin(sorted(taken))).groupBy(FILE_ID).count().collect()
              if r[FILE_ID] in taken}
    # a replaced file without rows any more: its partition was not in what was written
    stale = {r[0] for r in spark.table(target).filter(F.col(FILE_ID).isin(sorted(taken)) & (F.col("_ingested_at") != F.lit(now)))
             .select(FILE_ID).distinct().collect()}
    drop_partitions(spark, target, [{FILE_ID: i} for i in stale])
    done = spark.createDataFrame([(f["path"], f["size"], f["modified"], 0 if f[FILE_ID] in stale else counts.get(f[FILE_ID], 0), now, f[FILE_ID])
                                  for f in files], schema)
    write_table(done, ledger, mode="append")
    return done
