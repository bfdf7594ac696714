"""Compaction of small files (K3): only they are rewritten, the others stay.

Appends leave many small files in a partition. :func:`compact` lists the
table's files by a scan of their metadata, packs the small ones of each
partition into bins by size, and writes each bin as one file. The rows of
the small files are shuffled once, by bin; files that are large enough, or
alone in their bin, are neither read nor renamed.

A round rewrites about ``round_files`` files. Its new files are written to a
hidden folder in the table's own, then a manifest names the files they
replace, then the new ones are moved in and the old ones deleted. If a round
is cut off before its manifest, nothing has happened to the table; after it,
:func:`recover_compaction` (which :func:`compact` calls first) finishes it.
Between the moves a reader may see rows twice, never miss any. One writer
per table at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

STAGING, MANIFEST = "_compaction", "_replaced"


@dataclass
class Compacted:
    """Files that were replaced, files written for them, rounds taken."""

    replaced: int = 0
    written: int = 0
    rounds: int = 0


def _about(spark: SparkSession, table: str) -> tuple[str, str, list[str]]:
    """Folder, format and partition columns; raises for tables whose files cannot be merged."""
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = spark.catalog.listColumns(table)
    if any(c.isBucket for c in columns):
        raise ValueError(f"{table} is bucketed: its files stand for buckets and are not merged")
    if about.get("Provider", "").lower() not in ("parquet", "orc"):
        raise ValueError(f"{table}: files of {about.get('Provider')} are not merged")
    return about["Location"].rstrip("/"), about["Provider"].lower(), [c.name for c in columns if c.isPartition]


def table_files(spark: SparkSession, table: str) -> DataFrame:
    """path, url (as ``_metadata.file_path`` has it), folder and size of the table's files; contents are not read."""
    home = _about(spark, table)[0]
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(home)
    return found.select("path", F.col("_metadata.file_path").alias("url"), F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
                        F.col("length").alias("size"))


def packed(files: DataFrame, target_bytes: int, small_bytes: int, bin_files: int) -> DataFrame:
    """The small files that share a bin with another, with ``bin`` (within the folder).

    Files are laid end to end by falling size and cut at multiples of the
    target, so a bin holds at most target + small bytes, and at most
    ``bin_files`` files.
    """
    order = Window.partitionBy("folder").orderBy(F.desc("size"), "path")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start, number = F.sum("size").over(whole) - F.col("size"), F.row_number().over(order) - 1
    bins = (files.filter(F.col("size") < small_bytes)
            .withColumn("bin", F.struct(F.floor(start / target_bytes).alias("by_size"), F.floor(number / bin_files).alias("by_count"))))
    several = bins.groupBy("folder", "bin").agg(F.count("*").alias("files")).filter("files > 1")
    return bins.join(several, ["folder", "bin"])


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _data_files(fs, folder) -> list:
    found, files = fs.listFiles(folder, True), []
    while found.hasNext():
        path = found.next().getPath()
        if not path.getName().startswith(("_", ".")):
            files.append(path)
    return files


def _read_manifest(spark: SparkSession, staged: str) -> list[str]:
    fs, manifest = _fs(spark, f"{staged}/{MANIFEST}")
    stream = fs.open(manifest)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_manifest(spark: SparkSession, staged: str, old: list[str]) -> None:
    """The manifest is there whole or not at all."""
    fs, manifest = _fs(spark, f"{staged}/{MANIFEST}")
    half = spark._jvm.org.apache.hadoop.fs.Path(f"{staged}/{MANIFEST}.part")
    out = fs.create(half, True)
    try:
        out.write(bytearray(json.dumps(old).encode()))
    finally:
        out.close()
    if not fs.rename(half, manifest):
        raise OSError(f"{manifest.toString()} could not be written")


def _finish(spark: SparkSession, home: str, staged: str) -> int:
    """Move the new files in, delete those the manifest names; repeating it does no harm."""
    fs, root = _fs(spark, staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    old = _read_manifest(spark, staged)
    prefix, new = root.toUri().getPath().rstrip("/"), _data_files(fs, root)
    for f in new:
        there = path(home + f.toUri().getPath()[len(prefix):])
        if not (fs.rename(f, there) or fs.exists(there)):
            raise OSError(f"{f.toString()} could not be moved to {there.toString()}")
    for name in old:
        fs.delete(path(name), False)
    fs.delete(root, True)
    return len(new)


def recover_compaction(spark: SparkSession, table: str) -> int:
    """Finish rounds that were cut off after their manifest, drop those before it; returns rounds finished."""
    home = _about(spark, table)[0]
    fs, root = _fs(spark, f"{home}/{STAGING}")
    done = 0
    for status in fs.listStatus(root) if fs.exists(root) else []:
        staged = status.getPath().toString()
        if fs.exists(_fs(spark, f"{staged}/{MANIFEST}")[1]):
            _finish(spark, home, staged)
            done += 1
        else:
            fs.delete(status.getPath(), True)
    if done:
        spark.catalog.refreshTable(table)
    return done


def _stage(spark: SparkSession, table: str, files: list, home: str, fmt: str, partition_by: list[str]) -> str:
    """Write the round's bins as a file each, then the manifest; returns the staged folder."""
    numbers = {b: i for i, b in enumerate(sorted({(f["folder"], tuple(f["bin"])) for f in files}))}
    places = spark.createDataFrame([(f["url"], numbers[f["folder"], tuple(f["bin"])]) for f in files], "_url string, _bin int")
    read = spark.read.schema(spark.table(table).schema).option("basePath", home).format(fmt).load([f["path"] for f in files])
    names = read.columns
    # a round's list of files is bounded by round_files
    rows = (read.select("*", F.col("_metadata.file_path").alias("_url")).join(F.broadcast(places), "_url")
            .repartitionById(len(numbers), F.col("_bin")).select(*names))
    staged = f"{home}/{STAGING}/{uuid.uuid4().hex}"
    writer = rows.write.format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(staged)
    _write_manifest(spark, staged, [f["path"] for f in files])
    return staged


def compact(spark: SparkSession, table: str, target_bytes: int = 256 << 20, small_bytes: int | None = None,
            round_files: int = 50_000) -> Compacted:
    """Merge files under ``small_bytes`` (default: three quarters of the target) into files of about ``target_bytes``.

    Works on managed and external parquet or ORC tables, partitioned or not;
    bucketed tables are refused. Partitions outside the table's folder are
    left alone. Rows, types and partitions stay as they are, only the order
    of the rows that move is not kept. ``round_files`` is about the number
    of files a round takes (and the driver holds); all rounds are done.
    """
    home, fmt, partition_by = _about(spark, table)
    recover_compaction(spark, table)
    small = target_bytes * 3 // 4 if small_bytes is None else small_bytes
    bin_files = max(16, round_files // 10)
    at = scratch_path(spark, "compaction-plan")
    packed(table_files(spark, table), target_bytes, small, bin_files).write.parquet(at)
    plan = spark.read.parquet(at)
    total = plan.count()
    result = Compacted()
    rounds = -(-total // round_files)
    for n in range(rounds):
        files = plan.filter(F.pmod(F.xxhash64("folder", "bin"), F.lit(rounds)) == n).collect()
        if files:
            result.written += _finish(spark, home, _stage(spark, table, files, home, fmt, partition_by))
            result.replaced += len(files)
            result.rounds += 1
    if total:
        spark.catalog.refreshTable(table)
    return result
