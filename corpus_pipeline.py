"""A training-corpus pipeline from five of the corpus operators.

Quality classifier, exact dedup, SimHash near-dedup, mixing to target
weights, packing. Each stage works on all that its predecessor kept; all but
the last return the columns of documents.

A row is told by its id and its text: under one id, or under null ids,
several texts are several documents, and each is kept or dropped for itself.
Of rows that repeat both, the dedup stages leave one. What a stage needs of
its own stands beside the row, never among its columns, so extra columns may
have any names. Texts travel only where a stage needs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm import golomb_dedup, queries, simhash_pivots
from layerkit.llm.common import read_table, scratch_uri, text_of

#: SQL has no model fitting, fingerprint or tokenizer: tests compare with brute force.
ORACLE_SQL = None


def _row(docs: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def _with_key(docs: DataFrame) -> DataFrame:
    """row, doc_id and digest (SHA-256 of the text)."""
    return docs.select(_row(docs), F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text_of("text"), 256).alias("digest"))


def _join(keyed: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = keys.select(F.col("doc_id").alias("other_id"), F.col("digest").alias("other_digest"))
    return keyed.join(keys, (F.col("digest") == F.col("other_digest")) & F.col("doc_id").eqNullSafe(F.col("other_id")), how)


def _keep(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows of ``keyed``, one for each key that ``repeated`` lists."""
    once = _join(keyed, repeated, "left_anti").select("row")
    # combined in the task before the shuffle, so that a row with very many repeats is no hot spot
    one = _join(keyed, repeated, "left_semi").groupBy("doc_id", "digest").agg(F.min("row").alias("row")).select("row")
    return once.unionAll(one).select("row.*")


def _repeated(keys: DataFrame) -> DataFrame:
    return keys.groupBy("doc_id", "digest").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", "digest")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose probability of the highest grade is at least one half."""
    rows = docs.select(_row(docs), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    rated = queries.rate_documents(rows, sf_dir)
    return rated.filter(F.col("top_probability") >= queries.TOP_AT_LEAST).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    found = golomb_dedup.exact_duplicates(docs).select("doc_id", F.col("text_sha256").alias("digest"), "kept", "group_size").filter("group_size > 1")
    dropped = found.filter("not kept").select("doc_id", "digest").distinct()
    keyed = _with_key(docs)
    return _keep(_join(keyed, dropped, "left_anti"), _repeated(found.filter("kept")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of fingerprints linked at 2 or fewer bits (3-word shingles) the row with the smallest doc_id stays."""
    stays = simhash_pivots.one_of_each(docs, shingle=3, max_bits=2)
    keyed = _with_key(docs)
    return _keep(_join(keyed, stays, "left_semi"), _repeated(keyed.select("doc_id", "digest")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as the sample by calibrated rates holds it, scarce cells more than once."""
    return queries.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the packed sequences."""
    return queries.pack_documents(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact_dedup), ("SimHash near-dedup", near_dedup),
          ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's input is removed from the shared folder once its output is there."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path, out = scratch_uri(spark, name.replace(" ", "-")), stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            folder = spark._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
