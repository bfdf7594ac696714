"""Exact dedup by exchanging Golomb-coded fingerprints.

1. Each input block (a run of rows of one scan task) sorts the fingerprints
   of its texts and sends every owner - one range of the fingerprint space -
   the distinct ones it holds there, as Golomb-Rice coded gaps.
2. An owner decodes the lists of all blocks and answers each with a bitmap
   of the fingerprints that another block holds too.
3. The block applies the bitmaps: rows without a mark are unique and travel
   no further. Only the suspects' texts are shuffled, and equal texts are
   found by comparing the bytes, so a fingerprint that two texts share by
   chance costs a little traffic and never a row.

A block sends a fingerprint once however many copies it holds, and the byte
comparison is a grouped aggregate that combines copies before the shuffle,
so a text with a third of all rows is no hot spot. An owner's memory is the
fingerprints of its range; ``owners`` must grow with the input (it follows
the session's shuffle partitions).

The suspects' texts are picked in a second scan by a filter of fixed size
(``filter_bits``, broadcast): a Bloom filter with one hash of the suspects'
fingerprints. What it lets through too much goes through the byte
comparison like the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_count, stored, text_of

BLOCK_SCHEMA = "block long, ids array<long>, digests binary, codes array<struct<owner:int,code:binary>>"
MARK_SCHEMA = "doc_id long, text_sha256 string, suspect boolean"


def rice_encode(values: np.ndarray) -> bytes:
    """Golomb-Rice code of a strictly increasing uint64 array.

    Layout: count and first value (8 bytes each), parameter k (1 byte), the
    quotients of the gaps in unary, then their k low bits.
    """
    n = len(values)
    head = np.array([n, values[0] if n else 0], "<u8").tobytes()
    gaps = np.diff(values).astype(np.uint64) - np.uint64(1) if n > 1 else np.empty(0, np.uint64)
    mean = float(gaps.astype(np.float64).mean()) if len(gaps) else 0.0
    k = max(0, int(np.log2(mean * np.log(2)))) if mean * np.log(2) >= 1 else 0
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    low = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return head + bytes([k]) + np.packbits(unary).tobytes() + np.packbits(low.ravel()).tobytes()


def rice_decode(code: bytes) -> np.ndarray:
    n, first = (int(x) for x in np.frombuffer(code, "<u8", 2))
    if n == 0:
        return np.empty(0, np.uint64)
    k, body = code[16], np.frombuffer(code, np.uint8, offset=17)
    gaps = np.zeros(n - 1, np.uint64)
    if n > 1:
        # the unary part ends in the byte with the (n - 1)th set bit
        ones = np.cumsum(np.bitwise_count(body).astype(np.int64))
        size = int(np.searchsorted(ones, n - 1)) + 1
        bits = np.unpackbits(body[:size])
        ends = np.flatnonzero(bits)[: n - 1]
        size = (int(ends[-1]) + 8) // 8
        quotient = np.diff(ends, prepend=-1) - 1
        low = np.unpackbits(body[size:], count=(n - 1) * k).reshape(n - 1, k).astype(np.uint64)
        gaps = (quotient.astype(np.uint64) << np.uint64(k)) | (low << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.uint64(first) + np.concatenate([[np.uint64(0)], np.cumsum(gaps + np.uint64(1), dtype=np.uint64)])


def _fingerprints(digests: np.ndarray, bits: int) -> np.ndarray:
    """The leading ``bits`` of each digest (rows of 32 bytes)."""
    return np.ascontiguousarray(digests[:, :8]).view(">u8").ravel().astype(np.uint64) >> np.uint64(64 - bits)


def _cuts(values: np.ndarray, owners: int, bits: int) -> np.ndarray:
    """Where each owner's range begins in the sorted fingerprints."""
    edges = np.array([(o << bits) // owners for o in range(1, owners)], np.uint64)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]]).astype(np.int64)


def _encode(owners: int, bits: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, ids, digests, held = TaskContext.get().partitionId(), 0, [], [], 0

        def block() -> pa.RecordBatch:
            all_ids = pa.concat_arrays(ids)
            d = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
            fp = _fingerprints(d, bits)
            order = np.argsort(fp, kind="stable")
            distinct = np.unique(fp)
            cut = _cuts(distinct, owners, bits)
            codes = [{"owner": o, "code": rice_encode(distinct[cut[o]:cut[o + 1]])}
                     for o in np.flatnonzero(np.diff(cut)).tolist()]
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 32) | seq], pa.int64()),
                "ids": pa.array([all_ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
                "digests": pa.array([d[order].tobytes()], pa.binary()),
                "codes": pa.array([codes], pa.list_(pa.struct([("owner", pa.int32()), ("code", pa.binary())])))})

        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                piece = batch.slice(at, block_rows)
                ids.append(piece.column(0))
                digests.append(b"".join(piece.column(1).to_pylist()))
                held += piece.num_rows
                if held >= block_rows:
                    yield block()
                    seq, ids, digests, held = seq + 1, [], [], 0
        if held:
            yield block()
    return run


def _owner_answers(pdf):
    """Bitmaps of one owner: which of a block's fingerprints another block sent too."""
    import pandas as pd

    lists = [rice_decode(c) for c in pdf["code"]]
    size = np.array([len(x) for x in lists])
    values = np.concatenate(lists)
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    marked = np.zeros(len(values), bool)
    marked[order[1:][same]] = True
    marked[order[:-1][same]] = True
    ends = np.cumsum(size)
    flags = [marked[e - n:e] for e, n in zip(ends, size)]
    keep = [i for i, f in enumerate(flags) if f.any()]
    return pd.DataFrame({"block": pdf["block"].iloc[keep], "owner": pdf["owner"].iloc[keep],
                         "bitmap": [np.packbits(flags[i]).tobytes() for i in keep]})


def _apply(owners: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = row.column("ids")[0].values
                raw = row.column("digests")[0].as_py()
                d = np.frombuffer(raw, np.uint8).reshape(-1, 32)
                distinct, where, count = np.unique(_fingerprints(d, bits), return_inverse=True, return_counts=True)
                marked = count > 1
                cut = _cuts(distinct, owners, bits)
                for a in row.column("answers")[0].as_py() or []:
                    lo, hi = cut[a["owner"]], cut[a["owner"] + 1]
                    marked[lo:hi] |= np.unpackbits(np.frombuffer(a["bitmap"], np.uint8), count=hi - lo).astype(bool)
                text = raw.hex()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids, "text_sha256": pa.array([text[j:j + 64] for j in range(0, len(text), 64)], pa.string()),
                    "suspect": pa.array(marked[where])})
    return run


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owners: int | None = None,
                     fingerprint_bits: int = 48, block_rows: int = 65536, filter_bits: int = 24) -> DataFrame:
    """Class of equal texts for every row of ``docs``.

    Returns doc_id, keep_id (largest doc_id with this text), group_size,
    kept and text_sha256; one row per input row.

    * A null text counts as empty. Empty texts are equal to each other.
    * A null id never wins against an id; a text that only null ids carry
      has keep_id null and its rows are kept.
    * Rows that repeat both id and text are one document: all count in
      group_size and all carry the same decision.
    * An empty table gives an empty result. Extra columns are ignored,
      whatever their names.
    """
    spark = docs.sparkSession
    owners = owners or shuffle_count(spark)
    bits = fingerprint_bits
    text = text_of(text_col)
    hashed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))
    blocks = stored(hashed.mapInArrow(_encode(owners, bits, block_rows), BLOCK_SCHEMA), "fingerprint-blocks")

    sent = blocks.select("block", F.explode("codes").alias("c")).select("block", "c.owner", "c.code")
    answers = sent.groupBy("owner").applyInPandas(_owner_answers, "block long, owner int, bitmap binary")
    # at most one answer per owner in a list
    per_block = answers.groupBy("block").agg(F.collect_list(F.struct("owner", "bitmap")).alias("answers"))
    marks = stored(blocks.drop("codes").join(per_block, "block", "left").mapInArrow(_apply(owners, bits), MARK_SCHEMA),
                   "suspect-marks")

    def slot(sha):
        return F.conv(F.substring(sha, 1, 12), 16, 10).cast("long").bitwiseAND(F.lit((1 << filter_bits) - 1))

    bit = F.lit(1).cast("long")
    passes = (marks.filter("suspect").select(slot(F.col("text_sha256")).alias("s"))
              .groupBy(F.shiftright("s", 6).alias("word"))
              .agg(F.bit_or(F.call_function("shiftleft", bit, F.col("s").bitwiseAND(63).cast("int"))).alias("bits")))
    # at most 2**filter_bits / 64 rows
    suspects = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("sha"))
                .withColumn("s", slot(F.col("sha"))).withColumn("word", F.shiftright("s", 6))
                .join(F.broadcast(passes), "word")
                .filter(F.call_function("shiftrightunsigned", F.col("bits"), F.col("s").bitwiseAND(63).cast("int"))
                        .bitwiseAND(bit) == 1))
    # equal bytes: the group key is the text itself
    classes = stored(suspects.groupBy("sha", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                     .filter("group_size > 1").groupBy("sha")
                     .agg(F.when(F.count("*") == 1, F.max("keep_id")).otherwise(
                             F.raise_error(F.lit("two texts with one SHA-256"))).alias("keep_id"),
                          F.max("group_size").alias("group_size")), "text-classes")
    found = marks.join(classes, marks["text_sha256"] == classes["sha"], "left")
    return found.select(
        "doc_id", F.when(F.col("sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("sha").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")
