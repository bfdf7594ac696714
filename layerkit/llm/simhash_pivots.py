"""SimHash near-dedup with pivot distance tables.

Fingerprints: a bit is 1 if over half of the shingles' hashes have it.

Pivot tables: the Hamming distances of every distinct fingerprint to many
reference fingerprints (pivots), kept per block of bits. They serve twice.

* Search. The bits are cut into ``max_bits + 3`` blocks, so two fingerprints
  at most ``max_bits`` apart agree in at least three whole blocks, and so in
  all their pivot distances there. Each choice of three blocks gives one
  key, the distances within them; only fingerprints that share a key meet.
* Discard. The distances over all blocks differ by at most the distance of
  the two fingerprints (triangle inequality). A pair whose largest
  coordinate difference is over ``max_bits`` is dropped unseen; the bits of
  the survivors are compared.

Copies of a fingerprint are one node. A key with more than ``bucket_limit``
distinct fingerprints would give too many pairs; its members are linked
without pairs instead, and as exactly: two fingerprints that agree in the
key's blocks are within ``max_bits`` of each other if and only if one point
of the remaining bits is at most half as far from both. Every member names
the points near itself, and the members that name the same point are linked
to the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import connected_components

HASH_SEED = 42
PIVOTS = 16
#: Shingles hashed at once; bounds memory for texts of any length.
CHUNK = 1 << 18


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, bit 0 first.

    Byte lanes of 64-bit words add up to 255 rows before they are widened.
    """
    total = np.zeros(64, np.int64)
    lanes = np.uint64(0x0101010101010101)
    starts = np.arange(0, len(hashes), 255)
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & lanes, starts)
        total[k::8] += sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    n = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:at + CHUNK + shingle - 1]
        joined = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        counts += _bit_counts(np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(HASH_SEED)), np.uint64))
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])
    return run


def _row_fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc", "fp"])
    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(n: int) -> list[int]:
    """Masks that cut the 64 bits into n runs of nearly equal length."""
    edges = [64 * i // n for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _pivots() -> list[int]:
    return [int(x) for x in np.random.default_rng(7).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)]


def _distance(fp: Column, pivot: int, mask: int = (1 << 64) - 1) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(pivot))).bitwiseAND(F.lit(_signed(mask))))


def _near_points(free: int, radius: int) -> list[tuple[int, int]]:
    """(mask, set bits) for up to ``radius`` of the free bits."""
    bits = [i for i in range(64) if free >> i & 1]
    return [(_signed(sum(1 << i for i in c)), r) for r in range(radius + 1) for c in combinations(bits, r)]


def fingerprint_links(fps: DataFrame, max_bits: int, bucket_limit: int = 64) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) at most ``max_bits`` apart.

    Every link is between two fingerprints that a chain of close ones joins;
    in crowded keys only the links to the smallest of a crowd are given.
    """
    blocks, pivots, fp = _blocks(max_bits + 3), _pivots(), F.col("fp")
    tables = [F.array(*(_distance(fp, p, m) for p in pivots)) for m in blocks]
    choices = list(combinations(range(len(blocks)), 3))
    keys = F.array(*(F.struct(F.lit(i).alias("choice"), F.xxhash64(F.lit(i), *(F.col(f"t{b}") for b in c)).alias("key"))
                     for i, c in enumerate(choices)))
    keyed = (fps.select("fp", *(t.alias(f"t{i}") for i, t in enumerate(tables)))
             .select("fp", F.explode(keys).alias("k")).select("fp", "k.choice", "k.key"))
    crowds = keyed.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    met = stored(keyed.join(crowds, "key"), "shared-pivot-keys")

    few = met.filter(F.col("members") <= bucket_limit).select("key", "fp")
    pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key").filter("a < b")
    largest = F.greatest(*(F.abs(_distance(F.col("a"), p) - _distance(F.col("b"), p)) for p in pivots))
    close = (pairs.filter(largest <= max_bits).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
             .select("a", "b"))

    near, far = max_bits // 2, (max_bits + 1) // 2
    points = F.lit(None)
    for i, c in enumerate(choices):
        free = ((1 << 64) - 1) ^ sum(blocks[b] for b in c)
        listed = F.array(*(F.struct(F.lit(m).alias("flip"), F.lit(r).alias("r")) for m, r in _near_points(free, far)))
        points = F.when(F.col("choice") == i, listed).otherwise(points)
    named = (met.filter(F.col("members") > bucket_limit).select("fp", F.explode(points).alias("p"))
             .select("fp", F.col("fp").bitwiseXOR(F.col("p.flip")).alias("point"), (F.col("p.r") <= near).alias("near")).distinct())
    hubs = (named.groupBy("point").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("b"), F.count("*").alias("n"))
            .filter("n > 1 and b is not null"))
    return close.union(named.join(hubs, "point").filter("fp != b").select(F.col("fp").alias("a"), "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, bucket_limit: int = 64) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and component_id for every row.

    component_id is the smallest doc_id that a chain of links reaches, the
    own one included.

    * A null text counts as empty; without words the fingerprint is zero and
      is linked like any other. Fewer words than a shingle: the whole
      sequence is one shingle.
    * Null ids never win against an id; a component of null ids only has
      component_id null. Repeated rows are nodes like any other.
    * An empty table gives an empty result. Extra columns are ignored,
      whatever their names.
    """
    prints = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                    .mapInArrow(_fingerprints(shingle), "doc_id long, fp long"), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    linked = _fingerprint_roots(nodes, max_bits, bucket_limit)
    ids = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = linked.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def _fingerprint_roots(nodes: DataFrame, max_bits: int, bucket_limit: int) -> DataFrame:
    """``nodes`` (distinct fp and more) with ``root``, one fingerprint for each component."""
    roots = connected_components(fingerprint_links(nodes, max_bits, bucket_limit), "a", "b")
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
                bucket_limit: int = 64) -> DataFrame:
    """(doc_id, digest) of the row that stays of each component: least id (null last), then least SHA-256 of the text.

    A row is told by its id and its text, so that one of several texts under
    one id, or under null ids, is kept or dropped for itself. Rows that
    repeat both are one row here.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    prints = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(text, 256).alias("digest"), F.col(text_col).alias("text"))
                    .select(F.struct("doc_id", "digest").alias("doc"), "text")
                    .mapInArrow(_row_fingerprints(shingle), "doc struct<doc_id: long, digest: string>, fp long"), "row-fingerprints")
    order = F.struct(F.col("doc.doc_id").isNull().alias("last"), "doc.doc_id", "doc.digest")
    nodes = stored(prints.groupBy("fp").agg(F.min(order).alias("first")), "distinct-fingerprints")
    return (_fingerprint_roots(nodes, max_bits, bucket_limit).groupBy("root").agg(F.min("first").alias("first"))
            .select("first.doc_id", "first.digest"))
