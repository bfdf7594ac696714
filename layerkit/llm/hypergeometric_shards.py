"""Uniform shuffle into shards of exact size, from a hypergeometric count matrix.

1. Rows are dealt into a fixed number of blocks by a hash and counted: at
   most ``blocks`` counts come to the driver.
2. The driver draws how many rows of each block go to each shard, as a
   uniform permutation of all rows would deal them: a multivariate
   hypergeometric matrix whose rows add up to the block counts and whose
   columns add up to the shard sizes. It has ``blocks * shards`` numbers,
   whatever the input.
3. Each block orders its rows at random, and the matrix row cuts that order
   into the shards' shares.
4. Each shard orders its rows at random again. The order is counted within
   slices of the second random number and shifted by the slices before, so
   no task holds a shard.

All row work is DataFrame expressions and windows. The random numbers are
hashes of the row and the seed, so a repeated task deals the same rows the
same way.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


def draw_hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good + bad`` are good: inversion outward from the mode.

    The weights are products of exact neighbour ratios, so there is no
    limit on the size; they end where they no longer change the sum.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    values, weights = [mode], [1.0]
    for step, end in ((1, high), (-1, low)):
        x, w = mode, 1.0
        while x != end and w > 1e-18:
            if step > 0:
                w *= (good - x) * (draws - x) / ((x + 1) * (bad - draws + x + 1))
            else:
                w *= x * (bad - draws + x) / ((good - x + 1) * (draws - x + 1))
            x += step
            values.append(x)
            weights.append(w)
    return rng.choices(values, weights)[0]


def communication_matrix(counts: dict[int, int], sizes: list[int], seed: int) -> list[tuple[int, int, int, int]]:
    """(block, shard, first rank, end rank) for every block and shard that share rows."""
    rng, left, total = random.Random(seed), list(sizes), sum(sizes)
    out = []
    for block in sorted(counts):
        need, rest, at = counts[block], total, 0
        for shard in range(len(sizes)):
            n = draw_hypergeometric(rng, left[shard], rest - left[shard], need)
            rest -= left[shard]
            if n:
                out.append((block, shard, at, at + n))
            at, need = at + n, need - n
            left[shard] -= n
        total -= counts[block]
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _spread(df: DataFrame, names: list[str], seed: int) -> Column:
    """A hash of all of a row's columns that can be hashed."""
    ok = [F.col(f"`{c}`") for c in names if "map<" not in df.schema[c].dataType.simpleString()
          and "variant" not in df.schema[c].dataType.simpleString()]
    return F.xxhash64(F.lit(seed), *ok)


def shuffle_into_shards(rows: DataFrame, shards: int, blocks: int = 1024, slices: int = 64, seed: int = 20240601) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (place in the shard, gapless from 0).

    Shard sizes differ by at most one row. Every assignment of rows to
    places is equally likely over seeds, but for rows that are equal in
    every column: they share their random numbers and lie in one block
    (they can be told apart by adding a column).

    All columns are kept; ones named shard or slot are replaced. Names that
    begin with ``deal_`` are used inside. Columns may be null. Fewer rows
    than shards leave the last shards empty; no rows give an empty result.
    """
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    first, second = _spread(rows, kept, seed), _spread(rows, kept, seed + 1)
    dealt = stored(rows.select(*(F.col(f"`{c}`") for c in kept), F.pmod(first, F.lit(blocks)).cast("int").alias("deal_block"),
                               F.xxhash64(F.lit(seed), first).alias("deal_key"), second.alias("deal_next")), "dealt-rows")
    counts = {r[0]: r[1] for r in dealt.groupBy("deal_block").count().collect()}  # at most ``blocks``
    matrix = communication_matrix(counts, shard_sizes(sum(counts.values()), shards), seed)
    cuts = spark.createDataFrame(matrix, "deal_from_block int, shard int, deal_from long, deal_to long")
    in_block = Window.partitionBy("deal_block").orderBy("deal_key", "deal_next")
    sent = (dealt.withColumn("deal_rank", F.row_number().over(in_block) - 1)
            .join(F.broadcast(cuts), (F.col("deal_block") == F.col("deal_from_block"))
                  & (F.col("deal_rank") >= F.col("deal_from")) & (F.col("deal_rank") < F.col("deal_to")))
            .withColumn("deal_slice", F.pmod(F.shiftright("deal_next", 20), F.lit(slices)).cast("int")))
    sent = stored(sent.select(*(F.col(f"`{c}`") for c in kept), "shard", "deal_slice", "deal_next", "deal_key"), "sent-rows")
    before = Window.partitionBy("deal_shard").orderBy("deal_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (sent.groupBy(F.col("shard").alias("deal_shard"), F.col("deal_slice").alias("deal_part")).agg(F.count("*").alias("deal_n"))
              .select("deal_shard", "deal_part", F.coalesce(F.sum("deal_n").over(before), F.lit(0)).alias("deal_shift")))
    in_slice = Window.partitionBy("shard", "deal_slice").orderBy("deal_next", "deal_key")
    # shards * slices rows are broadcast
    return (sent.withColumn("deal_rank", F.row_number().over(in_slice) - 1)
            .join(F.broadcast(shifts), (F.col("shard") == F.col("deal_shard")) & (F.col("deal_slice") == F.col("deal_part")))
            .select(*(F.col(f"`{c}`") for c in kept), "shard", (F.col("deal_rank") + F.col("deal_shift")).cast("long").alias("slot")))

