"""Connected components of a link table, as grouped minima and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("child", "parent"))).first())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for all linked nodes.

    Alternates two steps until the links form stars: every node passes its
    larger neighbours on to its smallest neighbour, then its smaller ones.
    The rounds grow with the logarithm of the number of nodes. A round is
    two grouped minima and two joins; each is stored in the shared folder,
    so a lost executor repeats at most one round.

    Links of a node with itself or with null are ignored; repeated links and
    either direction are fine.
    """
    edges = stored(links.select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent"))
                   .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("child") > F.col("parent"))).distinct(), "links")
    before = None
    while (now := _signature(edges)) != before and now[0]:
        before = now
        both = edges.select(F.col("child").alias("u"), F.col("parent").alias("v")).union(
            edges.select(F.col("parent").alias("u"), F.col("child").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").filter("v != m")
                 .select(F.col("v").alias("child"), F.col("m").alias("parent")).distinct())
        least = large.groupBy("child").agg(F.min("parent").alias("m"))
        small = (large.join(least, "child").filter("parent != m")
                 .select(F.col("parent").alias("child"), F.col("m").alias("parent"))
                 .union(least.select("child", F.col("m").alias("parent"))).distinct())
        edges = stored(small, "links")
    return edges.select(F.col("child").alias("node"), F.col("parent").alias("root")).union(
        edges.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct())
