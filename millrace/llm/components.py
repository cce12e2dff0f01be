"""Distributed union-find: the smallest node of each connected component, by alternating stars.

The large star of a node sends its larger neighbours to the smallest one, the small star its smaller ones and itself. Both
keep components and end in stars whose centres are the smallest nodes, after a number of rounds that grows with the
logarithm of the longest path. Each round is written to the shared folder. A node with many neighbours is met by a sum with
partial minima and a join that can be split, never by collecting them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _print_of(edges: DataFrame) -> tuple:
    """Count and checksum of a set of edges; they tell whether a round has changed anything."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that isn't the smallest of its component; edges with a null end or equal ends are ignored."""
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    now = stored(now.distinct(), "edges")
    before = _print_of(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u != v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small_least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(moved.unionByName(small_least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _print_of(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
