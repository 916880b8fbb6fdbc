"""Connected components of an edge table, by alternating star contractions.

Per round, every node hands its larger neighbours its smallest neighbour, then every node hands its smaller neighbours
their minimum. Rounds grow with the logarithm of the components' size; a round is joins and minima on nodes, its edges go to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of the edges (a, b; 64-bit integers) with the smallest node it reaches. Loops and repeated edges don't matter; nulls are left out."""
    tidy = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = staged(tidy)
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Minima are staged: a join of two plain shuffles is one that a hot node's rows can be split in.
        least = staged(both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.min("a")).alias("m")))
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct())
        low = staged(large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")))
        small = large.join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = staged(small.unionByName(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct())
        new = _mark(now)
        if new == mark:
            break
        mark = new
    # Stars now: every node but the smallest points at the smallest.
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
