"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step replaces edges by edges to smaller nodes of the same component until each component is a star
around its smallest node. Nothing is collected: the driver sees one count and one checksum a round.
A node with very many edges is only ever grouped by a minimum, which is pre-aggregated, and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.store import Store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame, store: Store) -> DataFrame:
    """(node, component) of every node that is not the smallest of its component; edges are (a, b)."""
    now = store.cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        seen = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)), F.coalesce(F.sum(F.col("b") % 1000003), F.lit(0))).first()
        if tuple(seen) == before or seen[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = tuple(seen)
        after = store.cut(_small_star(_large_star(now).distinct()).distinct())
        store.drop(now)
        now = after
