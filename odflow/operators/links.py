"""Best predecessor and numbers of links per trip, without writing any pair.

Trip a may precede trip b when a ends where b starts and ``0 < start(b) - end(a) <= gap``. So what b needs is a fold (largest,
sum) over the ends in its zone within a window of exactly ``gap`` seconds. Time is cut into blocks of ``gap`` seconds: such a
window is the tail of one block and the head of the next, so a running fold from either end of each block answers it.

Ends and starts are aggregated to one row per (zone, second) before, so a window partition (one zone, one block) holds at most three
rows per second of a gap, however many trips there are and however hot a zone is. Everything is built-in functions; the shuffle is
linear in the trips.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.operators.chain import DEFAULT_GAP_S


def _window_fold(points: DataFrame, queries: DataFrame, gap: int, fold: Callable) -> DataFrame:
    """(zone, at, x): the fold of ``points`` (zone, t, x; one row per zone and second) over ``at - gap < t <= at`` for each different
    (zone, at) of ``queries``; null without points."""
    def block(t: Column) -> Column:
        return F.floor(t / gap)

    at = F.col("at")
    first = at - gap + 1
    tail = F.struct(block(first).alias("block"), first.alias("t"), F.lit(True).alias("tail"))
    head = F.struct(block(at).alias("block"), at.alias("t"), F.lit(False).alias("tail"))
    # A window that is a whole block is its tail alone.
    asked = queries.distinct().select("zone", "at", F.explode(F.when(block(first) == block(at), F.array(tail)).otherwise(F.array(tail, head))).alias("q"))
    asked = asked.select("zone", "q.block", "q.t", "at", "q.tail")
    rows = points.select("zone", block(F.col("t")).alias("block"), "t", "x").unionByName(asked, allowMissingColumns=True)
    # Both folds run: a frame that ends at unboundedFollowing would be folded anew for every row, in quadratic time.
    own = Window.partitionBy("zone", "block")
    so_far = fold("x").over(own.orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    from_here = fold("x").over(own.orderBy(F.col("t").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    part = rows.select("zone", "at", F.when(F.col("tail"), from_here).otherwise(so_far).alias("x")).where("at is not null")
    return part.groupBy("zone", "at").agg(fold("x").alias("x"))


def best_predecessor(trips: DataFrame, gap: int = DEFAULT_GAP_S, value: str = "value") -> DataFrame:
    """(id, prev_id, prev_value) of every trip: the predecessor with the largest value, then the earliest start, then the smallest id.

    ``trips`` has (id, origin, dest, p, d) as ``chain.prepare_trips`` makes them, and the value column. Trips without a predecessor get
    nulls; a predecessor with a null value only counts where there is no other.
    """
    best = F.max(F.struct(F.col(value).alias("value"), (-F.col("p")).alias("p"), (-F.col("id")).alias("id"))).alias("x")
    ends = trips.groupBy(F.col("dest").alias("zone"), F.col("d").alias("t")).agg(best)
    asks = trips.select(F.col("origin").alias("zone"), (F.col("p") - 1).alias("at"))
    got = _window_fold(ends, asks, gap, F.max).select(F.col("zone").alias("origin"), (F.col("at") + 1).alias("p"), "x")
    return trips.select("id", "origin", "p").join(got, ["origin", "p"], "left").select(
        "id", (-F.col("x.id")).alias("prev_id"), F.col("x.value").alias("prev_value"))


def link_counts(trips: DataFrame, gap: int = DEFAULT_GAP_S) -> DataFrame:
    """(id, predecessors, successors): how many links of ``chain.predecessor_pairs`` lead to and from each trip."""
    one = F.count(F.lit(1)).alias("x")
    ends = trips.groupBy(F.col("dest").alias("zone"), F.col("d").alias("t")).agg(one)
    starts = trips.groupBy(F.col("origin").alias("zone"), F.col("p").alias("t")).agg(one)
    before = _window_fold(ends, trips.select(F.col("origin").alias("zone"), (F.col("p") - 1).alias("at")), gap, F.sum)
    after = _window_fold(starts, trips.select(F.col("dest").alias("zone"), (F.col("d") + gap).alias("at")), gap, F.sum)
    zero = F.lit(0).cast("long")
    return (trips.select("id", "origin", "dest", "p", "d")
            .join(before.select(F.col("zone").alias("origin"), (F.col("at") + 1).alias("p"), F.col("x").alias("n_before")), ["origin", "p"], "left")
            .join(after.select(F.col("zone").alias("dest"), (F.col("at") - gap).alias("d"), F.col("x").alias("n_after")), ["dest", "d"], "left")
            .select("id", F.coalesce("n_before", zero).alias("predecessors"), F.coalesce("n_after", zero).alias("successors")))


def link_summary(trips: DataFrame, gap: int = DEFAULT_GAP_S) -> DataFrame:
    """One row: links, trips with a predecessor, trips with a successor, most predecessors and successors of one trip."""
    return link_counts(trips, gap).agg(
        F.coalesce(F.sum("predecessors"), F.lit(0)).cast("long").alias("links"), F.count_if(F.col("predecessors") > 0).alias("with_predecessor"),
        F.count_if(F.col("successors") > 0).alias("with_successor"), F.max("predecessors").alias("most_predecessors"),
        F.max("successors").alias("most_successors"))
