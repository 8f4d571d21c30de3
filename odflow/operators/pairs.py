"""Origin -> destination pair totals, top-N, and neighbourhood totals.

Amounts and distances are summed as DECIMAL(38, ``scale``) with 12 decimals by default, so totals
do not depend on partitioning and nothing is rounded before it is added; the
outputs are doubles cast from the exact sums.

Trips are totalled per pair before a pair is copied to its neighbours: copies grow with the
number of distinct pairs (at most zones squared), never with the trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.functions.columns import exact_sum
from odflow.roles import TripRoles


def _valid_trips(df: DataFrame, roles: TripRoles, threshold, with_distance: bool) -> DataFrame:
    need = ["origin", "dest", "amount"] + (["distance"] if with_distance or threshold is not None else [])
    t = roles.project(df, need)
    if threshold is not None:
        t = t.where(F.col("distance") <= F.lit(threshold))
    return t.dropna(subset=["origin", "dest", "amount"])


def pair_totals(df: DataFrame, roles: TripRoles, threshold=None, full: bool = True,
                scale: int | None = 12) -> DataFrame:
    """A10: per (origin, dest): total_amount_sum, trip_count (+ avg_distance, avg_amount).

    ``threshold`` applies the outlier cut ``distance <= threshold`` first (P3).
    Keys and amount must be non-null (P2).
    """
    t = _valid_trips(df, roles, threshold, full)
    aggs = [exact_sum(F.col("amount"), scale).alias("s_amt"), F.count(F.lit(1)).alias("trip_count")]
    if full:
        aggs += [exact_sum(F.col("distance"), scale).alias("s_dist"), F.count("distance").alias("n_dist")]
    g = t.groupBy("origin", "dest").agg(*aggs)
    cols = [F.col("origin"), F.col("dest"),
            F.col("s_amt").cast("double").alias("total_amount_sum"), F.col("trip_count")]
    if full:
        cols += [F.try_divide(F.col("s_dist").cast("double"), F.col("n_dist").cast("double")).alias("avg_distance"),
                 F.try_divide(F.col("s_amt").cast("double"), F.col("trip_count").cast("double")).alias("avg_amount")]
    return g.select(*cols)


def top_n(df: DataFrame, n: int, order: list, rank_col: str = "rank") -> DataFrame:
    """O2: the first ``n`` rows by ``order`` with a 1-based rank.

    ``orderBy().limit()`` plans as TakeOrderedAndProject (a per-partition top-n
    heap, then a merge of n rows per partition), so nothing is globally sorted;
    the rank window runs over those n rows only.
    """
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("int"))


def top_pairs(df: DataFrame, roles: TripRoles, threshold=None, n: int = 10, scale: int | None = 12) -> DataFrame:
    """Rank, origin, dest, total_amount_sum, trip_count, avg_distance, avg_amount.

    Ties in the total are broken by origin, then dest, so the top-N is deterministic.
    """
    totals = pair_totals(df, roles, threshold, full=True, scale=scale)
    order = [F.col("total_amount_sum").desc(), F.col("origin").asc(), F.col("dest").asc()]
    return top_n(totals, n, order).select("rank", "origin", "dest", "total_amount_sum", "trip_count",
                                          "avg_distance", "avg_amount")


def _offsets(radius: int):
    return F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj"))
                     for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)])


def _valid(o_col, d_col, min_id, max_id):
    def ok(x):
        c = x >= F.lit(min_id)
        return c if max_id is None else (c & (x <= F.lit(max_id)))
    return lambda o: ok(o_col + o["di"]) & ok(d_col + o["dj"])


def pair_sums(df: DataFrame, roles: TripRoles, threshold=None, scale: int | None = 12) -> DataFrame:
    """The 2-measure pair aggregate kept exact (decimal sum) for re-aggregation."""
    t = _valid_trips(df, roles, threshold, False)
    return (t.groupBy(F.col("origin").cast("long").alias("origin"), F.col("dest").cast("long").alias("dest"))
            .agg(exact_sum(F.col("amount"), scale).alias("s_amt"), F.count(F.lit(1)).alias("trip_count")))


def expand_neighbours(pairs: DataFrame, radius: int = 1, min_id: int = 1, max_id: int | None = None) -> DataFrame:
    """Copy each pair (x, y) to every (x+i, y+j), |i|, |j| <= radius, ids in range.

    Input: origin, dest, s_amt, trip_count (from ``pair_sums``). Output:
    canonical_origin, canonical_dest, s_amt, trip_count. The offsets are a
    literal array, exploded JVM-side (no Python per row).
    """
    valid = _valid(F.col("origin"), F.col("dest"), min_id, max_id)
    return (pairs.select("origin", "dest", "s_amt", "trip_count",
                         F.explode(F.filter(_offsets(radius), valid)).alias("o"))
            .select((F.col("origin") + F.col("o.di")).alias("canonical_origin"),
                    (F.col("dest") + F.col("o.dj")).alias("canonical_dest"),
                    "s_amt", "trip_count"))


def neighbour_totals(df: DataFrame, roles: TripRoles, threshold=None, radius: int = 1, min_id: int = 1,
                     max_id: int | None = None, scale: int | None = 12) -> DataFrame:
    """Per canonical pair, the amount and trip count of its whole neighbourhood.

    A square neighbourhood is a sum along origins followed by one along destinations: each pass copies a
    pair 2 * radius + 1 times and adds up before the next.
    """
    sums = pair_sums(df, roles, threshold, scale)
    for side in ("origin", "dest"):
        near = F.sequence(F.greatest(F.col(side) - radius, F.lit(min_id).cast("long")),
                          F.col(side) + radius if max_id is None else F.least(F.col(side) + radius, F.lit(max_id).cast("long")))
        reach = F.col(side) + radius >= min_id
        if max_id is not None:
            reach = reach & (F.col(side) - radius <= max_id)
        other = "dest" if side == "origin" else "origin"
        sums = (sums.where(reach).select(F.explode(near).alias(side), other, "s_amt", "trip_count")
                .groupBy("origin", "dest").agg(F.sum("s_amt").alias("s_amt"), F.sum("trip_count").alias("trip_count")))
    return sums.select(F.col("origin").alias("canonical_origin"), F.col("dest").alias("canonical_dest"),
                       F.col("s_amt").cast("double").alias("total_amount_sum"), F.col("trip_count").alias("total_trip_count"))


def top_neighbour_pairs(df: DataFrame, roles: TripRoles, threshold=None, n: int = 10, radius: int = 1,
                        min_id: int = 1, max_id: int | None = None, scale: int | None = 12) -> DataFrame:
    """Rank, canonical_origin, canonical_dest, total_amount_sum, total_trip_count."""
    tot = neighbour_totals(df, roles, threshold, radius, min_id, max_id, scale)
    order = [F.col("total_amount_sum").desc(), F.col("canonical_origin").asc(), F.col("canonical_dest").asc()]
    return top_n(tot, n, order).select("rank", "canonical_origin", "canonical_dest",
                                       "total_amount_sum", "total_trip_count")


def expansion_stats(df: DataFrame, roles: TripRoles, threshold=None, radius: int = 1, min_id: int = 1,
                    max_id: int | None = None, scale: int | None = 12) -> DataFrame:
    """unique_pairs, expanded_rows, expansion_ratio, in one aggregate over the pairs."""
    pairs = pair_sums(df, roles, threshold, scale)
    valid = _valid(F.col("origin"), F.col("dest"), min_id, max_id)
    agg = pairs.agg(F.count(F.lit(1)).alias("unique_pairs"),
                    F.sum(F.size(F.filter(_offsets(radius), valid))).cast("long").alias("expanded_rows"))
    return agg.select("unique_pairs", F.coalesce(F.col("expanded_rows"), F.lit(0)).alias("expanded_rows"),
                      F.try_divide(F.col("expanded_rows").cast("double"), F.col("unique_pairs").cast("double"))
                      .alias("expansion_ratio"))
