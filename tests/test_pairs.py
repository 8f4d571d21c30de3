from decimal import Decimal

from pyspark.sql import functions as F

from odflow.operators import pairs
from odflow.roles import TripRoles

ROLES = TripRoles(origin="o", dest="d", start=None, end=None, distance="dist", amount="amt")


def _df(spark, rows):
    return spark.createDataFrame(rows, "o long, d long, dist double, amt double")


def test_pair_totals_skip_null_keys_and_amounts(spark):
    df = _df(spark, [(1, 2, 1.0, 10.0), (1, 2, 3.0, 5.5), (None, 2, 1.0, 1.0), (1, None, 1.0, 1.0),
                     (1, 2, 1.0, None), (2, 1, None, 4.0)])
    got = {(r["origin"], r["dest"]): (r["total_amount_sum"], r["trip_count"], r["avg_distance"], r["avg_amount"])
           for r in pairs.pair_totals(df, ROLES).collect()}
    assert got == {(1, 2): (15.5, 2, 2.0, 7.75), (2, 1): (4.0, 1, None, 4.0)}


def test_threshold_drops_null_distance(spark):
    df = _df(spark, [(1, 2, 1.0, 10.0), (1, 2, None, 5.0), (1, 2, 99.0, 5.0)])
    r = pairs.top_pairs(df, ROLES, threshold=10.0).first()
    assert (r["rank"], r["trip_count"], r["total_amount_sum"]) == (1, 1, 10.0)


def test_top_pairs_ties_by_keys(spark):
    df = _df(spark, [(3, 1, 1.0, 5.0), (1, 2, 1.0, 5.0), (1, 1, 1.0, 5.0), (9, 9, 1.0, 1.0)])
    got = [(r["rank"], r["origin"], r["dest"]) for r in pairs.top_pairs(df, ROLES, n=3).orderBy("rank").collect()]
    assert got == [(1, 1, 1), (2, 1, 2), (3, 3, 1)]


def test_neighbour_expansion_edges(spark):
    p = spark.createDataFrame([(1, 1, Decimal(10), 1), (5, 5, Decimal(7), 2)],
                              "origin long, dest long, s_amt decimal(28,2), trip_count long")
    ex = pairs.expand_neighbours(p).collect()
    from_11 = sorted((r["canonical_origin"], r["canonical_dest"]) for r in ex if r["s_amt"] == 10)
    assert from_11 == [(1, 1), (1, 2), (2, 1), (2, 2)]
    from_55 = sorted((r["canonical_origin"], r["canonical_dest"]) for r in ex if r["s_amt"] == 7)
    assert from_55 == [(4, 4), (4, 5), (4, 6), (5, 4), (5, 5), (5, 6), (6, 4), (6, 5), (6, 6)]


def test_neighbour_totals_and_stats(spark):
    df = _df(spark, [(5, 5, 1.0, 1.0), (4, 4, 1.0, 2.0), (7, 7, 1.0, 4.0), (1, 1, 1.0, 8.0)])
    tot = {(r["canonical_origin"], r["canonical_dest"]): (r["total_amount_sum"], r["total_trip_count"])
           for r in pairs.neighbour_totals(df, ROLES).collect()}
    assert tot[(5, 5)] == (3.0, 2)  # (4,4) and (5,5); (7,7) is two away
    assert tot[(6, 6)] == (5.0, 2)
    top = pairs.top_neighbour_pairs(df, ROLES, n=1).first()
    assert (top["canonical_origin"], top["canonical_dest"], top["total_amount_sum"]) == (1, 1, 8.0)
    s = pairs.expansion_stats(df, ROLES).first()
    assert (s["unique_pairs"], s["expanded_rows"]) == (4, 9 + 9 + 9 + 4)
    # invariant: expanded trip count = sum over pairs of trips x valid neighbours
    total = pairs.neighbour_totals(df, ROLES).agg(F.sum("total_trip_count")).first()[0]
    assert total == 31


def test_totals_keep_small_and_large_values(spark):
    got = pairs.pair_totals(_df(spark, [(1, 1, 0.004, 0.004)] * 3 + [(2, 2, 1e17, 1e17), (2, 2, 1.0, 0.001)]), ROLES).orderBy("origin").collect()
    assert (got[0]["total_amount_sum"], got[0]["avg_distance"]) == (0.012, 0.004)
    assert got[1]["total_amount_sum"] == 1e17 and got[1]["trip_count"] == 2


def test_two_passes_equal_the_square(spark):
    """Sums along origins, then destinations, against copying every pair to its whole square."""
    import random

    from pyspark.sql import functions as F

    from odflow.operators import pairs as P
    from odflow.roles import TripRoles

    rnd = random.Random(3)
    rows = [(rnd.randint(-4, 12), rnd.randint(-4, 12), rnd.random()) for _ in range(400)] + [(None, 1, 2.0), (1, 1, None)]
    df = spark.createDataFrame(rows, "o int, d int, a double")
    roles = TripRoles(origin="o", dest="d", start=None, end=None, distance=None, amount="a")
    for radius, low, high in ((1, 1, None), (2, 1, 6), (3, -9, None)):
        square = (P.expand_neighbours(P.pair_sums(df, roles), radius, low, high).groupBy("canonical_origin", "canonical_dest")
                  .agg(F.sum("s_amt").cast("double").alias("x"), F.sum("trip_count").alias("n")))
        want = sorted(tuple(r) for r in square.collect())
        got = P.neighbour_totals(df, roles, radius=radius, min_id=low, max_id=high)
        assert sorted(tuple(r) for r in got.collect()) == want
