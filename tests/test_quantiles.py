import math
import random

import duckdb
import pytest

from pyspark.sql import functions as F

from odflow.operators import quantiles as Q
from odflow.operators.quantiles import (PROFILE_PROBS, approx_within_bounds, exact_quantiles, prob_label, quantile_profile,
                                        target_rank)

PROBS = [0.0, 0.001, 0.01, 0.25, 0.5, 0.75, 0.9997, 0.9999, 1.0]


def test_labels():
    assert [prob_label(p) for p in PROFILE_PROBS] == [
        "p0_1", "p1", "p5", "p25", "p50", "p75", "p95", "p99", "p99_9"]


def test_rank_is_exact_decimal():
    assert target_rank(0.9997, 10000) == 9997
    assert target_rank(0.0, 10) == 1
    assert target_rank(1.0, 10) == 10


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 3), (3, 16)])
def test_exact_matches_quantile_disc(spark, seed, parts):
    rnd = random.Random(seed)
    vals = [float(rnd.choice([rnd.randint(0, 20), rnd.random() * 1000])) for _ in range(3000)]
    vals += [None] * 50
    df = spark.createDataFrame([(v, -v if v is not None else None) for v in vals], "a double, b double")
    got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, ["a", "b"], PROBS, parts).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(a DOUBLE, b DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(v, -v if v is not None else None) for v in vals])
    for c in ["a", "b"]:
        for p in PROBS:
            want = con.sql(f"SELECT quantile_disc({c}, {p}) FROM t").fetchall()[0][0]
            assert got[(c, p)] == want, (c, p)


def test_exact_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    rows = exact_quantiles(df, ["a"], [0.5]).collect()
    assert len(rows) == 1 and rows[0]["value"] is None


def test_approx_within_rank_bounds(spark):
    n = 20000
    df = spark.range(n).selectExpr("cast(id as double) as x")
    prof = quantile_profile(df, ["x"], probs=(0.5, 0.99), method="approx", accuracy=10000).first()
    for p, label in ((0.5, "p50"), (0.99, "p99")):
        assert abs(prof[label] - p * n) <= n / 10000 + 1
    assert prof["min"] == 0 and prof["max"] == n - 1


def test_profile_exact_shape(spark):
    df = spark.range(1, 1001).selectExpr("cast(id as double) as x")
    r = quantile_profile(df, ["x"], mean=True, mean_scale=2).first()
    assert r["min"] == 1 and r["max"] == 1000 and r["p50"] == 500 and r["p99_9"] == 999
    assert math.isclose(r["mean"], 500.5)


def test_exact_with_nan_and_odd_names(spark):
    # NaN sorts above every number (as in percentile_disc), so a range bound may
    # be NaN; a column name with a space goes through the SQL-text predicate.
    from pyspark.sql import functions as F

    rnd = random.Random(7)
    rows = [(float("nan") if i % 97 == 0 else rnd.random() * 50, float(i % 13)) for i in range(2000)]
    df = spark.createDataFrame(rows, "`odd name` double, b double")
    cols = ["odd name", ("b2", F.col("b") * 2)]
    got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, cols, PROBS, 8).collect()}
    for label, expr in [("odd name", "`odd name`"), ("b2", "b * 2")]:
        for p in PROBS:
            want = df.selectExpr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {expr}) AS q").first()["q"]
            g = got[(label, p)]
            assert (math.isnan(g) and math.isnan(want)) or g == want, (label, p, g, want)


def test_types_are_kept(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(2**53 + 1, Decimal("1.10"), 3), (5, Decimal("-2.25"), 1), (None, None, 2)], "a long, b decimal(10,2), c int")
    assert [r["value"] for r in exact_quantiles(df, ["a", "c"], [1.0]).orderBy("column").collect()] == [2**53 + 1, 3]
    assert exact_quantiles(df, ["b"], [0.0, 1.0]).orderBy("p").collect()[1]["value"] == Decimal("1.10")
    assert {type(r["value"]) for r in exact_quantiles(df, ["b", ("x", F.col("c") / 2)], [0.5]).collect()} == {float}


def test_heavy_ties_and_few_buckets(spark):
    rnd = random.Random(17)
    vals = [float(rnd.choice([rnd.randint(-5, 5), 3, 3, rnd.gauss(0, 100)])) for _ in range(4000)] + [None] * 30
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    have = sorted(v for v in vals if v is not None)
    for buckets in (1, 2, 50):
        got = {r["p"]: r["value"] for r in exact_quantiles(df, ["a"], PROBS, buckets).collect()}
        assert got == {p: have[target_rank(p, len(have)) - 1] for p in PROBS}


def test_approx_bounds(spark):
    df = spark.range(5000).selectExpr("cast(id % 700 as double) as x", "id as y")
    assert {r["within"] for r in approx_within_bounds(df, ["x", "y"], PROBS).collect()} == {True}


def test_cells_stay_even_in_a_heavy_tail(spark):
    """10**6 distinct values and one at 1e300 in one bucket: no cell, which is what one task orders, gets more than 1/100 of them."""
    df = spark.range(1_000_000).select((F.col("id") * 1.5).alias("x")).unionByName(spark.createDataFrame([(1e300,), (float("inf"),)], "x double"))
    probs = [0.001, 0.5, 0.99985, 1.0]
    got = {r["p"]: r["value"] for r in Q.exact_quantiles(df, ["x"], probs, buckets=1).collect()}
    n = 1_000_002
    assert got == {p: 1.5 * (Q.target_rank(p, n) - 1) if p < 1 else float("inf") for p in probs}
    rows = df.select(F.lit(0).alias("cid"), F.lit(0).alias("pi"), F.lit(1).cast("long").alias("k"), F.col("x").alias("v"), F.lit(1).cast("long").alias("c"))
    most = Q._with_cells(rows).groupBy("cell").count().agg(F.max("count")).first()[0]
    assert most <= n / 100


def test_cells_of_whole_numbers_and_decimals(spark):
    for kind in ("long", "decimal(30,4)"):
        df = spark.range(3000).select((F.col("id") * F.col("id") % 977).cast(kind).alias("x"))
        values = sorted(r["x"] for r in df.collect())
        got = {r["p"]: r["value"] for r in Q.exact_quantiles(df, ["x"], [0.1, 0.5, 0.999], buckets=2).collect()}
        assert got == {p: values[Q.target_rank(p, 3000) - 1] for p in (0.1, 0.5, 0.999)}
