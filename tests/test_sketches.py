import datetime as dt
import math
import random

from odflow.operators import full_profile as P
from odflow.operators import sketches as S
from odflow.operators.quantiles import target_rank
from odflow.store import Store


def _table(spark, n=30_000):
    rnd = random.Random(4)
    rows = [(f"m{i % 3}", rnd.lognormvariate(0, 3), float(i % 7) if i % 3 else None) for i in range(n)]
    rows += [("m0", math.nan, None), (None, 1.0, None)]
    return spark.createDataFrame(rows, "month string, a double, b double"), rows


def test_merged_sketches_keep_the_bound(spark):
    df, rows = _table(spark)
    parts = S.sketch_parts(df, ["a", "b"], "month")
    assert {(r["part"], r["column"]): r["n"] for r in parts.collect()}[("m0", "b")] == 0
    values = sorted(v for _, v, _ in rows if not math.isnan(v))
    got = {(r["column"], r["p"]): r["value"] for r in S.sketch_quantiles(parts, (0.0, 0.1, 0.5, 0.999, 1.0)).collect()}
    assert got[("a", 0.0)] == values[0] and got[("a", 1.0)] == values[-1]
    for p in (0.1, 0.5, 0.999):
        assert abs(values.index(got[("a", p)]) - target_rank(p, len(values))) <= 4 * S.rank_error() * len(values) + 1
    assert all(r["within"] for r in S.sketches_within_bounds(df, ["a", "b"], parts).collect())
    wrong = S.sketch_parts(df.selectExpr("month", "a + 1 as a", "b"), ["a", "b"], "month")
    assert not all(r["within"] for r in S.sketches_within_bounds(df, ["a", "b"], wrong).collect())
    share = {(r["column"], r["value"]): r["share"] for r in S.sketch_ranks(parts, {"a": [1.0], "b": [6.0]}).collect()}
    assert abs(share[("a", 1.0)] - 0.5) < 0.02 and share[("b", 6.0)] == 1.0


def test_parts_are_added_and_replaced(spark, tmp_path):
    df, _ = _table(spark, 3_000)
    path = str(tmp_path / "sketches")
    for month in ("m0", "m1"):
        S.add_sketches(S.sketch_parts(df.where(f"month = '{month}'"), ["a"], "month"), path)
    S.add_sketches(S.sketch_parts(df.where("month = 'm1' and a < 1"), ["a"], "month"), path)  # loaded again
    n = {r["part"]: r["n"] for r in S.read_sketches(spark, path).collect()}
    assert n == {"m0": 1000, "m1": df.where("month = 'm1' and a < 1").count()}
    assert [r["part"] for r in S.read_sketches(spark, path, ["m0"]).collect()] == ["m0"]
    assert S.merge_sketches(S.read_sketches(spark, path)).first()["n"] == sum(n.values())


def test_empty_sketches(spark):
    df, _ = _table(spark, 3)
    assert S.sketch_parts(df.limit(0), ["a"], "month").count() == 0
    none = S.sketch_parts(df.selectExpr("month", "cast(null as double) as a"), ["a"], "month")
    assert {r["value"] for r in S.sketch_quantiles(none, [0.5]).collect()} == {None}


def test_full_profile_and_its_scans(spark):
    t = dt.datetime(2018, 9, 1)
    rows = [("x", 1, 5.0, t, t + dt.timedelta(minutes=10)), ("x", 2, -5.0, t, t - dt.timedelta(minutes=1)),
            (None, 1, None, None, t), ("y", 9, 3.0, t + dt.timedelta(days=31), t + dt.timedelta(days=32))]
    df = spark.createDataFrame(rows, "flag string, pay int, fare double, pu timestamp_ntz, do timestamp_ntz")
    store = Store(spark, "test_full_profile")
    out = P.full_profile(df, ["flag", "pay", "absent"], ["fare", "absent"], "pu", "do", "2018-09", ("fare", "pay"), {"pay": {1: "Credit card"}}, store=store)
    got = {(r["section"], r["column"], r["item"]): (r["number"], r["pct"], r["text"]) for r in out.collect()}
    assert got[("rows", None, "count")][0] == 4 and got[("nulls", "fare", "null_count")][:2] == (1.0, 25.0)
    assert got[("range", "fare", "negative_count")][0] == 1 and got[("negative_by", "pay", "2")] == (1.0, 100.0, "Unknown code (2)")
    assert got[("distribution", "flag", None)][:2] == (1.0, 25.0) and got[("distribution", "pay", "1")] == (2.0, 50.0, "Credit card")
    assert got[("month", "pu", "2018-09")] == (2.0, 50.0, "expected") and got[("year", "pu", "2018")] == (3.0, 75.0, "expected")
    assert got[("date_range", "pu", "max_date")][2] == "2018-10-02" and got[("period", "pu", "out_period")][0] == 2
    assert got[("quantiles", "fare", "p50")][0] == 3.0 and got[("quantiles", P.DURATION, "p50")][0] == 10.0
    assert got[("range", P.DURATION, "min")][0] == -1.0 and got[("range", P.DURATION, "mean")][0] == (10 - 1 + 1440) / 3
    assert not any(k[2] is None and k[0] in ("month", "year") for k in got)
    empty = P.full_profile(df.limit(0), ["flag"], ["fare"], "pu", "do", "2018-09", store=store).collect()
    assert {r["number"] for r in empty if r["section"] == "quantiles"} == {None}
    assert P.full_profile(df.select("flag")).count() == 2
    store.release()


def test_full_profile_reads_the_table_three_times(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        reads.add(1)
        yield from batches

    df = spark.range(100).selectExpr("id % 3 as k", "cast(id as double) as v").coalesce(1).mapInArrow(seen, "k long, v double")
    P.full_profile(df, ["k"], ["v"]).collect()
    assert reads.value == 3
