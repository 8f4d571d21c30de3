from pyspark.sql import functions as F

from odflow.operators.outliers import elbow_table, elbow_threshold, removal_report, remove_above

PROBS = (0.2, 0.4, 0.6, 0.8, 1.0)


def _thr(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    return elbow_threshold(elbow_table(df, "x", probs=PROBS)).first()


def test_last_jump_wins(spark):
    # quantiles at 0.2..1.0 of these 5 values are the values themselves
    r = _thr(spark, [1, 3, 4, 9, 10])  # jumps 3.0 (1->3) and 2.25 (4->9)
    assert r["has_jump"] and r["threshold"] == 8.0 and r["percentile"] == 0.6


def test_no_jump_keeps_last_value(spark):
    r = _thr(spark, [10, 11, 12, 13, 14])
    assert not r["has_jump"] and r["threshold"] == 14.0 and r["percentile"] == 1.0


def test_zero_then_positive_is_a_jump(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (0.0,), (5.0,)], "x double")
    t = {r["p"]: (r["jump"], r["is_jump"]) for r in elbow_table(df, "x", probs=PROBS).collect()}
    assert t[1.0] == (None, True)
    assert t[0.4] == (None, False)  # 0 after 0: no jump, no division error
    r = elbow_threshold(elbow_table(df, "x", probs=PROBS)).first()
    assert r["threshold"] == 0.0 and r["percentile"] == 0.8


def test_removal_counts_null_as_removed(spark):
    df = spark.createDataFrame([(1.0,), (None,), (50.0,), (3.0,)], "x double")
    r = removal_report(df, F.col("x") <= 10).first()
    assert (r["total"], r["kept"], r["removed"], r["removed_pct"]) == (4, 2, 2, 50.0)
    assert remove_above(df, "x", 10).count() == 2


def test_removal_report_empty(spark):
    df = spark.createDataFrame([], "x double")
    r = removal_report(df, F.col("x") <= 10).first()
    assert (r["total"], r["kept"], r["removed"], r["removed_pct"]) == (0, 0, 0, 0.0)
