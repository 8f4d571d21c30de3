import datetime as dt

from pyspark.sql import functions as F

from odflow.functions import PAYMENT_TYPE_LABELS
from odflow.operators import profile


def _trips(spark):
    rows = [
        (1, 1.0, "N", 10.0, 1, dt.datetime(2018, 9, 1, 0, 0), dt.datetime(2018, 9, 1, 0, 10)),
        (2, None, "Y", -5.0, 3, dt.datetime(2018, 9, 2, 0, 0), dt.datetime(2018, 9, 2, 0, 30)),
        (1, 2.0, None, -2.5, 4, dt.datetime(2018, 8, 31, 23, 0), dt.datetime(2018, 8, 31, 22, 0)),
        (2, 1.0, "N", 7.0, 9, dt.datetime(2019, 1, 1, 0, 0), dt.datetime(2019, 1, 1, 0, 1)),
    ]
    return spark.createDataFrame(rows, "VendorID long, passenger_count double, store_and_fwd_flag string, "
                                       "fare_amount double, payment_type long, pu timestamp_ntz, do timestamp_ntz")


def test_null_profile(spark):
    out = {r["column"]: (r["null_count"], r["null_pct"]) for r in profile.null_profile(_trips(spark)).collect()}
    assert out["passenger_count"] == (1, 25.0)
    assert out["store_and_fwd_flag"] == (1, 25.0)
    assert out["VendorID"] == (0, 0.0)


def test_null_profile_empty_table(spark):
    empty = _trips(spark).where(F.lit(False))
    rows = profile.null_profile(empty).collect()
    assert all(r["null_count"] == 0 and r["null_pct"] == 0.0 for r in rows)


def test_distribution_keeps_null_group_and_labels(spark):
    df = _trips(spark)
    d = {(r["column"], r["value"]): (r["count"], r["pct"])
         for r in profile.distribution(df, ["store_and_fwd_flag", "missing_col"]).collect()}
    assert d[("store_and_fwd_flag", None)] == (1, 25.0)
    assert d[("store_and_fwd_flag", "N")] == (2, 50.0)
    lab = {r["value"]: r["description"]
           for r in profile.distribution(df, ["payment_type"], labels=PAYMENT_TYPE_LABELS).collect()}
    assert lab["1"] == "Credit card" and lab["3"] == "No charge" and lab["9"] == "Unknown code (9)"


def test_negative_check_and_breakdown(spark):
    df = _trips(spark)
    r = profile.negative_check(df, ["fare_amount"]).first()
    assert (r["negative_count"], r["negative_pct"], r["min"], r["issue"]) == (2, 50.0, -5.0, True)
    b = {x["value"]: (x["count"], x["pct"], x["description"])
         for x in profile.payment_breakdown(df).collect()}
    assert b == {"3": (1, 50.0, "No charge"), "4": (1, 50.0, "Dispute")}


def test_periods(spark):
    df = _trips(spark)
    m = {r["period"]: (r["count"], r["expected"]) for r in
         profile.period_counts(df, "pu", "month", expected="2018-09").collect()}
    assert m == {"2018-09": (2, True), "2018-08": (1, False), "2019-01": (1, False)}
    y = {r["period"]: r["count"] for r in profile.period_counts(df, "pu", "year").collect()}
    assert y == {"2018": 3, "2019": 1}
    s = profile.period_split(df, "pu", "2018-09-01", "2018-10-01").first()
    assert (s["in_period"], s["out_period"], s["in_pct"]) == (2, 2, 50.0)
    r = profile.date_range(df, "pu").first()
    assert (r["min_date"], r["max_date"]) == (dt.date(2018, 8, 31), dt.date(2019, 1, 1))


def test_duration_profile_keeps_negatives(spark):
    r = profile.duration_profile(_trips(spark), "pu", "do", probs=(0.5,)).first()
    assert r["min"] == -60.0 and r["max"] == 30.0
    assert r["mean"] == (10 + 30 - 60 + 1) / 4


def test_profile_bundle_on_trip_schema(spark):
    df = _trips(spark).withColumnRenamed("pu", "tpep_pickup_datetime").withColumnRenamed("do", "tpep_dropoff_datetime")
    b = profile.profile_bundle(df, expected_month="2018-09")
    assert {"schema", "rows", "nulls", "dimensions", "quantities", "flags", "duration", "months", "years",
            "date_range", "in_period", "negatives", "negative_breakdown"} <= set(b)
    assert b["rows"].first()["rows"] == 4
    assert b["in_period"].first()["in_period"] == 2
    dims = {(r["column"], r["value"]): r["description"] for r in b["dimensions"].collect()}
    assert dims[("payment_type", "4")] == "Dispute" and dims[("VendorID", "1")] is None


def test_empty_table_everywhere(spark):
    from odflow.operators import outliers, pairs, quantiles
    from odflow.roles import TripRoles

    empty = _trips(spark).where(F.lit(False))
    assert profile.distribution(empty, ["VendorID"]).count() == 0
    assert profile.period_counts(empty, "pu").count() == 0
    r = profile.negative_check(empty, ["fare_amount"]).first()
    assert (r["negative_count"], r["negative_pct"], r["min"]) == (0, 0.0, None)
    s = profile.period_split(empty, "pu", "2018-09-01", "2018-10-01").first()
    assert (s["total"], s["in_pct"]) == (0, 0.0)
    q = quantiles.quantile_profile(empty, ["fare_amount"]).first()
    assert q["min"] is None and q["p50"] is None
    assert outliers.find_threshold(empty, "fare_amount") is None
    roles = TripRoles(origin="VendorID", dest="payment_type", start=None, end=None,
                      distance="passenger_count", amount="fare_amount")
    assert pairs.top_pairs(empty, roles).count() == 0
    assert pairs.top_neighbour_pairs(empty, roles).count() == 0
    st = pairs.expansion_stats(empty, roles).first()
    assert (st["unique_pairs"], st["expanded_rows"], st["expansion_ratio"]) == (0, 0, None)


def test_labels_compare_numbers(spark):
    df = spark.createDataFrame([(1.0, "2"), (1.0, "x"), (7.0, "7"), (2.5, None)], "a double, b string")
    got = {r["value"]: r["description"] for r in profile.distribution(df, ["a", "b"], labels=PAYMENT_TYPE_LABELS).collect()}
    assert got == {"1.0": "Credit card", "7.0": "Unknown code (7)", "2.5": "Unknown code (2.5)", "2": "Cash", "7": "Unknown code (7)",
                   "x": "Unknown code (x)", None: None}


def test_profile_table(spark):
    rows = {(r["section"], r["column"], r["item"]): r["number"] for r in profile.profile_table(_trips(spark), ["VendorID", "store_and_fwd_flag"], ["fare_amount"]).collect()}
    assert rows[("nulls", "passenger_count", "null_count")] == 1 and rows[("range", "fare_amount", "negative_count")] == 2
    assert rows[("distribution", "store_and_fwd_flag", None)] == 1 and rows[("range", "fare_amount", "min")] == -5.0
