"""Table profile (D8): nulls, distributions, periods, negatives, durations.

Each result is one or two shared passes: one aggregate with a conditional count per column,
unpivoted afterwards, or one ``groupBy(column, value)`` over an unpivoted
projection. Totals for percentages come from the groups themselves (a window over
the few result rows), not from a second scan. Percentages are of all rows unless stated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.functions.columns import PAYMENT_TYPE_LABELS, epoch_seconds, pct
from odflow.operators.quantiles import PROFILE_PROBS, quantile_profile
from odflow.store import Store


def present(df: DataFrame, cols) -> list[str]:
    """The requested columns that exist in ``df`` (others are skipped)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def row_count(df: DataFrame) -> DataFrame:
    """S5 as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def null_profile(df: DataFrame, cols=None) -> DataFrame:
    """(column, null_count, null_pct) for every column, in one aggregate.

    ``null_pct`` is 0.0 on an empty table.
    """
    cols = present(df, cols) if cols is not None else df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__c{i}") for i, c in enumerate(cols)])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"__c{i}").alias("null_count")) for i, c in enumerate(cols)]
    return agg.select(F.col("__n"), F.inline(F.array(*items))).select(
        "column", "null_count", F.coalesce(pct(F.col("null_count"), F.col("__n")), F.lit(0.0)).alias("null_pct"))


def _label_col(value: Column, labels: dict) -> Column:
    """Description of a code shown as text; the code is compared as a number, so 1 and 1.0 are one code."""
    code = value.try_cast("double")
    shown = F.when(code == F.floor(code), code.cast("decimal(38,0)").cast("string")).otherwise(value)
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for number, text in labels.items():
        expr = expr.when(code == F.lit(float(number)), F.lit(text))
    return expr.otherwise(F.concat(F.lit("Unknown code ("), shown, F.lit(")")))


def distribution(df: DataFrame, cols, labels: dict | None = None, where: Column | None = None, ranked: bool = False) -> DataFrame:
    """A1: (column, value, count, pct [, description] [, rank]) for every value of every column.

    One unpivot + one ``groupBy`` for all columns (partial aggregation before the
    shuffle). A null value is its own group. ``pct`` is of all rows of the
    (filtered) table; a column's groups hold every row once, so their counts add up to it. ``labels`` maps codes
    to descriptions (J4) with "Unknown code (n)" for others; it is a small literal map, evaluated JVM-side, and
    compares numbers, whatever the column's type. ``ranked`` adds the place by falling count, then value, nulls last.
    """
    cols = present(df, cols)
    base = df if where is None else df.where(where)
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    g = (base.select(F.inline(F.array(*items))).groupBy("column", "value")
         .agg(F.count(F.lit(1)).alias("count")))
    total = F.sum("count").over(Window.partitionBy("column"))
    out = g.select("column", "value", "count", pct(F.col("count"), total).alias("pct"))
    if labels:
        out = out.withColumn("description", F.when(F.col("value").isNotNull(), _label_col(F.col("value"), labels)))
    if ranked:
        order = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value").asc_nulls_last())
        out = out.withColumn("rank", F.row_number().over(order))
    return out


def negative_check(df: DataFrame, cols) -> DataFrame:
    """(column, negative_count, negative_pct, min, issue) per column, one aggregate."""
    cols = present(df, cols)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c) < 0).alias(f"__neg{i}"), F.min(F.col(c).cast("double")).alias(f"__min{i}")]
    agg = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("column"), F.col(f"__neg{i}").alias("negative_count"),
                      F.col(f"__min{i}").alias("min")) for i, c in enumerate(cols)]
    return agg.select("__n", F.inline(F.array(*items))).select(
        "column", "negative_count",
        F.coalesce(pct(F.col("negative_count"), F.col("__n")), F.lit(0.0)).alias("negative_pct"),
        "min", (F.col("negative_count") > 0).alias("issue"))


def negative_breakdown(df: DataFrame, measure: str, by: str, labels: dict | None = None) -> DataFrame:
    """Distribution of ``by`` among rows with ``measure < 0``, % of those rows."""
    return distribution(df, [by], labels=labels, where=F.col(measure) < 0)


def payment_breakdown(df: DataFrame, measure: str = "fare_amount", by: str = "payment_type") -> DataFrame:
    return negative_breakdown(df, measure, by, PAYMENT_TYPE_LABELS)


_GRAIN_FMT = {"month": "yyyy-MM", "year": "yyyy", "day": "yyyy-MM-dd"}


def period_counts(df: DataFrame, ts, grain: str = "month", expected: str | None = None, ranked: bool = False) -> DataFrame:
    """A4: (period, count, pct, expected [, rank]) over non-null dates; pct of all rows.

    ``expected`` marks one period (e.g. '2018-09'); null flags when not given. ``ranked`` adds the place by period. Rows
    without a date are counted as a group of their own for the total, and left out of the result.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    if grain not in _GRAIN_FMT:
        raise ValueError("grain must be day, month or year")
    g = df.groupBy(F.date_format(c, _GRAIN_FMT[grain]).alias("period")).agg(F.count(F.lit(1)).alias("count"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one row per period
    exp = (F.col("period") == F.lit(expected)) if expected is not None else F.lit(None).cast("boolean")
    out = (g.withColumn("total", F.sum("count").over(everything)).where(F.col("period").isNotNull())
           .select("period", "count", pct(F.col("count"), F.col("total")).alias("pct"), exp.alias("expected")))
    return out.withColumn("rank", F.row_number().over(Window.orderBy("period"))) if ranked else out


def date_range(df: DataFrame, ts) -> DataFrame:
    """A5: earliest and latest date."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return df.agg(F.min(F.to_date(c)).alias("min_date"), F.max(F.to_date(c)).alias("max_date"))


def period_split(df: DataFrame, ts, start, end) -> DataFrame:
    """Rows with ``start <= ts < end`` and all others, with % of all rows.

    One aggregate over the timestamp column; both sides are counted, so no filter reaches the scan.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    inside = (c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz"))
    agg = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce(inside, F.lit(False))).alias("in_period"))
    return agg.select("total", "in_period",
                      F.coalesce(pct(F.col("in_period"), F.col("total")), F.lit(0.0)).alias("in_pct"),
                      (F.col("total") - F.col("in_period")).alias("out_period"),
                      F.coalesce(pct(F.col("total") - F.col("in_period"), F.col("total")), F.lit(0.0))
                      .alias("out_pct"))


def duration_profile(df: DataFrame, start, end, unit: str = "minutes", probs=PROFILE_PROBS,
                     method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """A3: quantile profile of (end - start) plus the mean; negatives are kept.

    The duration is whole seconds divided by 60 (minutes), 3600 (hours) or 86400
    (days). The mean is the exact sum of whole seconds over the count, then
    divided by the unit.
    """
    div = {"seconds": 1.0, "minutes": 60.0, "hours": 3600.0, "days": 86400.0}[unit]
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    secs = (epoch_seconds(e) - epoch_seconds(s))
    # Written once: the durations of a join are read again for the counting and the picking pass.
    t = Store(df.sparkSession, "durations").cut(df.select(secs.alias("secs")))
    label = f"duration_{unit}"
    prof = quantile_profile(t, [(label, F.col("secs") / F.lit(div))], probs, method=method, accuracy=accuracy)
    mean = t.agg((F.try_divide(F.sum("secs").cast("double"), F.count("secs").cast("double")) / F.lit(div))
                 .alias("mean")).withColumn("column", F.lit(label))
    return prof.join(mean, "column")


# The column groups of the trip profile.
DIMENSIONS = ("VendorID", "RatecodeID", "passenger_count", "payment_type")
QUANTITIES = ("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
              "improvement_surcharge")
FLAGS = ("store_and_fwd_flag",)
FARE_COMPONENTS = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount")


def profile_table(df: DataFrame, dimensions, quantities) -> DataFrame:
    """D8 as one table: (section, column, item, number), from two shared passes.

    Sections nulls (item null_count), range (min, max, negative_count of each quantity) and distribution
    (item = value, number = count; the null group has a null item).
    """
    dims, qty = present(df, dimensions), present(df, quantities)
    facts = [("nulls", c, "null_count", F.count_if(F.col(c).isNull())) for c in df.columns]
    for c in qty:
        x = F.col(c).cast("double")
        facts += [("range", c, "min", F.min(x)), ("range", c, "max", F.max(x)), ("range", c, "negative_count", F.count_if(x < 0))]
    one = df.agg(*[e.cast("double").alias(f"f{i}") for i, (_, _, _, e) in enumerate(facts)])
    items = [F.struct(F.lit(s).alias("section"), F.lit(c).alias("column"), F.lit(n).alias("item"), F.col(f"f{i}").alias("number"))
             for i, (s, c, n, _) in enumerate(facts)]
    out = one.select(F.inline(F.array(*items)))
    if not dims:
        return out
    d = distribution(df, dims).select(F.lit("distribution").alias("section"), "column", F.col("value").alias("item"),
                                      F.col("count").cast("double").alias("number"))
    return out.unionByName(d)


def profile_bundle(df: DataFrame, start: str = "tpep_pickup_datetime", end: str = "tpep_dropoff_datetime",
                   expected_month: str | None = None, method: str = "exact") -> dict[str, DataFrame]:
    """The whole profile of a trip table as named DataFrames.

    Sections whose columns are absent are left out (P11). Each entry is one or
    two shared passes over the table; nothing is collected here except the few
    rows the exact quantiles need to place their second pass.
    """
    from odflow.sources.parquet import schema_report

    out: dict[str, DataFrame] = {"schema": schema_report(df), "rows": row_count(df), "nulls": null_profile(df)}
    dims = present(df, DIMENSIONS)
    if dims:
        labels = PAYMENT_TYPE_LABELS if "payment_type" in dims else None
        d = distribution(df, dims)
        if labels:
            d = d.withColumn("description", F.when((F.col("column") == "payment_type") & F.col("value").isNotNull(),
                                                   _label_col(F.col("value"), labels)))
        out["dimensions"] = d
    qty = present(df, QUANTITIES)
    if qty:
        out["quantities"] = quantile_profile(df, qty, method=method)
    flags = present(df, FLAGS)
    if flags:
        out["flags"] = distribution(df, flags)
    if start in df.columns and end in df.columns:
        out["duration"] = duration_profile(df, start, end, "minutes", method=method)
    if start in df.columns:
        out["months"] = period_counts(df, start, "month", expected_month)
        out["years"] = period_counts(df, start, "year", expected_month[:4] if expected_month else None)
        out["date_range"] = date_range(df, start)
        if expected_month:
            y, m = (int(x) for x in expected_month.split("-"))
            nxt = f"{y + (m == 12):04d}-{m % 12 + 1:02d}-01"
            out["in_period"] = period_split(df, start, f"{expected_month}-01", nxt)
    neg = present(df, FARE_COMPONENTS)
    if neg:
        out["negatives"] = negative_check(df, neg)
    if "fare_amount" in df.columns and "payment_type" in df.columns:
        out["negative_breakdown"] = payment_breakdown(df)
    return out
