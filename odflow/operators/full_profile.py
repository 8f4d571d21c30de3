"""The whole profile of a trip table as one table, from three scans.

Scan 1 is one aggregate of everything that is one number for a column: nulls, ranges, negatives, dates, the period asked for,
durations, and the cut points for quantiles. Scan 2 is one ``groupBy`` over a tagged long form: values of dimensions, months,
years, negatives by a dimension, and the buckets of every quantity; what it gives is written once. Scan 3 reads only rows in the buckets
that hold a wanted quantile and writes their counts. However many sections there are, the table is read three times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.functions.columns import epoch_seconds, pct
from odflow.operators import quantiles as Q
from odflow.operators.profile import _label_col, present
from odflow.store import Store

DURATION = "duration_minutes"


def full_profile(df: DataFrame, dimensions=(), quantities=(), start: str | None = None, end: str | None = None,
                 expected_month: str | None = None, negative: tuple[str, str] | None = None, labels: dict[str, dict] | None = None,
                 probs=Q.PROFILE_PROBS, store: Store | None = None) -> DataFrame:
    """(section, column, item, number, pct, text); sections whose columns are absent are left out.

    rows: item count. nulls: null_count (pct of all rows) of every column. range: min, max, negative_count (pct) of each quantity.
    distribution: item = value, number = count, pct of all rows, text = description from ``labels`` {column: {code: text}}; the null
    group has a null item. month, year: item = period of ``start``, number = count, pct of all rows, text 'expected' for the one asked for. date_range:
    text = the first and last date. period: rows inside and outside ``expected_month``. negative_by: like distribution, of rows with
    ``negative[0]`` < 0 by ``negative[1]``, pct of those. quantiles: exact, item p0_1 to p99_9. With ``start`` and ``end`` the
    duration in minutes (whole seconds / 60) is one more quantity, and has a mean.

    An empty table gives counts of 0, null percentages and null numbers. The scans run at once; the counts of scans 2 and 3 lie in
    ``store`` (one of the call's own without it), which the caller may release after reading the result.
    """
    store = store or Store(df.sparkSession, "full_profile")
    dims, qty = present(df, dimensions), present(df, quantities)
    start = start if start in df.columns else None
    timed = start is not None and end in df.columns
    named = [(c, F.col(f"`{c}`")) for c in qty]
    secs = epoch_seconds(F.col(f"`{end}`")) - epoch_seconds(F.col(f"`{start}`")) if timed else None
    if timed:
        named.append((DURATION, secs / F.lit(60.0)))
    kind = Q._common_type(df, named) if named else None
    xs = [f"x{i}" for i in range(len(named))]

    # Scan 1. ``facts`` are (section, column, item, number, whether it is a share of all rows).
    facts = [("rows", None, "count", F.count(F.lit(1)), False)]
    facts += [("nulls", c, "null_count", F.count_if(F.col(f"`{c}`").isNull()), True) for c in df.columns]
    for label, e in named:
        x = e.cast("double")
        facts += [("range", label, "min", F.min(x), False), ("range", label, "max", F.max(x), False),
                  ("range", label, "negative_count", F.count_if(x < 0), True)]
    if timed:
        facts.append(("range", DURATION, "mean", F.try_divide(F.sum(secs).cast("double"), F.count(secs)) / F.lit(60.0), False))
    dates = []
    if start:
        day = F.to_date(F.col(f"`{start}`"))
        dates = [("min_date", F.min(day)), ("max_date", F.max(day))]
        if expected_month:
            inside = F.coalesce(F.date_format(f"`{start}`", "yyyy-MM") == F.lit(expected_month), F.lit(False))
            facts += [("period", start, "in_period", F.count_if(inside), True), ("period", start, "out_period", F.count_if(~inside), True)]
    wide = df.select("*", *[e.cast("double").alias(f"__{x}") for x, (_, e) in zip(xs, named)])
    one = wide.agg(*[n.cast("double").alias(f"f{i}") for i, (*_, n, _) in enumerate(facts)], *[d.cast("string").alias(n) for n, d in dates],
                   *Q.cut_aggregates([f"__{x}" for x in xs])).first()
    rows = one["f0"]
    head = [(s, c, i, one[f"f{k}"], 100.0 * one[f"f{k}"] / rows if share and rows else None, None)
            for k, (s, c, i, _, share) in enumerate(facts)]
    head += [("date_range", start, n, None, None, one[n]) for n, _ in dates]
    schema = "section string, `column` string, item string, number double, pct double, text string"
    out = df.sparkSession.createDataFrame(head, schema)  # a few rows a column

    # Scan 2.
    def tag(section, column, item=None, cid=None, bucket=None, value=None):
        return F.struct(F.lit(section).alias("section"), F.lit(column).alias("column"), (F.lit(None) if item is None else item).cast("string").alias("item"),
                        F.lit(cid).cast("int").alias("cid"), (F.lit(None) if bucket is None else bucket).cast("int").alias("b"),
                        (F.lit(None) if value is None else value).cast(kind or "double").alias("v"))

    tags = [tag("distribution", c, F.col(f"`{c}`")) for c in dims]
    if start:
        tags += [tag(s, start, F.date_format(f"`{start}`", f)) for s, f in (("month", "yyyy-MM"), ("year", "yyyy"))]
    if negative and set(negative) <= set(df.columns):
        tags.append(F.when(F.col(f"`{negative[0]}`") < 0, tag("negative_by", negative[1], F.col(f"`{negative[1]}`"))))
    tags += [F.when(e.isNotNull(), tag("bucket", label, cid=i, bucket=F.col(f"b{i}"), value=e)) for i, (label, e) in enumerate(named)]
    if not tags:
        return out
    source = Q.with_buckets(wide, [f"__{x}" for x in xs], one) if named else wide
    counted = store.cut(source.select(F.inline(F.array_compact(F.array(*tags)))).groupBy("section", "column", "item", "cid", "b")
                        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    groups = counted.where("section <> 'bucket'")
    total = F.sum("n").over(Window.partitionBy("section", "column"))
    text = F.when(F.col("section").isin("month", "year") & (F.col("item") == F.substring(F.lit(expected_month), 1, F.length("item"))), F.lit("expected"))
    for column, texts in (labels or {}).items():
        text = text.when((F.col("column") == column) & F.col("section").isin("distribution", "negative_by") & F.col("item").isNotNull(),
                         _label_col(F.col("item"), texts))
    out = out.unionByName(groups.withColumn("pct", pct(F.col("n"), total))
                          .where("section not in ('month', 'year') or item is not null")  # rows without a date count for the total only
                          .select("section", "column", "item", F.col("n").cast("double").alias("number"), "pct", text.alias("text")))
    if not named:
        return out

    # Scan 3.
    by_col: dict = {}
    for r in counted.where("section = 'bucket'").collect():  # at most quantities x (buckets + 1) rows
        by_col.setdefault(r["cid"], []).append((r["b"], r["lo"], r["hi"], r["n"]))
    picked = Q.pick_quantiles(df, [c if c != DURATION else (c, e) for c, e in named], kind, probs, by_col, store)
    name = F.create_map(*[x for p in probs for x in (F.lit(float(p)), F.lit(Q.prob_label(p)))])
    return out.unionByName(picked.select(F.lit("quantiles").alias("section"), "column", F.element_at(name, F.col("p")).alias("item"),
                                         F.col("value").cast("double").alias("number"), F.lit(None).cast("double").alias("pct"), F.lit(None).cast("string").alias("text")))
