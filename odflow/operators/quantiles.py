"""Exact and approximate quantiles (A6), and the quantile profile (A2, A3).

Exact quantiles follow ``percentile_disc``: for probability p over n non-null
values, the value of 1-based rank ``max(ceil(p * n), 1)`` in ascending order,
with ``p * n`` computed exactly from the decimal text of p.

The exact method is the same at every size and never gathers a column into one task (Spark's
``percentile_disc`` merges one buffer of every distinct value in a single final task):

1. *Cut.* One sketch aggregate over all columns gives cut points.
2. *Count.* One aggregate counts rows per (column, bucket) exactly, with the smallest and largest value of
   each bucket: at most #columns x (buckets + 1) rows reach the driver. Prefix sums over
   them find, for every (column, p), the bucket holding the wanted rank and the rank within it.
3. *Pick.* A scan reads only rows inside the wanted buckets (the range predicate is pushed to the Parquet
   reader) and counts them per value. A wanted bucket is cut into cells at values drawn from the bucket (a sketch of its
   distinct values), so no cell holds much more than 1/256 of them, also with values far outside the others; the cells'
   totals tell the one that holds the rank, and a running sum goes over that cell's values only.

Integer and decimal columns are compared and returned in their own type where all columns of a call have
one; a call that mixes kinds works in double, which holds whole numbers up to 2^53 exactly.

The approximate method is ``percentile_approx`` in one aggregate over all
columns, at the accuracy the caller chooses (Spark's default 10,000 unless set).
"""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.store import Store

_BUCKETS = 4096  # per column; step 3 reads about 1/_BUCKETS of a column per wanted quantile
_CELLS = 256  # parts, about equally many values each, a wanted bucket is cut into before its values are put in order

# The probabilities of the quantile profile.
PROFILE_PROBS = (0.001, 0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99, 0.999)


def prob_label(p: float) -> str:
    """0.001 -> 'p0_1', 0.5 -> 'p50', 0.999 -> 'p99_9', 0.99985 -> 'p99_985'."""
    s = format((Decimal(str(p)) * 100).normalize(), "f")
    return "p" + s.replace(".", "_")


def target_rank(p: float, n: int) -> int:
    """1-based rank picked by ``percentile_disc``/``quantile_disc`` for p over n values."""
    return max(math.ceil(Fraction(str(p)) * n), 1)


def _named(df: DataFrame, cols) -> list[tuple[str, Column]]:
    out = []
    for c in cols:
        if isinstance(c, str):
            out.append((c, F.col(c)))
        else:
            label, expr = c
            out.append((label, expr))
    return out


def _common_type(df: DataFrame, named: list[tuple[str, Column]]) -> T.DataType:
    """bigint for whole-number columns, the widest decimal for decimal (and whole-number) ones, else double."""
    types = [f.dataType for f in df.select(*[e.alias(f"x{i}") for i, (_, e) in enumerate(named)]).schema.fields]
    if all(isinstance(t, T.IntegralType) for t in types):
        return T.LongType()
    if all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        scale = max(t.scale for t in types if isinstance(t, T.DecimalType))
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else 19 for t in types)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    return T.DoubleType()


def _long_form(df: DataFrame, named: list[tuple[str, Column]], kind: T.DataType) -> DataFrame:
    """Unpivot to (cid, v) with non-null values only."""
    items = [F.struct(F.lit(i).alias("cid"), e.cast(kind).alias("v")) for i, (_, e) in enumerate(named)]
    return df.select(F.inline(F.array(*items))).where(F.col("v").isNotNull())


def exact_quantiles(df: DataFrame, cols, probs, buckets: int = _BUCKETS) -> DataFrame:
    """Long table (column, p, value) of exact ``percentile_disc`` quantiles.

    ``cols`` are column names or (label, Column) pairs. Steps 1 and 2 run eagerly; the returned DataFrame is
    the lazy step 3. A column without values has null quantiles.
    """
    named = _named(df, cols)
    kind = _common_type(df, named)
    return pick_quantiles(df, cols, kind, probs, _bucket_counts(df, named, kind, buckets))


def pick_quantiles(df: DataFrame, cols, kind: T.DataType, probs, by_col: dict, store: Store | None = None) -> DataFrame:
    """Step 3: (column, p, value) from the exact bucket counts ``by_col`` of step 2, {column number: [(order, lo, hi, n)]}.

    The counts per value are used three times. With ``store`` they are written once, else Spark's reuse of the exchange is relied on.
    """
    spark = df.sparkSession
    named = _named(df, cols)
    probs = [float(p) for p in probs]
    targets = []  # (cid, column, pi, p, lo, hi, local_rank)
    for cid, (label, _) in enumerate(named):
        rs = [r[1:] for r in sorted(by_col.get(cid, []), key=lambda r: r[0])]  # in value order
        total = sum(n for _, _, n in rs)
        for pi, p in enumerate(probs):
            k, seen = target_rank(p, total), 0
            for lo, hi, n in rs:
                if seen + n >= k:
                    targets.append((cid, label, pi, p, lo, hi, k - seen))
                    break
                seen += n
            else:
                targets.append((cid, label, pi, p, None, None, None))
    schema = T.StructType([T.StructField(c, t) for c, t in (
        ("cid", T.IntegerType()), ("column", T.StringType()), ("pi", T.IntegerType()), ("p", T.DoubleType()), ("lo", kind), ("hi", kind), ("k", T.LongType()))])
    tdf = spark.createDataFrame(targets, schema)
    wanted = sorted({(cid, lo, hi) for cid, _, _, _, lo, hi, k in targets if k is not None}, key=lambda w: (w[0], str(w[1])))
    if not wanted:
        return tdf.select("column", "p", F.lit(None).cast(kind).alias("value"))

    # Only rows whose value lies in a wanted bucket; the OR of BETWEENs on the raw columns is what
    # the Parquet reader can push down. Written as one SQL expression where possible: every Column
    # operation is a round trip to the JVM, and there are several per range.
    raw_pred = _any_between([(named[cid][1], _sql_name(cols, cid), lo, hi) for cid, lo, hi in wanted])
    long_pred = _any_between([(F.col("v"), "v", lo, hi) for _, lo, hi in wanted], [cid for cid, _, _ in wanted])
    local = (_long_form(df.where(raw_pred), named, kind).where(long_pred)
             .groupBy("cid", "v").agg(F.count(F.lit(1)).alias("c")))
    if store is not None:
        local = store.cut(local)
    t = tdf.where(F.col("k").isNotNull()).alias("t")
    joined = local.alias("h").join(
        F.broadcast(t),  # at most #columns x #probs rows
        (F.col("h.cid") == F.col("t.cid")) & F.col("h.v").between(F.col("t.lo"), F.col("t.hi")))
    rows = _with_cells(joined.select("t.cid", "t.pi", "t.k", "h.v", "h.c"))
    before = Window.partitionBy("cid", "pi").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # one row per cell
    cells = rows.groupBy("cid", "pi", "k", "cell").agg(F.sum("c").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    cells = cells.where("before < k and k <= before + n").select("cid", "pi", "cell", "before")
    run = F.sum("c").over(Window.partitionBy("cid", "pi", "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    picked = (rows.join(F.broadcast(cells), ["cid", "pi", "cell"])  # one row per wanted quantile
              .withColumn("run", F.col("before") + run).where((F.col("run") >= F.col("k")) & (F.col("run") - F.col("c") < F.col("k")))
              .select("cid", "pi", F.col("v").alias("value")))
    # Every (column, p) stays, also for empty columns; the targets are few rows.
    return picked.join(F.broadcast(tdf), ["cid", "pi"], "right").select("column", "p", "value")


def _with_cells(rows: DataFrame) -> DataFrame:
    """``rows`` (cid, pi, k, v, c; one row per distinct value) with the cell of each value: its bucket is cut at quantiles of a sketch of the
    distinct values themselves, so cells are about equally full whatever lies between or far outside them."""
    grid = ", ".join(f"{i / _CELLS!r}D" for i in range(1, _CELLS))
    cuts = rows.groupBy("cid", "pi").agg(F.expr(f"array_distinct(percentile_approx(v, array({grid}), {10 * _CELLS}))").alias("cuts"))
    # One row per wanted quantile; a value belongs to the cell after all cuts below it.
    return rows.join(F.broadcast(cuts), ["cid", "pi"]).withColumn("cell", F.size(F.filter("cuts", lambda x: x < F.col("v")))).drop("cuts")


def _bucket_counts(df: DataFrame, named, kind: T.DataType, buckets: int) -> dict:
    """Per column: (order, lo, hi, n) of disjoint value ranges, from exact row
    counts per bucket. Buckets are cut at sketch quantiles (one aggregate) and
    assigned by a JVM binary search (``Bucketizer``) on the value as a double, which keeps the order; the
    count is an aggregate with at most one row per (column, bucket) and task to shuffle, never a
    histogram of all values. The sketch only balances the buckets: lo, hi and n
    are observed exactly, so the quantiles do not depend on it. NaN values get
    a bucket of their own after all others (NaN sorts last)."""
    several = range(len(named))
    wide = df.select(*[e.cast("double").alias(f"x{i}") for i, (_, e) in enumerate(named)],
                     *[e.cast(kind).alias(f"v{i}") for i, (_, e) in enumerate(named)])
    row = wide.agg(*cut_aggregates([f"x{i}" for i in several], buckets)).first()
    items = [F.struct(F.lit(i).alias("cid"), F.col(f"b{i}").cast("int").alias("b"), F.col(f"v{i}").alias("v")) for i in several]
    rows = (with_buckets(wide, [f"x{i}" for i in several], row).select(F.inline(F.array(*items))).where(F.col("v").isNotNull())
            .groupBy("cid", "b").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"))
            .collect())  # at most #columns x (buckets + 1) rows
    by_col: dict = {}
    for r in rows:
        by_col.setdefault(r["cid"], []).append((r["b"], r["lo"], r["hi"], int(r["n"])))
    return by_col


def cut_aggregates(xs: list[str], buckets: int = _BUCKETS) -> list[Column]:
    """Aggregates g0, g1, ... of the cut points of double columns ``xs``, for ``with_buckets``."""
    # The grid goes to the JVM as SQL text: a Python list costs one round trip per element.
    grid = ", ".join(f"{i / buckets!r}D" for i in range(1, max(2, buckets)))
    return [F.expr(f"percentile_approx({x}, array({grid}), {max(10000, 2 * buckets)})").alias(f"g{i}") for i, x in enumerate(xs)]


def with_buckets(wide: DataFrame, xs: list[str], row) -> DataFrame:
    """``wide`` with the bucket b0, b1, ... (double) of each column of ``xs``, cut at the points of ``row``."""
    from pyspark.ml.feature import Bucketizer

    splits = []
    for i in range(len(xs)):
        cuts = sorted({float(x) for x in (row[f"g{i}"] or []) if x is not None and math.isfinite(x)})
        splits.append([-math.inf, *(cuts or [0.0]), math.inf])
    return Bucketizer(splitsArray=splits, inputCols=xs, outputCols=[f"b{i}" for i in range(len(xs))], handleInvalid="keep").transform(wide)


def _sql_name(cols, cid: int) -> str | None:
    """SQL text of column ``cid`` if it was given by name, else None."""
    c = list(cols)[cid]
    return f"`{c.replace('`', '``')}`" if isinstance(c, str) else None


def _double_sql(x) -> str | None:
    """A Spark SQL literal that parses back to exactly ``x``."""
    if isinstance(x, int):
        return f"{x}L"
    if isinstance(x, Decimal):
        return f"{format(x, 'f')}BD"
    return f"{float(x)!r}D" if math.isfinite(x) else None


def _any_between(terms, cids=None) -> Column:
    """OR over ``lo <= e <= hi`` (and ``cid = c`` if ``cids`` is given)."""
    texts, cols = [], []
    for i, (e, name, lo, hi) in enumerate(terms):
        lo_s, hi_s = _double_sql(lo), _double_sql(hi)
        if name is not None and lo_s is not None and hi_s is not None:
            t = f"({name} BETWEEN {lo_s} AND {hi_s})"
            texts.append(t if cids is None else f"(cid = {int(cids[i])} AND {t})")
        else:
            t = e.between(F.lit(lo), F.lit(hi))
            cols.append(t if cids is None else (F.col("cid") == int(cids[i])) & t)
    out = F.expr(" OR ".join(texts)) if texts else None
    for t in cols:
        out = t if out is None else (out | t)
    return out


def approx_quantiles(df: DataFrame, cols, probs, accuracy: int = 10000) -> DataFrame:
    """Long table (column, p, value) from ``percentile_approx`` in one aggregate."""
    named = _named(df, cols)
    probs = [float(p) for p in probs]
    parr = F.array(*[F.lit(p) for p in probs])
    agg = df.agg(*[F.percentile_approx(e.cast("double"), parr, accuracy).alias(f"q{i}")
                   for i, (_, e) in enumerate(named)])
    items = [F.struct(F.lit(label).alias("column"), F.lit(p).alias("p"), F.col(f"q{i}")[j].alias("value"))
             for i, (label, _) in enumerate(named) for j, p in enumerate(probs)]
    return agg.select(F.inline(F.array(*items)))


def approx_within_bounds(df: DataFrame, cols, probs, accuracy: int = 10000) -> DataFrame:
    """(column, p, within): whether each approximate quantile's rank is within n / accuracy of p * n.

    A value's rank is any from the number of smaller values plus 1 to the number of values up to it. One
    aggregate more than the quantiles themselves.
    """
    named, probs = _named(df, cols), [float(p) for p in probs]
    got = {(r["column"], r["p"]): r["value"] for r in approx_quantiles(df, cols, probs, accuracy).collect()}
    facts = [(i, label, p, e, got[(label, p)]) for i, (label, e) in enumerate(named) for p in probs]
    x = [F.count(e).alias(f"n{i}") for i, (_, e) in enumerate(named)]
    x += [c for k, (_, _, _, e, v) in enumerate(facts) for c in (
        F.count_if(e.cast("double") < F.lit(v)).alias(f"a{k}"), F.count_if(e.cast("double") <= F.lit(v)).alias(f"b{k}"))]
    one = df.agg(*x)
    items = []
    for k, (i, label, p, _, _) in enumerate(facts):
        want, slack = F.lit(p) * F.col(f"n{i}"), F.col(f"n{i}") / F.lit(accuracy) + 1
        ok = (F.col(f"a{k}") + 1 <= want + slack) & (F.col(f"b{k}") >= want - slack)
        items.append(F.struct(F.lit(label).alias("column"), F.lit(p).alias("p"), ok.alias("within")))
    return one.select(F.inline(F.array(*items)))


def quantiles(df: DataFrame, cols, probs, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    if method == "exact":
        return exact_quantiles(df, cols, probs)
    if method == "approx":
        return approx_quantiles(df, cols, probs, accuracy)
    raise ValueError("method must be 'exact' or 'approx'")


def quantile_profile(df: DataFrame, cols, probs=PROFILE_PROBS, method: str = "exact",
                     mean: bool = False, accuracy: int = 10000, mean_scale: int | None = None) -> DataFrame:
    """A2: one row per column: column, min, <one column per p>, max (+ mean).

    Exact min and max are the quantiles at p = 0 and p = 1, so they come from the
    same two jobs. ``mean_scale`` sums as DECIMAL of that scale before dividing
    (order-independent); ``None`` uses a double average.
    """
    named = _named(df, cols)
    labels = [prob_label(p) for p in probs]
    if method == "exact":
        long = exact_quantiles(df, named, [0.0, *probs, 1.0])
        lab = F.when(F.col("p") == 0.0, F.lit("min")).when(F.col("p") == 1.0, F.lit("max"))
        for p, label in zip(probs, labels):
            lab = lab.when(F.col("p") == p, F.lit(label))
        wide = (long.withColumn("label", lab).groupBy("column")
                .pivot("label", ["min", *labels, "max"]).agg(F.first("value")))
    else:
        long = approx_quantiles(df, named, probs, accuracy)
        lab = None
        for p, label in zip(probs, labels):
            lab = F.when(F.col("p") == p, F.lit(label)) if lab is None else lab.when(F.col("p") == p, F.lit(label))
        pv = long.withColumn("label", lab).groupBy("column").pivot("label", labels).agg(F.first("value"))
        mm = df.agg(*[x for i, (_, e) in enumerate(named)
                      for x in (F.min(e.cast("double")).alias(f"mn{i}"), F.max(e.cast("double")).alias(f"mx{i}"))])
        mm = mm.select(F.inline(F.array(*[
            F.struct(F.lit(label).alias("column"), F.col(f"mn{i}").alias("min"), F.col(f"mx{i}").alias("max"))
            for i, (label, _) in enumerate(named)])))
        wide = pv.join(mm, "column")
    order = ["column", "min", *labels, "max"]
    if mean:
        means = df.agg(*[_mean(e, mean_scale).alias(f"m{i}") for i, (_, e) in enumerate(named)])
        means = means.select(F.inline(F.array(*[
            F.struct(F.lit(label).alias("column"), F.col(f"m{i}").alias("mean"))
            for i, (label, _) in enumerate(named)])))
        wide = wide.join(means, "column")
        order.append("mean")
    return wide.select(*order)


def _mean(e: Column, scale: int | None) -> Column:
    if scale is None:
        return F.avg(e.cast("double"))
    return F.try_divide(F.sum(e.cast(f"decimal(18,{scale})")).cast("double"), F.count(e).cast("double"))
