"""Elbow rule on high percentiles (D1, D2) and outlier removal.

The rule: take the values v_i at increasing tail probabilities p_i; the jump at
i is v_i / v_{i-1}. The **last** i whose jump exceeds ``ratio`` sets the
threshold to ``v_{i-1} * factor`` (reported percentile p_{i-1}). Without any
jump the threshold is the last value, not multiplied. A previous value of 0
with a positive current value counts as a jump, without a division error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.functions.columns import pct
from odflow.operators.quantiles import quantiles

# The tail probabilities and constants of the elbow rule.
ELBOW_PROBS = (0.999, 0.9995, 0.9996, 0.9997, 0.9998, 0.99985, 0.9999)
JUMP_RATIO = 2.0
SAFETY_FACTOR = 2.0


def elbow_table(df: DataFrame, col, probs=ELBOW_PROBS, method: str = "exact",
                ratio: float = JUMP_RATIO, accuracy: int = 10000) -> DataFrame:
    """(p, value, jump, is_jump), one row per probability.

    ``col`` is a column name or a (label, Column) pair. The table has
    ``len(probs)`` rows, so the ``lag`` window over it is trivially small.
    """
    c = col if isinstance(col, tuple) else (col, F.col(col))
    q = quantiles(df, [c], probs, method=method, accuracy=accuracy).select("p", "value")
    w = Window.orderBy("p")
    prev = F.lag("value").over(w)
    return (q.withColumn("prev", prev)
            .withColumn("jump", F.when(F.col("prev") != 0, F.try_divide(F.col("value"), F.col("prev"))))
            .withColumn("is_jump", F.coalesce(
                (F.col("jump") > ratio) | ((F.col("prev") == 0) & (F.col("value") > 0)), F.lit(False)))
            .select("p", "value", "jump", "is_jump"))


def elbow_threshold(table: DataFrame, factor: float = SAFETY_FACTOR) -> DataFrame:
    """One row (threshold, percentile, has_jump) from an ``elbow_table``."""
    w = Window.orderBy("p")
    t = table.withColumn("prev_v", F.lag("value").over(w)).withColumn("prev_p", F.lag("p").over(w))
    agg = t.agg(
        F.max_by(F.struct((F.col("prev_v") * factor).alias("t"), F.col("prev_p").alias("q")),
                 F.when(F.col("is_jump"), F.col("p"))).alias("j"),
        F.max_by(F.struct(F.col("value").alias("t"), F.col("p").alias("q")), F.col("p")).alias("last"),
        F.max(F.col("is_jump").cast("int")).alias("hj"))
    has = F.coalesce(F.col("hj") == 1, F.lit(False))
    return agg.select(
        F.when(has, F.col("j.t")).otherwise(F.col("last.t")).alias("threshold"),
        F.when(has, F.col("j.q")).otherwise(F.col("last.q")).alias("percentile"),
        has.alias("has_jump"))


def find_threshold(df: DataFrame, col, probs=ELBOW_PROBS, method: str = "exact",
                   ratio: float = JUMP_RATIO, factor: float = SAFETY_FACTOR, accuracy: int = 10000):
    """The elbow threshold as a Python float (None for an empty column).

    Collects the one row that steers the later filter, so that the filter is a
    literal the Parquet reader can push down.
    """
    row = elbow_threshold(elbow_table(df, col, probs, method, ratio, accuracy), factor).first()
    return None if row is None else row["threshold"]


def remove_above(df: DataFrame, col, threshold) -> DataFrame:
    """D3: keep rows with ``col <= threshold``; null values are removed."""
    c = F.col(col) if isinstance(col, str) else col
    return df.where(c <= F.lit(threshold))


def removal_report(df: DataFrame, keep: Column) -> DataFrame:
    """(total, kept, removed, removed_pct) around a filter, in one aggregate.

    Rows where ``keep`` is null count as removed.
    """
    agg = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.coalesce(keep, F.lit(False))).alias("kept"))
    return agg.select("total", "kept", (F.col("total") - F.col("kept")).alias("removed"),
                      F.coalesce(pct(F.col("total") - F.col("kept"), F.col("total")), F.lit(0.0))
                      .alias("removed_pct"))
