"""Quantile sketches that are kept per part of a table (a file, a month) and merged later (A2, A3, A6 approximate).

``percentile_approx`` has to read everything again when a month is added. Here every (part, column) gets one KLL sketch, a few
kilobytes to a few hundred, made by a partial aggregate in each task; new parts are sketched alone, a part that is loaded
again replaces its old sketches, and quantiles or ranks over any choice of parts come from merging their sketches.

A merged sketch is as good as one made over all rows at once: a value given for probability p has a rank within
``rank_error(k)`` times the rows of p * n, with a confidence of 99 percent for each. Nulls and NaN are not counted. A sketch holds a
random sample inside that bound, so two runs may give different values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.operators.quantiles import PROFILE_PROBS, _named

#: Sketch size: rank error 0.07 percent, about 100 KB a full sketch.
SKETCH_K = 4096

SCHEMA = T.StructType([T.StructField("part", T.StringType()), T.StructField("column", T.StringType()),
                       T.StructField("n", T.LongType()), T.StructField("sketch", T.BinaryType())])


def rank_error(k: int = SKETCH_K) -> float:
    """Share of the rows by which the rank of one quantile may be off (published bound of the sketch)."""
    return 2.296 / k ** 0.9723


def sketch_parts(df: DataFrame, cols, part, k: int = SKETCH_K) -> DataFrame:
    """(part, column, n, sketch): one sketch of every column for each value of ``part`` (a column or its name, taken as text).

    One aggregate with as many groups as parts; only sketches are shuffled. A column without values in a part has n = 0 and a null
    sketch; rows whose part is null are the part null; an empty table gives no rows.
    """
    named = _named(df, cols)
    part = F.col(part) if isinstance(part, str) else part
    values = [F.when(~F.isnan(e.cast("double")), e.cast("double")).alias(f"x{i}") for i, (_, e) in enumerate(named)]
    aggs = [a for i in range(len(named)) for a in (F.count(f"x{i}").alias(f"n{i}"), F.kll_sketch_agg_double(f"x{i}", F.lit(k)).alias(f"s{i}"))]
    wide = df.select(part.cast("string").alias("part"), *values).groupBy("part").agg(*aggs)
    items = [F.struct(F.lit(label).alias("column"), F.col(f"n{i}").alias("n"), F.when(F.col(f"n{i}") > 0, F.col(f"s{i}")).alias("sketch"))
             for i, (label, _) in enumerate(named)]
    return wide.select("part", F.inline(F.array(*items)))


def add_sketches(sketches: DataFrame, path: str) -> None:
    """Write parts to the sketch table at ``path``; a part that is there already is replaced, other parts are not touched.

    One folder a part (dynamic partition overwrite, set for this write alone), so it may be repeated after a failure.
    """
    (sketches.select("column", "n", "sketch", "part").repartition("part").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path))


def read_sketches(spark: SparkSession, path: str, parts=None) -> DataFrame:
    """The sketch table, or some of its parts; the choice prunes folders."""
    out = spark.read.schema(SCHEMA).parquet(path).select(*SCHEMA.names)
    return out if parts is None else out.where(F.col("part").isin([str(p) for p in parts]))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """(column, n, sketch): all parts of every column as one. A column without any value keeps n = 0 and a null sketch."""
    return sketches.groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("s")).select(
        "column", "n", F.when(F.col("n") > 0, F.col("s")).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs=PROFILE_PROBS) -> DataFrame:
    """(column, p, value) over all parts given. p = 0 and 1 are the exact smallest and largest values; null without values."""
    probs = [float(p) for p in probs]
    grid = F.array(*[F.lit(p) for p in probs])
    got = merge_sketches(sketches).withColumn("q", F.when(F.col("sketch").isNotNull(), F.kll_sketch_get_quantile_double("sketch", grid)))
    items = [F.struct(F.lit(p).alias("p"), F.get("q", F.lit(i)).alias("value")) for i, p in enumerate(probs)]
    return got.select("column", F.inline(F.array(*items)))


def sketch_ranks(sketches: DataFrame, values: dict[str, list[float]]) -> DataFrame:
    """(column, value, share): the share of a column's values up to each of the given ones; null without values."""
    grid = sorted({float(v) for vs in values.values() for v in vs})  # the function takes literals only
    got = merge_sketches(sketches).withColumn("r", F.when(F.col("sketch").isNotNull(), F.kll_sketch_get_rank_double(
        "sketch", F.array(*[F.lit(v) for v in grid]))))
    items = [F.when(F.col("column").isin([c for c, vs in values.items() if v in map(float, vs)]),
                    F.struct(F.lit(v).alias("value"), F.get("r", F.lit(i)).alias("share"))) for i, v in enumerate(grid)]
    return got.select("column", F.inline(F.array_compact(F.array(*items))))


def sketches_within_bounds(df: DataFrame, cols, sketches: DataFrame, probs=PROFILE_PROBS, slack: float = 4 * rank_error()) -> DataFrame:
    """(column, p, within): whether the merged quantile's rank in ``df`` is within ``slack`` * n of p * n.

    The rank of a value is any from the number of smaller values plus 1 to the number of values up to it. The default is four times the
    99 percent bound, which no run should leave. One aggregate over ``df``; the quantiles (columns times probabilities) are broadcast.
    """
    named = _named(df, cols)
    q = F.broadcast(sketch_quantiles(sketches, probs).withColumnRenamed("column", "c"))  # few rows
    cells = [F.struct(F.lit(label).alias("column"), e.cast("double").alias("x")) for label, e in named]
    counts = (df.select(F.inline(F.array(*cells))).where("x is not null and not isnan(x)").groupBy("column", "x").agg(F.count(F.lit(1)).alias("m")))
    ranked = (counts.join(q, F.col("column") == F.col("c"), "right")
              .groupBy(F.col("c").alias("column"), "p", "value")
              .agg(F.sum("m").alias("n"), F.sum(F.when(F.col("x") < F.col("value"), F.col("m")).otherwise(0)).alias("below"),
                   F.sum(F.when(F.col("x") <= F.col("value"), F.col("m")).otherwise(0)).alias("upto")))
    want, room = F.col("p") * F.col("n"), F.lit(slack) * F.col("n") + 1
    ok = (F.col("below") + 1 <= want + room) & (F.col("upto") >= want - room)
    return ranked.select("column", "p", F.coalesce(ok, F.lit(False)).alias("within"))
