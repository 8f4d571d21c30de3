"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

Targets come from weights, capped at a multiple of each source's size. The mix is dealt
out in blocks of equal size: the sources, then groups of shards, then shards receive whole
blocks by highest quotients (v, v/3, v/5, ...), and within a shard a seeded order of its
documents decides which of them fill its blocks. A source is cut in as many shards as its
size asks for, so no task holds more than a shard, whatever share of the rows a source has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odflow.llm.columns import n_words
from odflow.store import Store

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, CAP = 1.5, 2.0
BLOCK_WORDS = 16
SHARD_WORDS = 2_000_000
GROUP = 1024
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size): one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn. ``share`` of all sizes
    is dealt out by weight; no target exceeds ``cap`` times its source's size, and what that
    frees goes to the others by weight. The result is the level t with sum(min(cap * size,
    weight * t)) = share * total, found over the sources sorted by cap * size / weight.
    Only this table, one row per source, is sorted as a whole.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    src = src.withColumn("weight", w).withColumn("most", cap * F.col("source_size").cast("double"))
    ratio = [F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source")]
    before = Window.orderBy(*ratio).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*ratio).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(*ratio).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((share * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    src = src.withColumn("level", level).withColumn("k", F.row_number().over(Window.orderBy(*ratio)))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("k", "level"))
    src = src.withColumn("level", F.min(fits).over(everything)["level"])  # of the first source that needs no cap
    target = F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return src.select("source", "source_size", target.alias("target"))


def apportion(parties: DataFrame, parent: list[str], key: list[Column], votes: str, seats: str, result: str) -> DataFrame:
    """Sainte-Lague: ``seats`` of each parent group to its parties by highest quotients votes / (2k + 1).

    Exact for any input: the final divisor lies within votes / (seats +- n / 2) of the group
    totals (n parties), so a party's seats are known up to a few quotients, about two a party
    on average, and only those are ranked. Ties go by ``key``. Without votes no seats.
    """
    group = Window.partitionBy(*parent)
    p = (parties.withColumn("_v", F.col(votes).cast("double"))
         .withColumn("_n", F.sum(F.when(F.col("_v") > 0, 1).otherwise(0)).over(group))
         .withColumn("_x", F.col("_v") / F.nullif(F.sum("_v").over(group), F.lit(0.0))))
    seat = F.col(seats).cast("double")
    low = F.greatest(F.lit(0), F.floor((seat - F.col("_n") / 2) * F.col("_x") - 1)).cast("long")
    high = F.greatest(low, F.ceil((seat + F.col("_n") / 2) * F.col("_x") + 1).cast("long"))
    p = p.withColumn("_low", F.coalesce(low, F.lit(0).cast("long"))).withColumn("_high", F.coalesce(high, F.lit(0).cast("long")))
    p = p.withColumn("_left", F.col(seats) - F.sum("_low").over(group))
    ranked = p.withColumn("_k", F.explode_outer(F.when(F.col("_v") > 0, F.sequence("_low", "_high"))))
    by = Window.partitionBy(*parent).orderBy((F.col("_v") / (2 * F.col("_k") + 1)).desc_nulls_last(), *key, "_k")
    won = ranked.withColumn("_won", (F.col("_k").isNotNull() & (F.row_number().over(by) <= F.col("_left"))).cast("long"))
    cols = [c for c in parties.columns]
    return won.groupBy(*cols, "_low").agg(F.sum("_won").alias("_won")).select(*cols, (F.col("_low") + F.col("_won")).alias(result))


def _rank(id_col: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).cast("binary"))


def _shard(rank: Column, shards: Column) -> Column:
    return F.pmod(F.conv(F.substring(rank, 17, 8), 16, 10).cast("long"), shards)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED,
        keep_text: bool = True) -> DataFrame:
    """Documents (input columns of the same names, whatever their case, replaced; all others kept as they are) with size, source_size, target and taken.

    ``taken`` are the words the mix takes from a document, repeats counted: a shard whose blocks hold
    c times its words and r more gives c whole copies of each document, and r words from the documents
    first in the seeded order of their ids (the last of them in part). No document exceeds ``cap`` times
    its size, and a source's taken words lie within a block, plus half a block for each shard whose
    target is its cap, of its target.

    Null or empty texts have size 0 and nothing taken; a null source is a source of its own, last in
    order; null ids rank as the empty text; rows with one id share their place in the order, and the place
    where a shard's blocks end is divided among them in proportion to their sizes; empty tables give
    empty results. Reruns agree: everything depends on ids, sources, sizes and ``seed`` only.
    """
    store = Store(docs.sparkSession, "mix")
    names = ["size", "source_size", "target", "taken"]
    rank = _rank(id_col, seed)
    narrow = store.cut(docs.select(F.col(f"`{source_col}`").alias("source"), rank.alias("rank"),
                                   F.col(f"`{id_col}`").alias("id"), n_words(F.col(f"`{text_col}`")).alias("size")))
    targets = source_targets(narrow, weights, share, cap)
    shards = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / shard_words))
    targets = targets.withColumn("shards", shards)
    quota = (targets.withColumn("all_blocks", F.round(F.sum("target").over(
        Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) / block_words).cast("long"))
        .withColumn("root", F.lit(0)))
    quota = apportion(quota, ["root"], [F.col("source").isNull(), F.col("source")], "target", "all_blocks", "source_blocks")
    plan = store.cut(quota.select("source", "source_size", "target", "shards", "source_blocks"))  # one row per source

    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    places = (narrow.join(plan.select("source", "shards"), same(narrow, plan)).drop(plan["source"])
              .withColumn("shard", _shard(F.col("rank"), F.col("shards")))
              .groupBy("source", "shard", "rank").agg(F.sum("size").alias("size")))
    places = store.cut(places)
    sizes = places.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    sizes = sizes.withColumn("group", F.floor(F.col("shard") / GROUP))
    groups = sizes.groupBy("source", "group").agg(F.sum("shard_size").alias("group_size"))
    groups = groups.join(plan.select("source", "source_blocks"), same(groups, plan)).drop(plan["source"])
    groups = apportion(groups, ["source"], [F.col("group")], "group_size", "source_blocks", "group_blocks")
    sizes = (sizes.alias("s").join(groups.alias("g"), same(sizes, groups) & (sizes["group"] == groups["group"]))
             .select("s.source", "s.group", "s.shard", "s.shard_size", "g.group_blocks"))
    sizes = apportion(sizes, ["source", "group"], [F.col("shard")], "shard_size", "group_blocks", "blocks")
    words = F.least((F.col("blocks") * block_words).cast("long"), F.floor(cap * F.col("shard_size")))
    sizes = (sizes.withColumn("words", words)
             .withColumn("copies", F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.col("shard_size"))).otherwise(0))
             .withColumn("rest", F.col("words") - F.col("copies") * F.col("shard_size")))
    # Where each shard's extra words end: the place whose cumulative size passes ``rest``.
    order = Window.partitionBy("source", "shard").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    ahead = places.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0).cast("long")))
    ends = (ahead.alias("a").join(sizes.alias("s"), same(ahead, sizes) & (ahead["shard"] == sizes["shard"]))
            .filter((F.col("a.before") <= F.col("s.rest")) & (F.col("s.rest") < F.col("a.before") + F.col("a.size")))
            .select("s.source", "s.shard", "s.copies", F.col("a.rank").alias("end_rank"),
                    F.col("a.size").alias("end_size"), (F.col("s.rest") - F.col("a.before")).alias("end_words")))
    ends = store.cut(ends.select(F.col("source").alias("_source"), "shard", "copies", "end_rank", "end_size", "end_words"))

    # The input row travels as one struct, so its columns may have any names.
    if keep_text:
        kept = [c for c in docs.columns if c.lower() not in names]
        row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
        base = docs.select(row.alias("row"), F.col(f"`{source_col}`").alias("_src"), rank.alias("rank"),
                           n_words(F.col(f"`{text_col}`")).alias("size"))
    else:
        kept = [id_col]
        base = narrow.select(F.struct(F.col("id").alias("c0")).alias("row"), F.col("source").alias("_src"), "rank", "size")
    totals = plan.select(F.col("source").alias("_s"), "shards", F.col("source_size").cast("long").alias("source_size"), "target")
    dealt = (base.join(totals, F.col("_src").eqNullSafe(F.col("_s"))).drop("_s")
             .withColumn("_shard", _shard(F.col("rank"), F.col("shards"))).drop("shards"))
    out = dealt.join(ends, F.col("_src").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("shard")), "left")
    extra = (F.when(F.col("rank") < F.col("end_rank"), F.col("size"))
             .when(F.col("rank") == F.col("end_rank"), F.floor(F.col("size") * F.col("end_words") / F.col("end_size")))
             .otherwise(0))
    taken = F.coalesce(F.col("copies") * F.col("size") + extra, F.lit(0)).cast("long")
    return out.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(kept)], "size", "source_size", "target", taken.alias("taken"))
