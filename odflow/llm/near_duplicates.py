"""Near duplicates: SuperMinHash signatures, banding, verification on full sets, components.

1. Every text gets its set of word shingles, a 128-bit fingerprint of the set and a signature, where it lies.
   Texts with equal sets are one class and are stood for by the smallest id; nothing below sees a copy.
2. The signature's bands deal the classes into buckets. Within a bucket every class is paired with
   the smallest one only (so a bucket of any size gives as many pairs as it has members), and each pair is verified on
   the full sets, which are made anew for the documents concerned.
3. Verified pairs give components. In buckets whose members are still in several components, the members outside the
   largest one are compared with all members in blocks: first by signature, which keeps the members of promising
   pairs, then those on their full sets, so every promising pair across components is decided and only links
   come out, one for a member and another component. No step emits pairs in the square of a bucket's size.

A pair at the similarity limit shares no band with a probability of (1 - s**rows)**bands (3e-6 at s = 0.8).
A pair at the limit has an estimate below ``LEAST_ESTIMATE`` with a probability of 7e-5, falling fast above the limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.components import components
from odflow.store import Store
from odflow.llm.superminhash import signatures
from odflow.llm.textarrays import mix, shingle_sets, slabs
from odflow.llm.workers import tidy

BANDS, ROWS = 32, 5
PLACES = BANDS * ROWS
LEAST_ESTIMATE = 0.68
#: Members of a bucket that are compared in one block.
BLOCK = 512
_SALTS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0676A9A99))


def _fingerprints(elements: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over independently mixed elements, per set."""
    out = []
    for salt in _SALTS:
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(elements ^ salt), dtype=np.uint64)))
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out


def _sign(size: int):
    """Task function: (id, text) -> id, size of the set, fingerprint, signature as 16-bit values."""

    def run(batches):
        for batch in batches:
            parts = []
            for i, j, data, off in slabs(batch.column(1), 1 << 20):
                elements, bounds = shingle_sets(data, off, size)
                sig = (signatures(elements, bounds, PLACES) & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)
                f1, f2 = _fingerprints(elements, bounds)
                parts.append((np.diff(bounds), f1, f2, sig))
            if not parts:
                continue
            n, f1, f2, sig = (np.concatenate(x) for x in zip(*parts))
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(0, len(sig) + 1, dtype=np.int32) * PLACES), pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(f1), pa.array(f2), arrays],
                                             ["id", "n", "f1", "f2", "sig"])

    return run


def _sets(size: int):
    """Task function: (id, text) -> id, set."""

    def run(batches):
        for batch in batches:
            for i, j, data, off in slabs(batch.column(1), 1 << 20):
                elements, bounds = shingle_sets(data, off, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(elements.view(np.int64)))], ["id", "words"])

    return run


def _promising(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in enough places."""
    one, two = signs.select(F.col("rep").alias("a"), F.col("sig").alias("x")), signs.select(F.col("rep").alias("b"), F.col("sig").alias("y"))
    equal = F.aggregate(F.zip_with("x", "y", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, e: n + e)
    return pairs.join(one, "a").join(two, "b").filter(equal >= _least()).select("a", "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs whose sets share at least ``percent`` percent of their union."""
    common = F.size(F.array_intersect("x", "y"))
    return (pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
            .filter(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b").distinct())


def _least() -> int:
    return int(np.ceil(LEAST_ESTIMATE * PLACES))


_CELL = ["band", "key", "sb", "mb"]


def _cells(work, fields: list[str], types: list[pa.DataType]):
    """Task function on rows sorted by cell: ``work`` gets the table of one cell and yields result rows."""

    def flush(t):
        out = list(work(t))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(types)], fields)

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            keys = np.stack([t[c].to_numpy() for c in _CELL])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            for a, b in zip(edges[:-1], edges[1:]):
                yield flush(t.slice(a, b - a))
            held = t.slice(edges[-1])
        if held is not None:
            yield flush(held)

    return run


def _agreeing(t: pa.Table):
    """Chunks of (members outside, members, agreeing places) of a cell. Only pairs of different components count, and each
    pair only in the first band whose bucket it shares; other pairs have 0."""
    side, comp = t["side"].to_numpy(), t["comp"].to_numpy()
    sig = t["sig"].combine_chunks().flatten().to_numpy().reshape(-1, PLACES)
    s, m, band = np.flatnonzero(side == 0), np.flatnonzero(side == 1), int(t["band"][0].as_py())
    for a in range(0, len(s), 16):
        some = s[a:a + 16]
        for b in range(0, len(m), 256):
            part = m[b:b + 256]
            equal = sig[some][:, None, :] == sig[part][None, :, :]
            n = equal.sum(axis=2)
            earlier = equal[:, :, :band * ROWS].reshape(len(some), len(part), band, ROWS).all(axis=3).any(axis=2)
            n[earlier | (comp[some][:, None] == comp[part][None, :]) | (n < _least())] = 0
            yield some, part, n


def _with_partner(t: pa.Table):
    """(band, key, sb, mb, side, rep) of a cell's rows that are in a promising pair."""
    wanted = np.zeros(t.num_rows, dtype=bool)
    for some, part, n in _agreeing(t):
        wanted[some] |= n.any(axis=1)
        wanted[part] |= n.any(axis=0)
    rows = t.select([*_CELL, "side", "rep"]).filter(pa.array(wanted)).to_pydict()
    yield from zip(*rows.values())


def _linked(percent: int):
    """(a, b) links found in a cell: the promising pairs on their full sets, the most similar first, leaving out
    pairs of components that a link of this cell has joined already."""

    def work(t: pa.Table):
        rep, comp = t["rep"].to_numpy(), t["comp"].to_numpy().copy()
        words = t["words"].combine_chunks()
        off, flat = words.offsets.to_numpy(), words.values.to_numpy()
        found = []
        for some, part, n in _agreeing(t):
            i, j = np.nonzero(n)
            found += zip((-n[i, j]).tolist(), some[i].tolist(), part[j].tolist())
        for _, i, j in sorted(found):
            if comp[i] == comp[j]:
                continue
            x, y = flat[off[i]:off[i + 1]], flat[off[j]:off[j + 1]]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            both = np.concatenate((x, y))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            if 100 * common >= percent * (len(x) + len(y) - common):
                yield int(rep[i]), int(rep[j])
                comp[comp == comp[j]] = comp[i]

    return work


def _block(rep: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(rep), blocks)


def _links_across(members: DataFrame, signs: DataFrame, sets: DataFrame, comps: DataFrame, percent: int, store: Store) -> DataFrame:
    """Links between different components within the buckets of ``members`` (band, key, rep)."""
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of = members.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "band", "key", "rep", F.coalesce("component", "rep").alias("comp"))
    sizes = of.groupBy("band", "key", "comp").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("band", "key").agg(F.sum("c").alias("n"), F.max(F.struct("c", "comp")).alias("top")).filter("top.c < n")
    of = of.join(largest.select("band", "key", "n", F.col("top.c").alias("c"), F.col("top.comp").alias("top")), ["band", "key"])
    few, all_blocks = F.ceil((F.col("n") - F.col("c")) / BLOCK), F.ceil(F.col("n") / BLOCK)
    rest = of.filter("comp <> top").select("band", "key", "rep", "comp", F.lit(0).alias("side"), _block(F.col("rep"), few).alias("sb"),
                                           F.explode(F.sequence(F.lit(0).cast("long"), all_blocks - 1)).alias("mb"))
    every = of.select("band", "key", "rep", "comp", F.lit(1).alias("side"),
                      F.explode(F.sequence(F.lit(0).cast("long"), few - 1)).alias("sb"), _block(F.col("rep"), all_blocks).alias("mb"))
    grid = store.cut(rest.unionByName(every))

    def in_cells(df: DataFrame) -> DataFrame:
        return df.repartition(partitions, *_CELL).sortWithinPartitions(*_CELL)

    whole = in_cells(grid.join(signs, "rep")).select(*_CELL, "rep", "comp", "side", "sig")
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    chosen = store.cut(whole.mapInArrow(tidy(_cells(_with_partner, [*_CELL, "side", "rep"], kinds)),
                                        "band int, key long, sb long, mb long, side int, rep long"))
    full = in_cells(chosen.join(grid, [*_CELL, "side", "rep"]).join(signs, "rep").join(sets.withColumnRenamed("id", "rep"), "rep"))
    return full.select(*_CELL, "rep", "comp", "side", "sig", "words").mapInArrow(
        tidy(_cells(_linked(percent), ["a", "b"], [pa.int64(), pa.int64()])), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every document.

    Documents are linked when their sets of distinct ``size``-word shingles (lower-cased A-Z; all words as
    one shingle where there are fewer) share at least ``percent`` percent of their union. component_id is the smallest
    id reachable over links, kept whether it is the document's own. ``percent`` from 80 on; lower limits need other bands.

    Null, empty and word-less texts have n_shingles 0 and no links. A null id cannot be linked: its component is
    null and it is kept. Repeated rows each get their row; rows that share an id share a component.
    Other columns are not returned; an empty table gives an empty result.
    """
    if percent < 80:
        raise ValueError("bands are laid out for limits of 80 percent and more")
    spark = docs.sparkSession
    store = Store(spark, "near_duplicates")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = store.cut(texts.mapInArrow(tidy(_sign(size)), "id long, n long, f1 long, f2 long, sig array<smallint>"))
    linkable = signed.filter("n > 0 and id is not null")
    classes = linkable.groupBy("f1", "f2").agg(F.min("id").alias("rep"))
    rows = store.cut(linkable.select("id", "n", "f1", "f2").join(classes, ["f1", "f2"]).select("id", "n", "rep", "f1", "f2"))
    # Sets of fewer than 4 shingles are only linked to equal ones: 3 of 4 are 75 percent.
    lead = rows.filter("id = rep").select("id", "f1", "f2")  # met by id, so copies do not gather in one task
    wide = linkable.filter("n >= 4").join(lead, ["id", "f1", "f2"], "left_semi")
    signs = store.cut(wide.select(F.col("id").alias("rep"), "n", "f1", "f2", "sig").dropDuplicates(["rep", "f1", "f2"]))
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.slice("sig", k * ROWS + 1, ROWS)))
    keys = signs.select("rep", "n", F.posexplode(bands).alias("band", "key"))
    buckets = keys.groupBy("band", "key").agg(F.min(F.struct("rep", "n")).alias("low"), F.count("*").alias("c")).filter("c > 1")
    members = store.cut(keys.join(buckets, ["band", "key"]).select("band", "key", "rep", "n", "c", "low"))
    star = (members.filter("rep > low.rep and 100 * least(n, low.n) >= %d * greatest(n, low.n)" % percent)
            .select(F.col("low.rep").alias("a"), F.col("rep").alias("b")).distinct())
    plain = signs.select("rep", "sig")
    star = store.cut(_promising(star, plain))
    large = members.filter("c > 2").select("band", "key", "rep")
    ids = star.select(F.col("a").alias("id")).union(star.select("b")).union(large.select("rep")).distinct()
    sets = store.cut(texts.join(ids, "id", "left_semi").select("id", "text").mapInArrow(tidy(_sets(size)), "id long, words array<bigint>"))
    shared = rows.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z").select("id", "a")
    edges = _verified(star, sets, percent).union(rows.join(shared, "id").select("a", F.col("rep").alias("b")).filter("a <> b"))
    comps = components(edges, store)
    across = _links_across(large, plain, sets, comps, percent, store)
    comps = components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).union(across), store)
    out = rows.select("id", "n", "rep").join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "id", "n", F.coalesce("component", "rep").alias("component_id"))
    alone = signed.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    return out.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                                         F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id, with the columns of ``docs``.

    Rows that share an id are one document: the one whose text, then whose other columns as JSON, come first stays. Rows with
    a null id all stay.
    """
    kept = near_duplicates(docs, size, percent, id_col, text_col).filter(F.col("kept") & F.col(id_col).isNotNull())
    ids = kept.select(F.col(id_col).alias("_kept")).distinct()
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (id_col, text_col)]
    order = F.struct(F.col(f"`{text_col}`"), F.to_json(F.struct(*rest, F.lit(0).alias("_"))))
    once = (docs.join(ids, F.col(f"`{id_col}`").cast("long") == F.col("_kept"), "left_semi")
            .groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias("_row")))
    return once.select("_row.*").unionByName(docs.filter(F.col(f"`{id_col}`").isNull()))
