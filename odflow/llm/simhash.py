"""Near duplicates by SimHash fingerprints, searched with the generalised pigeonhole principle.

1. A text's fingerprint has a bit set when more than half of its shingles' 64-bit hashes have it set. Texts
   with one fingerprint are one class; nothing below sees a copy.
2. The 64 bits are grouped into partitions, strongly correlated bits together, so that crowded values crowd
   few partitions. If thresholds t_i (-1 means: do not look) satisfy sum(t_i + 1) = distance + 1, two
   fingerprints within the distance differ by at most t_i bits in at least one partition i.
3. Every fingerprint chooses its own thresholds by dynamic programming over the partitions; the cost of a threshold is
   the number of values to probe plus the estimated number of candidates there. The whole fingerprint as one
   partition is one of the choices, and its probes meet no false candidate, so no fingerprint costs more than that
   ever so crowded the partitions are.
4. Probes meet the indexed values in a join that keeps pairs within the distance. Links between different
   fingerprints give components; classes and rows follow them.

Candidate counts are estimated from counters of partition halves (as if these were independent) and from exact counts of the
values that hold more than one in ``HOT_VALUES`` fingerprints. Estimates decide where to look, never what is found.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.components import components
from odflow.llm.spread import join_spread
from odflow.llm.textarrays import ASCII_LOWER, slabs
from odflow.store import Store

BITS = 64
#: Fixed value: the seed of the shingles' XXH64.
SEED = 42
#: Values of a partition counted exactly hold more than one in this many fingerprints: at most so many a partition.
HOT_VALUES = 8192
#: Shingles whose bits are unpacked at a time (64 bytes each).
_CHUNK = 1 << 17
_WHOLE = -1


# ------------------------------------------------------------------ fingerprints

def text_hashes(low: bytes, size: int) -> np.ndarray:
    """XXH64 of every ``size``-word shingle of a lower-cased text, repeats included (all words where there are fewer)."""
    words = low.split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lens)
    joined, n = b" ".join(words), max(1, len(words) - size + 1)
    first, last = (ends - lens)[:n].tolist(), (ends - 1)[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last)), dtype=np.uint64, count=n)


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Fingerprint of each run hashes[bounds[i]:bounds[i + 1]]; 0 for an empty run."""
    n = len(bounds) - 1
    counts = np.zeros((n, BITS), dtype=np.int64)
    for a in range(0, len(hashes), _CHUNK):
        part = hashes[a:a + _CHUNK]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owner = np.searchsorted(bounds, np.arange(a, a + len(part)), "right") - 1
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        counts[owner[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    over = 2 * counts > np.diff(bounds)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprint(size: int):
    """Task function: (id, text) -> id, fp."""

    def run(batches):
        for batch in batches:
            for i, j, data, off in slabs(batch.column(1), 1 << 20):
                low = ASCII_LOWER[data].tobytes()
                hashes = [text_hashes(low[a:b], size) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                bounds = np.concatenate(([0], np.cumsum([len(h) for h in hashes]))).astype(np.int64)
                fp = majority(np.concatenate(hashes), bounds)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(fp.view(np.int64))], ["id", "fp"])

    return run


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row; a text without words (null, empty) has fp 0."""
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(_fingerprint(size), "id long, fp long"))


# ------------------------------------------------------------- layout and counters

def _unpacked(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _values(bits: np.ndarray, columns: list[int]) -> np.ndarray:
    """The chosen bits of each fingerprint as one number."""
    out = np.zeros(len(bits), dtype=np.int64)
    for k, c in enumerate(columns):
        out |= bits[:, c].astype(np.int64) << k
    return out


def _totals(keys: DataFrame, count) -> np.ndarray:
    """Sum of ``count(fps) -> int array`` over all batches of fingerprints; one row a task reaches the sum."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = count(batch.column(0).to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], ["c"])

    rows = (keys.select("fp").mapInArrow(run, "c array<bigint>").select(F.posexplode("c").alias("at", "n"))
            .groupBy("at").agg(F.sum("n").alias("n")).collect())  # one row per counter
    out = np.zeros(max((r["at"] for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        out[r["at"]] = r["n"]
    return out


def _together(fps: np.ndarray) -> np.ndarray:
    bits = _unpacked(fps).astype(np.float64)
    return (bits.T @ bits).astype(np.int64).ravel()


def group_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Partitions of near equal width; each starts with the most correlated bit left and takes the bits most correlated with it.

    ``together`` counts the fingerprints that have both bits of a pair set.
    """
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(p * (1 - p))
    rho = np.abs(cov / np.maximum(np.outer(sd, sd), 1e-9))
    np.fill_diagonal(rho, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        at = rho[np.ix_(left, left)]
        group = [left[int(at.sum(axis=1).argmax())]]
        while len(group) < width:
            rest = [b for b in left if b not in group]
            group.append(rest[int(rho[np.ix_(rest, group)].mean(axis=1).argmax())])
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def _halves(columns: list[int]) -> list[list[int]]:
    """A partition's bits in runs of at most 11, the units of the candidate counters."""
    n = -(-len(columns) // 11)
    return [columns[len(columns) * k // n:len(columns) * (k + 1) // n] for k in range(n)]


def _at_distance(counts: np.ndarray, far: int) -> np.ndarray:
    """For each value the number of fingerprints whose value differs in exactly 0, 1, ..., ``far`` bits."""
    width = int(len(counts)).bit_length() - 1
    every = np.arange(len(counts))
    out = [counts.astype(np.float64)]
    for d in range(1, far + 1):
        near = sum(out[d - 1][every ^ (1 << b)] for b in range(width)) if width else np.zeros(len(counts))
        again = (width - d + 2) * out[d - 2] if d >= 2 else 0.0
        out.append((near - again) / d)
    return np.stack(out)


# ------------------------------------------------------------------- thresholds

def probes(width: int, threshold: int) -> int:
    """Values within ``threshold`` bits of a value."""
    return sum(math.comb(width, d) for d in range(threshold + 1))


def allocate(costs: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of least cost: ``costs[i, k]`` (rows on the last axis) is the cost of threshold k - 1 in partition i, k = 0 ... distance + 1.

    Returns (thresholds of shape (partitions, rows), cost); the thresholds satisfy sum(t + 1) = distance + 1.
    """
    parts, kinds, n = costs.shape
    best = np.full((distance + 2, n), np.inf)
    best[0] = 0
    picks = []
    for i in range(parts):
        after, pick = np.full_like(best, np.inf), np.zeros(best.shape, dtype=np.int8)
        for s in range(distance + 2):
            for k in range(min(s, kinds - 1) + 1):
                c = best[s - k] + costs[i, k]
                better = c < after[s]
                after[s][better], pick[s][better] = c[better], k
        best = after
        picks.append(pick)
    out, s, rows = np.zeros((parts, n), dtype=np.int64), np.full(n, distance + 1), np.arange(n)
    for i in range(parts - 1, -1, -1):
        k = picks[i][s, rows].astype(np.int64)
        out[i] = k - 1
        s = s - k
    return out, best[distance + 1]


def partitions_for(n: int, distance: int) -> int:
    """Number of partitions that costs least for ``n`` fingerprints spread evenly."""
    def cost(parts: int) -> float:
        width = BITS / parts
        one = [0.0] + [probes(int(width), t) * (1 + n / 2.0 ** width) for t in range(distance + 1)]
        return float(allocate(np.array([one] * parts)[:, :, None], distance)[1][0])

    return min(range(1, distance + 2), key=cost)


def _masks(width: int, threshold: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for d in range(threshold + 1) for c in combinations(range(width), d)], dtype=np.uint64).view(np.int64)


def _probe(shared, distance: int):
    """Task function: fp -> the (part, value, fp) to look up."""

    def run(batches):
        layout, near, hot, n = shared.value
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for a in range(0, len(fps), 4096):
                yield from probe(fps[a:a + 4096], layout, near, hot, n)

    def probe(fps, layout, near, hot, n):
        bits = _unpacked(fps)
        values = [_values(bits, columns) for columns in layout]
        costs = np.zeros((len(layout), distance + 2, len(fps)))
        for i, columns in enumerate(layout):
            expect = None  # expected number of fingerprints at each exact distance
            for half, table in zip(_halves(columns), near[i]):
                d = table[:, _values(bits, half)]
                if expect is None:
                    expect = d
                else:
                    expect = np.stack([sum(expect[x] * d[k - x] for x in range(k + 1)) / n for k in range(distance + 1)])
            known, counts = hot[i]
            at = np.searchsorted(known, values[i]).clip(max=max(len(known) - 1, 0))
            exact = np.where(known[at] == values[i], counts[at], 0) if len(known) else np.zeros(len(fps))
            within = np.maximum(np.cumsum(expect, axis=0), exact)
            for t in range(distance + 1):
                costs[i, t + 1] = probes(len(columns), t) + within[t]
        chosen, cost = allocate(costs, distance)
        whole = cost > probes(BITS, distance)
        out = []
        for i, columns in enumerate(layout):
            for t in range(distance + 1):
                rows = np.flatnonzero((chosen[i] == t) & ~whole)
                out.append((i, rows, values[i], _masks(len(columns), t)))
        out.append((_WHOLE, np.flatnonzero(whole), fps, _masks(BITS, distance)))
        for part, rows, value, masks in out:
            for a in range(0, len(rows), 256):
                some = rows[a:a + 256]
                keys = (value[some][:, None] ^ masks[None, :]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), part, dtype=np.int32)), pa.array(keys), pa.array(np.repeat(fps[some], len(masks)))],
                    ["part", "value", "fp"])

    return run


def _index(layout):
    """Task function: fp -> its (part, value, fp), and itself as the value of the whole."""

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy()
            bits = _unpacked(fps)
            for part, value in [*((i, _values(bits, c)) for i, c in enumerate(layout)), (_WHOLE, fps)]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fps), part, dtype=np.int32)), pa.array(value), pa.array(fps)], ["part", "value", "fp"])

    return run


# ------------------------------------------------------------------------- search

def links(keys: DataFrame, distance: int, store: Store) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct fingerprints ``keys.fp`` that differ in 1 to ``distance`` bits."""
    spark = keys.sparkSession
    n = keys.count()
    schema = "part int, value long, fp long"
    if n < 2:
        return keys.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    parts = partitions_for(n, distance)
    layout = group_bits(_totals(keys, _together).reshape(BITS, BITS), n, parts)
    units = [half for columns in layout for half in _halves(columns)]

    def tally(fps):
        bits = _unpacked(fps)
        return np.concatenate([np.bincount(_values(bits, u), minlength=1 << len(u)) for u in units])

    flat, at, near = _totals(keys, tally), 0, []
    flat = np.concatenate([flat, np.zeros(sum(1 << len(u) for u in units) - len(flat), dtype=np.int64)])
    for columns in layout:
        tables = []
        for half in _halves(columns):
            tables.append(_at_distance(flat[at:at + (1 << len(half))], distance))
            at += 1 << len(half)
        near.append(tables)
    index = store.cut(keys.select("fp").mapInArrow(_index(layout), schema))
    crowd = max(probes(BITS, distance), n // HOT_VALUES)
    crowded = index.filter(F.col("part") >= 0).groupBy("part", "value").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > crowd)
    top = crowded.collect()  # at most HOT_VALUES a partition
    hot = []
    for i in range(parts):
        own = sorted((r["value"], r["c"]) for r in top if r["part"] == i)
        hot.append((np.array([v for v, _ in own], dtype=np.int64), np.array([c for _, c in own], dtype=np.float64)))
    shared = spark.sparkContext.broadcast((layout, near, hot, n))
    # A crowded value is dealt to several tasks by a salt; its probes, few by choice of the thresholds, go to all of them.
    salts = F.broadcast(spark.createDataFrame([(r["part"], r["value"], -(-r["c"] // crowd)) for r in top], "part int, value long, salts long"))
    dealt = index.join(salts, ["part", "value"], "left").select(
        "part", "value", F.pmod(F.xxhash64("fp"), F.coalesce("salts", F.lit(1))).alias("salt"), F.col("fp").alias("b"))
    asked = keys.select("fp").mapInArrow(_probe(shared, distance), schema).join(salts, ["part", "value"], "left").select(
        "part", "value", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"), F.col("fp").alias("a"))
    found = asked.join(dealt, ["part", "value", "salt"]).filter(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
    out = store.cut(found.select("a", "b").distinct())
    store.drop(index)
    return out


def simhash_groups(docs: DataFrame, size: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) of every row.

    Words lie between white space and are lower-cased (A-Z); shingles are ``size`` words joined by one space, repeats included
    (the whole sequence where there are fewer words). Rows whose fingerprints differ in at most ``distance`` bits are
    linked; component_id is the smallest id reachable, the own one included.

    Null, empty and word-less texts have fingerprint 0 and are linked like any other. A null id is in no component: it
    gets its fingerprint and a null component_id. Rows that share an id share a component; repeated rows each get their
    row. Other columns are not returned; an empty table gives an empty result.
    """
    store = Store(docs.sparkSession, "simhash")
    rows = store.cut(fingerprints(docs, size, id_col, text_col))
    named = rows.filter("id is not null")
    classes = store.cut(named.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")))
    shared = named.groupBy("id").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a < z").select("id", "a")
    same_id = named.join(shared, "id").select("a", F.col("fp").alias("b")).filter("a <> b")
    comps = components(links(classes, distance, store).union(same_id), store)
    rooted = store.cut(classes.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", "n", F.coalesce("component", "fp").alias("root")))
    roots = store.cut(rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("members")))
    of_class = store.cut(join_spread(rooted, roots, "root", "members", rooted.count()).select("fp", "n", "component_id"))
    out = join_spread(named, of_class, "fp", "n", named.count()).select("id", "fp", "component_id")
    return out.unionByName(rows.filter("id is null").withColumn("component_id", F.lit(None).cast("long")))
