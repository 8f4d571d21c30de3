import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from texts import corpus, words

from odflow.llm import queries
from odflow.llm import simhash as S
from odflow.store import Store


def fingerprint(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, distance=2):
    """(id, fingerprint, component) by comparing all pairs."""
    fps = [(i, fingerprint(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(fps):
        for j, b in fps[:k]:
            if i is not None and j is not None and (a ^ b).bit_count() <= distance:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(((i, f"{f:016x}", find(i) if i is not None else None) for i, f in fps), key=str)


def got(df):
    out = df.select("id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id")
    return sorted((tuple(r) for r in out.collect()), key=str)


def near_rows(seed=3):
    """Long texts with few changes, whose fingerprints differ in few bits."""
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        base = words(rng, 400)
        for _ in range(6):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "x"
            rows.append(" ".join(w))
    return [(i + 1000, t) for i, t in enumerate(rows)]


def test_equals_brute_force(spark):
    rows = corpus(n=30) + near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert got(S.simhash_groups(df)) == want
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})  # links between different fingerprints


def test_edges(spark):
    rows = [(None, "a b c d"), (None, ""), (7, None), (5, ""), (9, " \t\n"), (4, "a b c d"), (4, "A B C  D"), (6, "one two three four five six"),
            (6, "quite other words stand here now"), (3, "quite other words stand here now"), (8, "é" * 50000 + " ß " + "x " * 20000)]
    df = spark.createDataFrame([(f"{i}", t, i, "q") for i, t in rows], "fp string, text string, doc_id long, component_id string")
    out = {(r["id"], r["fp"]): r["component_id"] for r in S.simhash_groups(df).collect()}
    assert len(S.simhash_groups(df).collect()) == len(rows)
    assert out[(7, 0)] == out[(5, 0)] == out[(9, 0)] == 5 and out[(None, 0)] is None
    assert {c for (i, _), c in out.items() if i in (3, 6)} == {3}  # rows of one id share a component
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_groups(empty).collect() == []


def test_hash_is_sparks(spark):
    r = spark.createDataFrame([("one two three",)], "t string").select(F.xxhash64("t")).first()[0]
    assert S.text_hashes(b"one two three", 3).view(np.int64)[0] == r


def test_thresholds_cover_every_pair():
    """Whatever thresholds the costs lead to, a pair within the distance differs little enough in one partition."""
    rng = np.random.default_rng(1)
    for parts, distance in ((3, 2), (4, 2), (2, 2), (2, 1), (4, 3), (1, 2)):
        layout = [list(range(64 * k // parts, 64 * (k + 1) // parts)) for k in range(parts)]
        costs = np.zeros((parts, distance + 2, 200))
        costs[:, 1:] = np.cumsum(rng.random((parts, distance + 1, 200)) ** 4, axis=1)
        chosen, cost = S.allocate(costs, distance)
        assert ((chosen + 1).sum(axis=0) == distance + 1).all()
        assert np.allclose(cost, sum(costs[i, chosen[i] + 1, np.arange(200)] for i in range(parts)))
        for k in range(200):
            flips = rng.choice(64, distance, replace=False)
            per = [len(set(flips.tolist()) & set(c)) for c in layout]
            assert any(p <= t for p, t in zip(per, chosen[:, k]))


def test_allocation_is_least_cost():
    costs = np.zeros((3, 4, 1))
    costs[:, 1:, 0] = [[5, 6, 7], [100, 200, 300], [4, 50, 60]]
    chosen, cost = S.allocate(costs, 2)
    assert chosen[:, 0].tolist() == [2, -1, -1] and cost[0] == 7


def test_counts_at_distances():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 32, 300)
    table = S._at_distance(np.bincount(values, minlength=32), 2)
    for a in range(32):
        near = [int(x).bit_count() for x in values ^ a]
        assert [near.count(d) for d in range(3)] == table[:, a].tolist()


def test_crowded_values_are_split_and_found(spark):
    """Fingerprints that all agree in 58 bits: every partition is crowded, all links are found, and nobody looks at more than the whole costs."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(0, 64, 3), rng.randint(0, 4))) for _ in range(3000)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    keys = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {tuple(r) for r in S.links(keys, 2, Store(spark, "t")).collect()}
    x = np.array(fps, dtype=np.uint64)
    d = np.bitwise_count(x[:, None] ^ x[None, :])
    want = {(min(signed[i], signed[j]), max(signed[i], signed[j])) for i, j in zip(*np.nonzero(d <= 2)) if i < j}
    assert found == want


def test_layout_groups_correlated_bits():
    rng = np.random.default_rng(4)
    common = rng.integers(0, 2, 4000)
    bits = rng.integers(0, 2, (4000, 64)).astype(np.uint8)
    tied = list(range(0, 60, 6))
    bits[:, tied] = common[:, None]
    fps = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    groups = S.group_bits(S._together(fps).reshape(64, 64), 4000, 3)
    assert sorted(sum(groups, [])) == list(range(64)) and any(set(tied) <= set(g) for g in groups)


@pytest.mark.parametrize("n, parts", [(10, 3), (1_000_000, 3), (10**9, 2), (10**13, 1)])
def test_partitions_follow_the_number(n, parts):
    assert S.partitions_for(n, 2) == parts


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = [tuple(r) for r in queries.op11_simhash_groups(spark, sf).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(out, key=str) == brute(rows)
