import random
import re

import numpy as np
import pytest
from texts import corpus, words

from odflow.llm import near_duplicates as N
from odflow.llm import superminhash as M
from odflow.llm import textarrays as X


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(rows, size):
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(((i, len(s), find(i) if i is not None else None, i is None or find(i) == i) for i, s in sets), key=str)


def got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "kept")) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [2, 5])
def test_brute_force(spark, size):
    rows = corpus(size, 30)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(N.near_duplicates(df, size)) == brute(rows, size)


def test_cloud_of_near_copies(spark, monkeypatch):
    """Copies of one text, each changed at random places so that many pairs lie just below the limit; small blocks."""
    rng = random.Random(5)
    base, rows = words(rng, 60), []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(N, "BLOCK", 7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(N.near_duplicates(df, 2)) == brute(rows, 2)


def test_edges(spark):
    rows = [(5, "same text here now again"), (5, "other words in this row today"), (2, "other words in this row today"),
            (None, "same text here now again"), (7, None), (8, ""), (9, "same text here now again"), (9, "same text here now again")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_shingles int")
    assert got(N.near_duplicates(df, 2)) == sorted([
        (5, 4, 2, False), (5, 5, 2, False), (2, 5, 2, True), (None, 4, None, True), (7, 0, 7, True), (8, 0, 8, True),
        (9, 4, 2, False), (9, 4, 2, False)], key=str)
    assert N.near_duplicates(df.limit(0), 2).count() == 0
    kept = N.drop_near_duplicates(df, 2)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "7", "8", "None"]


def test_signatures_equal_the_definition():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 60, 400):
        sets = [rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, 3, dtype=np.uint64)]
        got = M.signatures(np.concatenate(sets), np.array([0, n, n + 3]), 24)
        for own, row in zip(sets, got):
            want = [2**64 - 1] * 24
            for e in own:
                p = list(range(24))
                for j in range(24):
                    value, at = (int(x[0]) for x in M._draws(np.array([e], dtype=np.uint64), j))
                    k = j + (at * (24 - j) >> 32)
                    p[j], p[k] = p[k], p[j]
                    want[p[j]] = min(want[p[j]], j << 32 | value)
            assert row.tolist() == want


def test_words_of_slabs():
    import pyarrow as pa
    rng = random.Random(2)
    texts = ["".join(rng.choice("aB é\n\t中 ") for _ in range(rng.randint(0, 30))) for _ in range(200)] + [None, ""]
    for limit in (1, 50, 10**6):
        seen = []
        for _, _, data, off in X.slabs(pa.array(texts), limit):
            starts, ends, at = X.word_spans(data, off, X.NOT_SPACE)
            h = X.word_hashes(data, starts, ends)
            for a, b in zip(at[:-1], at[1:]):
                seen.append([bytes(data[s:e]).decode() for s, e in zip(starts[a:b], ends[a:b])])
                assert len(set(h[a:b].tolist())) == len(set(seen[-1]))
        assert seen == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_row_that_stays_of_a_shared_id_does_not_depend_on_the_order_of_rows(spark):
    rows = [(i, f"text {k} of its own {i}", s) for i in range(12) for k in "cab" for s in "yx"] + [(20, None, "y"), (20, "z", "x")]
    want = sorted([(i, f"text a of its own {i}", "x") for i in range(12)] + [(20, None, "y")])
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, source string").coalesce(1)
        assert sorted(map(tuple, N.drop_near_duplicates(df, 2).collect())) == want
