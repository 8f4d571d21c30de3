import random
import re
import zlib
from collections import Counter

import pytest

from odflow.llm import queries
from odflow.llm import spelling as P
from odflow.store import Store


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k + 1:]


def brute(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [] for w in n}
    by_len = {}
    for w in n:
        by_len.setdefault(len(w), []).append(w)
    for w in n:
        for size in (len(w), len(w) + 1):
            for o in by_len.get(size, []):
                if (len(o) > len(w) or w < o) and one_apart(w, o):
                    near[w].append(o)
                    near[o].append(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form[w] or "", n[form[w]] if form[w] else -1, root(w)) for w in n)


def got(df):
    return sorted((r["word"], r["n"], r["n_near"], r["form"] or "", r["form_n"] or -1, r["root"]) for r in df.collect())


def texts(seed, n=60, letters="abcé"):
    """Few letters, so that grams are frequent and words are near each other."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(150)]
    for w in list(stock):
        k = rng.randrange(len(w))
        stock += [w[:k] + rng.choice(letters) + w[k + rng.randint(0, 1):], w[:k] + w[k + 1:]]
    weights = [2 ** rng.uniform(0, 9) for _ in stock]
    return [(i, " ".join(rng.choices(stock, weights, k=rng.randint(0, 400)))) for i in range(n)]


@pytest.mark.parametrize("frequent", [1, 8, 64])
def test_equals_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(P, "FREQUENT", frequent)
    rows = texts(frequent)
    out = got(P.spelling_forms(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute(rows)
    assert out == want and any(r[3] for r in want) and any(r[5] not in (r[0], r[3]) for r in want)


def test_long_lists_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(P, "_LIST", 3)
    rows = texts(9, letters="ab")
    assert got(P.spelling_forms(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_sides_that_grow_are_not_broadcast(spark):
    """A driver that has no room for a broadcast: only the table of long lists may be one, which is empty here."""
    rows = texts(5)
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1")
    try:
        out = got(P.spelling_forms(spark.createDataFrame(rows, "doc_id long, text string")))
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    want = brute(rows)
    assert out == want and any(r[5] not in (r[0], r[3]) for r in want)


def test_edges(spark):
    long = "abcdé" * 9000
    rows = [(1, None), (2, ""), (None, "Straße straße STRAßE strasse"), (3, " -- 12 ab "), (4, f"{long} {long} {long} x{long} {long}x"), (5, f"x{long} x{long}"),
            (6, "colour colour colour color color color Color color color color"), (6, "colour colour"), (7, "a× ÷÷÷÷÷÷ ÷÷÷÷÷÷ ÷÷÷÷÷÷")]
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    assert got(P.spelling_forms(df)) == brute(rows)
    assert P.spelling_forms(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_bound_holds_for_every_edit(seed):
    """Two words one edit apart share one of their key grams, at the same place or one further."""
    rng = random.Random(seed)
    letters = "abc"
    stock = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(300)]
    counts = Counter(g for w in set(stock) for g in set(P.short_grams(w)))
    frequent = {g for g, c in counts.items() if c > (1, 5, 20, 60)[seed]}
    rarity = P.np.array([rng.randrange(4) for _ in range(P._COUNTERS)])
    for w in stock:
        k, c = rng.randrange(len(w)), rng.choice(letters + "z")
        for other in (w[:k] + c + w[k + 1:], w[:k] + c + w[k:], w + c):
            if other == w:
                continue
            a, b = P.key_grams(w, frequent, rarity), set(P.key_grams(other, frequent, rarity))
            moves = (0,) if len(other) == len(w) else (0, 1)
            assert any((g, p + m) in b for g, p in a for m in moves), (w, other)
            assert len(P.decompose(w, frequent)) - P.affected(P.decompose(w, frequent)) >= 1


def test_frequent_grams_get_longer():
    assert P.decompose("abcde", set()) == ["\x01a", "ab", "bc", "cd", "de", "e\x02"]
    assert P.decompose("abcde", {"ab", "abc", "e\x02"}) == ["\x01a", "abcd", "bc", "cd", "de", "e\x02"]


def test_each_pair_once(spark):
    words = [("crane", 3), ("crone", 3), ("cranes", 3), ("ranes", 3), ("rane", 3)]
    pairs = P.near_words(spark.createDataFrame(words, "word string, n long"), Store(spark, "t")).collect()
    assert sorted(tuple(sorted((r["a"], r["b"]))) for r in pairs) == [("crane", "cranes"), ("crane", "crone"), ("crane", "rane"), ("cranes", "ranes"), ("rane", "ranes")]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op12_spelling_variants(spark, sf)) == brute(rows)
