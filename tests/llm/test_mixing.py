import random
from collections import Counter

from odflow.llm.mixing import apportion, mix


def targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(capped.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > cap * sizes[s]]
        if not over:
            return {s: capped.get(s, level * weight[s]) for s in order}
        capped.update({s: cap * sizes[s] for s in over})


def rows(seed):
    rng = random.Random(seed)
    out = []
    for i in range(300):
        s = rng.choice(["a", "a", "a", "é", "B", "z", "b", None, "tiny"] if i % 50 == 0 else ["a", "a", "a", "é", "B", "z", None])
        n = 0 if s == "tiny" and i % 2 else rng.choice([0, 1, 3, 30, 200])
        out.append((i, s, " ".join(["w"] * n) if n or i % 2 else None))
    return out


def check(df, data, **kw):
    got = df.collect()
    size = {i: len((t or "").split()) for i, _, t in data}
    by = Counter()
    for _, s, t in data:
        by[s] += len((t or "").split())
    want, taken = targets(by), Counter()
    src = {i: s for i, s, _ in data}
    assert len(got) == len(data)
    for r in got:
        s = src[r.doc_id]
        assert r["size"] == size[r.doc_id] and r.source_size == by[s] and abs(r.target - want[s]) <= 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    return want, taken, by, got


def test_targets_and_taken(spark):
    data = rows(3)
    df = spark.createDataFrame(data, "doc_id long, source string, text string")
    want, taken, by, got = check(mix(df), data)
    assert all(abs(taken[s] - want[s]) <= 16 for s in by)
    want, taken, by, again = check(mix(df.repartition(5), shard_words=900, block_words=4, keep_text=False), data)
    assert all(abs(taken[s] - want[s]) <= 4 + 2 * (by[s] // 900 + 1) for s in by)
    one = {r.doc_id: r.taken for r in mix(df.repartition(3)).collect()}
    assert one == {r.doc_id: r.taken for r in got}


def test_edges(spark):
    df = spark.createDataFrame([(1, "s", "a b c", 9)] * 3 + [(None, "s", "a b", 9), (2, None, None, 9)],
                               "doc_id long, source string, text string, size int")
    got = mix(df, block_words=1)
    assert got.columns == ["doc_id", "source", "text", "size", "source_size", "target", "taken"]
    out = got.collect()
    assert len(out) == 5 and {r.source_size for r in out if r.source == "s"} == {11}
    assert all(r.taken <= 2 * r["size"] for r in out)
    assert mix(df.limit(0)).count() == 0


def test_apportionment_is_by_highest_quotients(spark):
    rng = random.Random(8)
    parties = [(g, k, v) for g in range(6) for k in range(rng.randint(1, 12)) for v in [rng.choice([0, 1, 1, 2, 5, 50, 1000])]]
    seats = {g: rng.choice([0, 1, 3, 10, 200]) for g in range(6)}
    want = {}
    for g in range(6):
        own = [(k, v) for h, k, v in parties if h == g]
        won = Counter()
        if any(v for _, v in own):
            for _ in range(seats[g]):
                won[max(own, key=lambda p: (p[1] / (2 * won[p[0]] + 1), -p[0]))[0]] += 1
        want |= {(g, k): won[k] for k, _ in own}
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(g, k, v, seats[g]) for g, k, v in parties], "g int, k int, v long, s long")
    got = {(r.g, r.k): r.q for r in apportion(df, ["g"], [F.col("k")], "v", "s", "q").collect()}
    assert got == want


def test_any_extra_column_names(spark):
    data = rows(5)
    plain = spark.createDataFrame(data, "doc_id int, source string, text string")
    clash = ["rank", "shard", "shards", "copies", "end_rank", "end_size", "end_words", "row", "id", "group", "a.b", "_s", "_src", "_source",
             "_shard", "c0", "Size", "target", "taken", "source_size"]
    wide = plain.selectExpr("*", *[f"{k} as `{c}`" for k, c in enumerate(clash)])
    out = mix(wide, shard_words=500)
    kept = [c for c in clash if c.lower() not in ("size", "target", "taken", "source_size")]
    assert out.columns == ["doc_id", "source", "text", *kept, "size", "source_size", "target", "taken"]
    got = {r["doc_id"]: r for r in out.collect()}
    want = {r["doc_id"]: r for r in mix(plain, shard_words=500).collect()}
    assert {i: (r["size"], r["target"], r["taken"]) for i, r in got.items()} == {i: (r["size"], r["target"], r["taken"]) for i, r in want.items()}
    assert all(r[c] == clash.index(c) for r in got.values() for c in kept)
