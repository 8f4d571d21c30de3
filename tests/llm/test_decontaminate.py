import hashlib
import random
import re

from texts import words

from odflow.llm.decontaminate import contamination, remove_contaminated


def item_words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, bench, size):
    windows = {}
    for item, text in bench:
        w = item_words(text)
        if item is not None and w:
            n = min(size, len(w))
            for p in range(len(w) - n + 1):
                windows.setdefault(tuple(w[p:p + n]), set()).add(str(item))
    out = []
    for i, text in docs:
        w, hit, items = item_words(text), set(), set()
        for win, own in windows.items():
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p:p + len(win)]) == win:
                    hit |= set(range(p, p + len(win)))
                    items |= own
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def tables(spark):
    rng = random.Random(4)
    bench = [(i, " ".join(words(rng, n))) for i, n in enumerate([30, 12, 10, 9, 4, 1, 25])] + [(7, None), (8, ""), (None, "zz yy xx"), (10, "Çé 1,2;X")]
    bench[6] = (6, bench[0][1][:80] + " tail of its own")
    docs = []
    for i in range(30):
        w = words(rng, rng.randint(0, 60))
        if i % 2:
            part = item_words(bench[rng.randrange(7)][1])
            w[rng.randint(0, len(w)):0] = [x.upper() if rng.random() < 0.3 else x for x in part[rng.randrange(3):]]
        docs.append((i, (", " if i % 3 else "\n").join(w)))
    docs += [(30, None), (31, ""), (31, ""), (32, "çé 1 2 x Çé! 1/2.X"), (None, bench[0][1])]
    return docs, bench, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")


def got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in df.collect()), key=str)


def test_brute_force_in_one_and_more_parts(spark):
    docs, bench, d, b = tables(spark)
    want = brute(docs, bench, 10)
    assert got(contamination(d, b)) == want
    assert got(contamination(d, b, part_windows=15)) == want


def test_edges(spark):
    docs, bench, d, b = tables(spark)
    assert contamination(d.limit(0), b).count() == 0
    assert {r.contaminated for r in contamination(d, b.limit(0)).collect()} == {False}
    clash = d.selectExpr("doc_id", "text", "1 as n_words", "doc_id as item_id")
    assert got(contamination(clash, b)) == brute(docs, bench, 10)


def test_removal_leaves_no_hit_and_no_clean_document_changed(spark):
    docs, bench, d, b = tables(spark)
    out = remove_contaminated(d, b)
    assert out.columns == d.columns
    assert not any(r.contaminated for r in contamination(out, b).collect())
    left = [(r.doc_id, r.text) for r in out.collect()]
    hits = {x[0]: x for x in brute(docs, bench, 10)}
    for i, t in docs:
        if not hits[i][5]:
            assert (i, t) in left
        elif hits[i][2] > 0.5 * hits[i][1]:
            assert i not in {x for x, _ in left}


def test_items_without_id_hit_as_in_the_sql(spark):
    import duckdb

    from odflow.llm.queries import OP10_SQL
    docs = [(1, "a zz yy xx b"), (2, "zz yy"), (3, "q r s, zz yy xx"), (4, "one zz yy xx two three q r s " + "w " * 20), (5, None)]
    bench = [(None, "ZZ yy-xx"), (None, "one"), (3, "q r s"), (4, "zz yy xx")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for items, parts in ((bench[:3], 500), (bench, 500), (bench, 1)):
        b = spark.createDataFrame(items, "item_id long, text string")
        con = duckdb.connect()
        for name, rows in (("documents", docs), ("benchmark", items)):
            con.execute(f"CREATE TABLE {name} ({'doc_id' if name == 'documents' else 'item_id'} BIGINT, text VARCHAR)")
            con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
        assert got(contamination(d, b, part_windows=parts)) == sorted(con.execute(OP10_SQL).fetchall(), key=str)
    left = {r.doc_id: r.text for r in remove_contaminated(d, b).collect()}
    assert set(left) == {2, 4, 5} and "zz" not in left[4] and "one" not in left[4]


def test_removal_keeps_columns_named_like_results(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, "clean words here", 77, "x", [5]), (2, "a b c d e f g h i j k l m n " + passage + " o p q", 78, "y", None), (3, None, 79, None, None)],
                                 "doc_id long, text string, n_words long, _text string, spans array<int>")
    bench = spark.createDataFrame([("q", passage)], "item_id string, text string")
    out = remove_contaminated(docs, bench)
    assert out.columns == docs.columns
    got = {r["doc_id"]: tuple(r)[1:] for r in out.collect()}
    assert got[1] == ("clean words here", 77, "x", [5]) and got[3] == (None, 79, None, None)
    assert got[2][1:] == (78, "y", None) and "w3" not in got[2][0]
