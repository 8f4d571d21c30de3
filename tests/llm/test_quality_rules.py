import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F
from texts import corpus, words

from odflow.llm import quality_rules as R


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))


def test_counts_by_brute_force(spark):
    rng = random.Random(6)
    rows = [t for _, t in corpus(3, 12)]
    for _ in range(40):
        few = words(rng, 3)
        rows.append("".join(rng.choice(few + ["\n", "\n", " | ", "## "]) + rng.choice([" ", "\n", " "]) for _ in range(rng.randint(1, 60))))
    rows += ["a " * 7, "a " * 8, "a " * 9, "a " * 4000, "é€😀 x\ny\ny \ny"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in R.rule_counts(df).collect()}
    assert got == {i: counts(t) for i, t in enumerate(rows)}


def test_binomial_tail_is_exact(spark):
    cases = [(k, n, p) for n in (1, 7, 60, 400) for p in (0.01, 0.2) for k in range(0, int(n * p) + 2) if k < n * p]
    df = spark.createDataFrame([(k, n) for k, n, _ in cases], "k long, n long")
    for p in (0.01, 0.2):
        got = {(r.k, r.n): r.t for r in df.select("k", "n", R.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect()}
        for (k, n), t in got.items():
            if k < n * p:
                want = sum(math.comb(n, j) * p**j * (1 - p)**(n - j) for j in range(k + 1))
                assert math.isclose(t, want, rel_tol=1e-9)


def test_cutoffs_and_verdicts(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(1500):
        lang = ["en", "en", "en", None][i % 4]
        good = i % 5 > 0
        w = words(rng, rng.randint(25, 40))
        docs.append((i, lang, " ".join(w if good else [x + "##" for x in w])))
        labels.append((i, int(good)))
    docs += [(2000, "xx", " ".join(words(rng, 30)) + " ####" * 9), (2001, "en", None), (2002, "en", ""), (2002, "en", "")]
    labels += [(5000, 1), (None, 1), (3, None)]
    d = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    y = spark.createDataFrame(labels, "doc_id long, quality int")
    out = R.quality_rules(d, y)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(docs)
    en_bad = [i for i in range(1500) if i % 5 == 0 and i % 4 != 3]
    assert not any(rows[i].kept for i in en_bad) and "symbol_share" in rows[0].rejected_by
    assert all(rows[i].kept for i in range(1500) if i % 5 and i % 4 != 3)
    assert rows[2000].kept  # a stratum without labels certifies nothing
    assert rows[2001].base_failed and not rows[2001].kept and not rows[2002].kept
    cuts = R.certified_cutoffs(R.rule_counts(d), y).collect()
    assert cuts and all(c.tail <= R.DELTA / (2 * len(R.METRICS)) for c in cuts)
    bare = {r.doc_id: r for r in R.quality_rules(d, y.limit(0)).collect()}
    assert all(r.kept is (not r.base_failed) for r in bare.values())
    assert R.quality_rules(d.limit(0), y).count() == 0


def test_columns_with_clashing_names(spark):
    rng = random.Random(4)
    inner = ["cuts", "_stratum", "_n", "row", "stratum", "metric", "_doc", "_id", "_q", "quality", "good", "none"]
    docs = spark.createDataFrame([(i, "en", " ".join(words(rng, 30)), *(f"{c}{i}" for c in inner), 77) for i in range(9)],
                                 ", ".join(["doc_id long", "lang string", "text string", *(f"{c} string" for c in inner), "n_lines long"]))
    labels = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    out = R.quality_rules(docs, labels)
    assert out.columns[:2 + len(inner)] == ["doc_id", "lang", *inner] and out.columns.count("n_lines") == 1
    rows = out.collect()
    assert len(rows) == 9 and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in inner) and {r.n_lines for r in rows} == {1}
    only = R.quality_rules(docs.selectExpr("doc_id", "text", "lang as n_words"), labels, stratum="n_words")
    assert only.count() == 9 and {r.n_words for r in only.collect()} == {30}
