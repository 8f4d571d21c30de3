"""Quality by compression, toxicity and token counts."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from texts import words
from tokenizers import Tokenizer

from odflow.llm import quality_model as Q
from odflow.llm import token_counts as C
from odflow.llm import toxicity as X
from odflow.llm.training import rising_fit

SF = "/root/testdata/sf0.1"
INSULTS = "idiot moron loser clown trash".split()


def labelled(seed, n):
    rng, rows = random.Random(seed), []
    for i in range(n):
        w = words(rng, rng.randint(20, 90))
        toxic, good = i % 4 == 0, i % 3 > 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(INSULTS)
        rows.append((i, " ".join(w) if good else " ".join(x.upper() + "!!" for x in w), int(good), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = labelled(1, 400)
    docs = [(i, t, "x", 0.5) for i, t, _, _ in rows] + [(1000, None, "x", 0.5), (1001, "", "x", 0.5), (1002, "", None, 0.5), (None, "a b", "x", 0.5)]
    docs += [(1003, "word " * 30000 + "you idiot", "x", 0.5)] * 2
    labels = [(i, q, t) for i, _, q, t in rows] + [(1000, 1, 0), (None, 1, 1), (9999, 0, 1), (5, None, None)]
    return (spark.createDataFrame(docs, "doc_id long, text string, source string, score double").cache(),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache(), rows)


def accuracy(df, truth, held=True):
    got = [r for r in df.collect() if r.doc_id in truth and r.held_out == held]
    return sum(r.predicted == truth[r.doc_id] for r in got) / len(got)


def test_quality(spark, tables):
    docs, labels, rows = tables
    out = Q.quality_scores(docs, labels)
    assert out.columns == ["doc_id", "source", "held_out", "score", "predicted"] and out.count() == docs.count()
    assert accuracy(out, {i: q for i, _, q, _ in rows}) > 0.97
    assert out.filter("score < 0 or score > 1 or isnan(score) or score is null").count() == 0
    assert {r.score for r in Q.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.quality_scores(docs.limit(0), labels).count() == 0


def test_toxicity(spark, tables):
    docs, labels, rows = tables
    out = X.toxicity_scores(docs, labels)
    assert out.columns == ["doc_id", "source", "held_out", "score", "predicted"] and out.count() == docs.count()
    assert accuracy(out, {i: t for i, _, _, t in rows}) > 0.97
    assert out.filter("score < 0 or score > 1 or isnan(score) or score is null").count() == 0
    assert len({r.score for r in X.toxicity_scores(docs, labels.limit(0)).collect()}) == 1
    kept = X.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 1000} == {r.doc_id for r in out.collect() if r.predicted == 0 and r.doc_id is not None and r.doc_id < 1000}
    assert X.drop_toxic(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("model, column, least", [(Q.quality_scores, "quality", 0.98), (X.toxicity_scores, "toxic", 0.97)])
def test_held_out_documents(spark, model, column, least):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = model(docs, labels).filter("held_out").join(labels, "doc_id")
    assert got.agg(F.avg((F.col("predicted") == F.col(column)).cast("int"))).first()[0] > least


def test_more_insults_never_lower_a_score(spark):
    """Fitted on real labels: whatever is there before, another insult raises the score or leaves it, and none scores lowest."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = X.fit_in_task(X.labelled_sample(docs, labels, "toxic", 400, X.MAX_CHARS), X.fit)
    assert (model.scale[:-1] >= X.LEAST_WEIGHT - 1e-9).all()
    rng, scorer = random.Random(8), X.Scorer(model)
    for _ in range(40):
        w = words(rng, rng.randint(12, 300))
        texts = [" ".join(w)]
        for _ in range(6):
            # Not beside spaced letters: the letters of two spaced words in a row are one run.
            at = rng.choice([i for i in range(len(w) + 1) if not any(" " in x for x in w[max(0, i - 1):i + 1])])
            w.insert(at, rng.choice([*INSULTS, "idxiot", "lo-ser", "moron.", "m o r o n"]))
            texts.append(" ".join(w))
        scores = scorer.scores(pa.array(texts))
        assert (np.diff(scores) >= -1e-12).all(), (texts, scores)
    empty, short, long = scorer.scores(pa.array(["", "you are an idiot", "a fine day in the park with friends " * 40 + "you are an idiot"]))
    assert empty < long <= short


def test_rising_fit_against_a_grid():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=400) > 0).astype(int)
    w = rising_fit(x, y, 0.1, 0.5)

    def cost(v):
        v = np.array(v)
        return np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ v[:-1] + v[-1])).sum() + 0.5 * 400 / 200 * (v[:-1] ** 2).sum()

    assert w[1] == 0.1 and all(cost(w) <= cost([a, b, c]) + 1e-6 for a in np.arange(0.1, 3, 0.1) for b in (0.1, 0.2, 0.5) for c in np.arange(-1, 1, 0.1))


def test_kernel_by_enumeration():
    rng = random.Random(3)

    def brute(s, t, n, decay):
        return sum(decay ** (a[-1] - a[0] + b[-1] - b[0] + 2) for a in combinations(range(len(s)), n) for b in combinations(range(len(t)), n)
                   if all(s[i] == t[j] for i, j in zip(a, b)))

    for _ in range(40):
        s, t = ("".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(2))
        for n in (2, 3):
            got = X.subsequence_kernel(X._codes([s], 8, -1), X._codes([t], 9, -2), n, 0.6)[0]
            assert np.isclose(got, brute(s, t, n, 0.6), rtol=1e-4, atol=1e-7)


def test_gapped_and_inserted_insults():
    model = X.fit([(t, y) for _, t, _, y in labelled(2, 600)])
    worst = {}
    for text in ("you idiot", "you i d i o t there", "you id.iot", "you idxiot", "you moxron", "a nice day in spring"):
        ev = X.Scorer(model)
        data = np.frombuffer(text.encode(), np.uint8)
        worst[text] = ev.evidence(data, np.array([0, len(data)]))[0, 0]
    clean = worst.pop("a nice day in spring")
    assert all(v > 0 > clean for v in worst.values()), (worst, clean)


def test_bit_parallel_length_is_never_too_small():
    rng = random.Random(4)
    marks = X.Landmarks.of(["^abcab$", "^bca", "cabc"])
    for _ in range(200):
        s = "".join(rng.choice("abcx") for _ in range(rng.randint(1, 12)))
        for k, t in enumerate(marks.strings):
            table = [[0] * (len(t) + 1) for _ in range(len(s) + 1)]
            for i, a in enumerate(s):
                for j, b in enumerate(t):
                    table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
            code = X._codes([s], len(s), -1)
            got = X._common_length(X._buckets(code), np.array([len(s)]), marks.places[k:k + 1], marks.width[k:k + 1])[0]
            assert got >= table[-1][-1]


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_counts_equal_the_library(spark, monkeypatch):
    rng, lib = random.Random(5), library()
    parts = ["a", "B", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "中", "😀", "1", "²", "'s", "<|endoftext|>", "!", "—", " the", "hello world", "א", "́"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(600)] + [None, "", "x " * 3000, "y" * 5000, "<|endoftext|>" * 3]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(None, "a", 7)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int")
    got = C.token_counts(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    want = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows]
    assert sorted(map(str, ((r.doc_id, r.n_bytes, r.n_tokens) for r in got))) == sorted(map(str, want))
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    counter = C.Counter(lib.to_str())
    monkeypatch.setattr(C, "PIECE_CHARS", 5)
    assert [counter.count(t or "") for t in texts] == [w[2] for w in want[:len(texts)]]


def test_proved_strings_are_single_tokens():
    lib = library()
    whole = C.prove_whole_tokens(lib.to_str())
    assert len(whole) > 40_000
    for s in whole[::97]:
        assert len(lib.model.tokenize(C.Counter(lib.to_str()).as_bytes(s) if False else "".join(C.byte_characters()[b] for b in s.encode()))) == 1
