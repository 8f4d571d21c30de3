import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from odflow.llm import queries
from odflow.llm import token_alignment as A

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_map():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in keep}
    for k, b in enumerate(b for b in range(256) if b not in keep):
        chars[b] = chr(256 + k)
    return {c: b for b, c in chars.items()}


def brute(texts):
    """Whole texts, tokens' bytes from the vocabularies, links by comparing all ranges."""
    a, b, back = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES), byte_map()
    a.encode_special_tokens = True
    rows, counts = [], Counter()
    for text in texts:
        x, y = [], []
        if text:
            e, ids = a.encode(" " + text, add_special_tokens=False), b.encode(text)
            x = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in e.ids]
            y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in ids]
            whole = (" " + text).encode()
            if b"".join(t for _, t in x) != whole or b"".join(t for _, t in y) != whole:
                x, y = [], []

        def ranges(tokens):
            at, out = 0, []
            for i, t in tokens:
                out.append((i, at, at + len(t)))
                at += len(t)
            return out

        x, y = ranges(x), ranges(y)
        links, j = [], 0
        for i, s, e in x:
            while y[j][2] <= s:
                j += 1
            k = j
            while k < len(y) and y[k][1] < e:
                links.append((i, y[k][0]))
                k += 1
        cuts, groups = sorted({e for _, _, e in x} & {e for _, _, e in y}), []
        left = [list(x), list(y)]
        for side in left:
            side.reverse()
        for c in cuts:
            parts = []
            for side in left:
                own = []
                while side and side[-1][2] <= c:
                    own.append(str(side.pop()[0]))
                parts.append(",".join(own))
            groups.append("|".join(parts))
        counts.update(links)
        rows.append((len(x), len(y), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""))
    top = Counter()
    for (_, k), n in counts.items():
        top[k] = max(top[k], n)
    return [(n_a, n_b, n_g, len(ls), sum(counts[p] == top[p[1]] for p in ls), sum(counts[p] for p in ls), sha) for n_a, n_b, n_g, ls, sha in rows]


ODD = ["", None, " ", "  two  spaces ", "日本語 テキスト 😀 x", "▁ literal", "a b c d e", "<|endoftext|> <s> <unk> <0x0A>", "tab\tnew\n\nline \r\n end ",
       "한국 é́ ñandú ÀÉ ß×÷", "\x00 nul \x07", "don't we'll I'd 'S", "123 456,789 0.5", "word", "Word word  WORD", "👩‍👩‍👧 family", "\U000e0001 tag", "a" * 3000,
       " leading", "trailing ", "x 日", "日 x", "ö ö ö", "\u0085 a", "　 b"]


def mixed(seed, n=60):
    rng = random.Random(seed)
    stock = ["the", "an", "日本", "é", "ß", "😀", " ", "  ", "\n", "1", "23", "!", "'s", "▁", "x" * 70, "Word", " ", "−"]
    return ["".join(rng.choice(stock) + rng.choice(["", " ", " "]) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def run(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = A.align_tokens(df, BPE, PIECES, **kw).collect()
    return [tuple(r[c] for c in COLUMNS) for r in sorted(out, key=lambda r: r["doc_id"])]


def test_equals_brute_force(spark):
    texts = ODD + mixed(1) + ODD
    assert run(spark, texts) == brute(texts)


def test_rare_pairs_are_joined(spark):
    texts = ODD + mixed(2)
    assert run(spark, texts, heavy=20) == brute(texts)
    assert run(spark, texts, heavy=0) == brute(texts)


def test_without_units():
    """Whole texts as one unit give the same."""
    texts = ODD + mixed(3, 20)
    with open(BPE, encoding="utf-8") as f, open(PIECES, "rb") as g:
        aligner = A.Aligner(f.read(), g.read())
    assert aligner.separable and aligner.b_spans_bytes
    for t in texts:
        t = (t or "").encode()
        assert b" ".join(aligner.units(t)) == t
        got, bounds = aligner.slots([t])
        valid, numbers, _, groups, links = aligner.align([t]) if t else ([False], None, None, None, None)
        if not valid[0]:
            assert len(got) == 0
        else:
            assert ";".join(aligner.groups[k] for k in got) == groups[0] and aligner.numbers[:, got].sum(axis=1).tolist() == numbers[:, 0].tolist()
            assert sum((aligner.links[aligner.bounds[k]:aligner.bounds[k + 1]].tolist() for k in got), []) == links.tolist()


def test_few_units_are_kept(spark):
    texts = (ODD + mixed(4) + ODD) * 20
    out = run(spark, texts, heavy=30, kept=20)
    assert out == brute(texts)


def test_spans_are_refined_inside_characters():
    # A space, and three tokens that share one character of three bytes: both ways a library may place the inner ones.
    assert A.byte_ends(np.array([2, 1, 1, 2]), np.array([4, 4, 4, 6])).tolist() == [2, 3, 4, 6]
    assert A.byte_ends(np.array([1, 1, 1, 1]), np.array([1, 1, 1, 4])).tolist() == [1, 2, 3, 4]


def test_packed_links_come_back():
    at = np.array([0, 2, 2, 5])
    for wide, most in ((False, 1 << 16), (True, 1 << 20)):
        links = np.array([[1, 0], [most - 1, 7], [3, most - 1], [3, 3], [0, 0]], dtype=np.int64)
        links = links[:, 0] << 32 | links[:, 1]
        packed = A.pack(links, at, wide)
        assert packed[1] == b"" and A.unpack(packed, 5).tolist() == links.tolist()
        assert A.unpack(packed[2:], 3).tolist() == links[2:].tolist()
    assert A.unpack([b""], 0).tolist() == []


def test_edges(spark):
    df = spark.createDataFrame([(1, "a b", 7, "x"), (1, "a b", 7, "x"), (None, None, None, None)], "doc_id long, text string, n_a int, pair string")
    out = A.align_tokens(df, BPE, PIECES)
    assert out.columns == ["doc_id", "pair", *COLUMNS]
    rows = [tuple(r) for r in out.collect()]
    assert rows.count((None, None, 0, 0, 0, 0, 0, 0, "")) == 1 and len(set(rows)) == 2 and len(rows) == 3
    assert A.align_tokens(spark.createDataFrame([], "doc_id long, text string"), BPE, PIECES).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    out = queries.op13_tokenizer_alignment(spark, sf).orderBy("doc_id").collect()
    want = brute([r["text"] for r in rows])
    assert [tuple(r[c] for c in COLUMNS) for r in out] == want
