"""Token counts for a byte-level BPE vocabulary, with a shortcut for whole tokens.

Before any text is read it is proved, string by string, which entries of the vocabulary encode
alone as one token. A text is split into pre-tokens; those among the proved strings count one
each, and only the rest is merged. Counts of merged pre-tokens are kept per worker in a dictionary
of bounded size. Texts are counted where they lie, with no shuffle.
"""

from __future__ import annotations

import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from odflow.llm.textarrays import slabs

#: Fixed value: the split pattern of byte-level BPE vocabularies.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Outside these ranges two pattern engines may use different Unicode tables, or differ in what is
#: white space; the tokenizer's own splitter then takes over for the piece.
_UNSURE = regex.compile(r"[^\x00-\x1B\x20-ӿ -⁯぀-ヿ一-龥가-힣]")
_CUT = regex.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: Pieces of very long texts, in characters, and counts kept per worker.
PIECE_CHARS, KEPT = 1 << 18, 300_000
LIMIT = 1024


def byte_characters() -> list[str]:
    """The character that stands for each byte in such vocabularies: printable Latin-1 stands for itself, others go to 256 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Counter(dict):
    """Pre-token -> number of tokens; starts as the proved whole tokens and merges what it lacks."""

    def __init__(self, vocabulary: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.merge = self.tokenizer.model.tokenize
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.chars = byte_characters()
        spec = json.loads(vocabulary)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def as_bytes(self, piece: str) -> str:
        return "".join(map(self.chars.__getitem__, piece.encode()))

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self.merge(self.as_bytes(piece)))
        return n

    def pieces(self, text: str) -> list[str]:
        if _UNSURE.search(text):
            return [text[a:b] for _, (a, b) in self.split(text)]
        return PRE_TOKEN.findall(text)

    def count(self, text: str) -> int:
        n = 0
        if self.special is not None:
            parts = self.special.split(text)
            n = len(parts) - 1
        else:
            parts = [text]
        for part in parts:
            at = 0
            while at < len(part):
                cut = _CUT.search(part, at + PIECE_CHARS) if len(part) - at > PIECE_CHARS else None
                end = cut.start() if cut else len(part)
                n += sum(map(self.__getitem__, self.pieces(part[at:end])))
                at = end
        return n


def prove_whole_tokens(vocabulary: str) -> list[str]:
    """Vocabulary strings (whole UTF-8 texts) that the merges alone turn into exactly one token."""
    counter = Counter(vocabulary)
    back = {c: b for b, c in enumerate(counter.chars)}
    whole = []
    for entry in counter.tokenizer.get_vocab(with_added_tokens=False):
        if all(c in back for c in entry) and len(counter.merge(entry)) == 1:
            try:
                whole.append(bytes(back[c] for c in entry).decode())
            except UnicodeDecodeError:
                pass
    return sorted(whole)


_WORKER: dict = {}


def _counter(shared) -> Counter:
    """The worker's counter for this vocabulary, kept from task to task."""
    vocabulary, whole = shared.value
    if _WORKER.get("vocabulary") != vocabulary:
        _WORKER.update(vocabulary=vocabulary, counter=Counter(vocabulary))
    counter = _WORKER["counter"]
    if not counter or len(counter) > KEPT:
        counter.clear()
        counter.update(dict.fromkeys(whole, 1))
    return counter


def token_counts(docs: DataFrame, vocabulary_path: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Documents (all columns but the text; same-named inputs replaced) with n_bytes, n_tokens and over_limit.

    ``vocabulary_path`` is a tokenizer file the driver can read; tasks get its content. No begin, end or
    other added tokens, no truncation; special strings inside a text count one token each.
    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each for itself.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, prove_whole_tokens(vocabulary)))  # bounded by the file
    new = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in docs.columns if c not in new and c != text_col]
    cols = [f"c{i}" for i in range(len(keep))]
    src = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, cols)], F.col(f"`{text_col}`").alias("_text"))

    def run(batches):
        for batch in batches:
            counter, sizes, counts = _counter(shared), [], []
            for i, j, data, off in slabs(batch.column(len(cols))):
                raw = data.tobytes()
                for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                    sizes.append(b - a)
                    counts.append(counter.count(raw[a:b].decode()))
                counter = _counter(shared)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(cols)], pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                                             [*cols, "n_bytes", "n_tokens"])

    schema = T.StructType([*src.schema.fields[:-1], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    out = src.mapInArrow(run, schema)
    return out.select(*[F.col(a).alias(c) for c, a in zip(keep, cols)], "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
