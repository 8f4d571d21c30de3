"""Alignment of two tokenizers over the same bytes: common cuts, groups, overlapping tokens and their counts.

A byte-level BPE vocabulary (A) reads space + text, a sentencepiece vocabulary (B) reads the text and adds that space itself.
Both libraries report where a token lies: A in characters, B in the spans of its result message. These spans are the coarse
cuts. Where several tokens share the span of one character (parts of a multibyte character, byte-fallback pieces), the bytes
that the tokens decode to cut it finely.

Texts are read in units that end before a single space which follows a character other than ASCII white space and precedes a visible
ASCII character or one of U+00C0 to U+00FF. The split pattern of A starts a new piece at every such space; B cannot merge across it
if no piece holds a space after another character. Both are proved from the files before any text is read (otherwise whole
texts are one unit). A worker reads a unit it does not know yet together with the others of its slab, and keeps what came out in arrays
of bounded size; units met least often leave first. A text with a unit that the tokens do not give back is decided as a whole.

Texts are read once. The ids of every text's links are written beside its counts and digest, and so are each task's partial counts of
the links per id pair, which one aggregate adds up. A second step reads the links back and looks the pairs up: the ``HEAVY`` most frequent
pairs at most are broadcast, links of rarer pairs are joined by pair and added up by row, so what is broadcast is bounded whatever
the corpus.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from odflow.llm.textarrays import slabs
from odflow.llm.token_counts import byte_characters
from odflow.llm.workers import release, tidy
from odflow.store import Store

#: Most pairs that are broadcast (17 bytes each); units a worker keeps (with ten links each at most); bytes of units read together.
HEAVY, KEPT, JOINED = 1_000_000, 600_000, 1 << 13
_SLAB = 2 << 20
#: Links looked up at once (or those of one text); pair counts in a row of the stored table.
_LINKS, _PAIRS_A_ROW = 1 << 20, 1 << 14
_CUT = re.compile(rb"(?<=[!-~\x80-\xff]) (?=[!-~\xc3])")
#: A text without any of these is cut at every space.
_UNEVEN = re.compile(rb"[\x00-\x20] |\x7f | [\x00-\x20\x7f-\xc2\xc4-\xff]")
_SHIFT = 32


def byte_ends(lengths: np.ndarray, coarse: np.ndarray) -> np.ndarray:
    """Byte end of every token of a text whose tokens decode to its bytes: the end of its span where the span ends with
    the token's last byte, else (inside a character) the decoded bytes up to it."""
    decoded = np.cumsum(lengths)
    return np.where(coarse == decoded, coarse, decoded)


class Aligner:
    """Both tokenizers and what is kept of the units read so far."""

    def __init__(self, bpe: str, pieces: bytes, kept: int = KEPT, texts: bool = True):
        self.most, self.texts = kept, texts
        self.a = Tokenizer.from_str(bpe)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        back = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_sizes, self.b_sizes = (np.array(list(map(len, t)), dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        spec = json.loads(bpe)
        split = spec.get("pre_tokenizer") or {}
        self.separable = (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                          and not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())))
        #: Whether the second library counts its spans in bytes or in characters.
        self.b_spans_bytes = max(p.end for p in self.b.encode("é", return_type="proto").pieces) == 2
        self.forget()

    def forget(self) -> None:
        """Drop all units."""
        self.slot: dict = {}
        self.groups: list[str] = []
        self.valid = np.zeros(0, dtype=bool)
        self.numbers = np.zeros((3, 0), dtype=np.int64)  # n_a, n_b, n_groups of each slot
        self.bounds, self.links = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.hits = np.zeros(0, dtype=np.int64)

    @property
    def full(self) -> bool:
        return len(self.groups) > self.most or len(self.links) > 10 * self.most

    def trim(self) -> None:
        """Keep the units met most often since the last time (twice at least), half as many as there may be. They get new slots."""
        often = np.argsort(-self.hits, kind="stable")[:self.most // 2]
        often = often[self.hits[often] > 1]
        stay = np.sort(often[np.cumsum(np.diff(self.bounds)[often]) <= 5 * self.most])
        new = np.full(len(self.groups), -1)
        new[stay] = np.arange(len(stay))
        self.slot = {w: k for w, k in zip(self.slot, new[list(self.slot.values())].tolist()) if k >= 0}
        self.groups = [self.groups[k] for k in stay.tolist()]
        lens = np.diff(self.bounds)[stay]
        self.links = self.links[_ranges(self.bounds[stay], lens)]
        self.bounds = np.concatenate(([0], np.cumsum(lens)))
        self.valid, self.numbers, self.hits = self.valid[stay], self.numbers[:, stay], np.zeros(len(stay), dtype=np.int64)

    def tokens_a(self, text: str, data: bytes):
        """(ids, byte ends) of the first vocabulary over ``text`` (bytes ``data``), or None if the bytes differ."""
        e = self.a.encode(text, add_special_tokens=False)
        ids = e.ids
        if b"".join(map(self.a_bytes.__getitem__, ids)) != data:
            return None
        ends = np.fromiter((b for _, b in e.offsets), dtype=np.int64, count=len(ids))
        if len(text) != len(data):  # characters to bytes
            ends = np.concatenate((np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), [len(data)]))[ends]
        ids = np.array(ids, dtype=np.int64)
        return ids, byte_ends(self.a_sizes[ids], ends)

    def tokens_b(self, text: str, data: bytes):
        """(ids, byte ends) of the second vocabulary over the space it adds and ``text``."""
        spans = [(p.id, p.end) for p in self.b.encode(text, return_type="proto").pieces]
        if b"".join([self.b_bytes[i] for i, _ in spans]) != data:
            return None
        ids, ends = np.array(spans, dtype=np.int64).reshape(-1, 2).T
        if not self.b_spans_bytes:
            ends = np.concatenate((np.flatnonzero((np.frombuffer(data[1:], np.uint8) & 0xC0) != 0x80), [len(data) - 1]))[ends]
        return ids, byte_ends(self.b_sizes[ids], ends + 1)  # spans are of the text without the added space

    def align(self, units: list[bytes]):
        """Of space + unit, for each unit: validity, (n_a, n_b, n_groups), number of links, groups text; and all links back to back.

        Units are read as one text, which they are independent parts of; where that does not come back byte for byte the
        halves are read on their own, down to the unit that is the cause, which has no tokens.
        """
        data = b"".join([b" " + u for u in units])
        text = data.decode()
        a, b = self.tokens_a(text, data), self.tokens_b(text[1:], data)
        ends = np.cumsum([len(u) + 1 for u in units])
        marks = np.zeros(len(data) + 1, dtype=np.uint8)
        if a is not None and b is not None:
            marks[a[1]] |= 1
            marks[b[1]] |= 2
        if (marks[ends] != 3).any():
            half = len(units) // 2
            if half:
                x, y = self.align(units[:half]), self.align(units[half:])
                return (x[0] + y[0], np.concatenate((x[1], y[1]), axis=1), np.concatenate((x[2], y[2])), x[3] + y[3], np.concatenate((x[4], y[4])))
            return [False], np.zeros((3, 1), dtype=np.int64), np.zeros(1, dtype=np.int64), [""], np.zeros(0, dtype=np.int64)
        # Every stretch between two ends of either side lies in one token of each, and is one link.
        every = np.flatnonzero(marks)
        kind = marks[every]
        has_a, has_b, both = kind & 1, kind >> 1, kind == 3
        upto_a, upto_b, upto = np.cumsum(has_a, dtype=np.int64), np.cumsum(has_b, dtype=np.int64), np.cumsum(both, dtype=np.int64)
        links = a[0][upto_a - has_a] << _SHIFT | b[0][upto_b - has_b]
        last = np.searchsorted(every, ends)
        numbers = np.diff(np.stack([x[last] for x in (upto_a, upto_b, upto)]), axis=1, prepend=0)
        texts = [""] * len(units)
        if self.texts:
            text_a, text_b = list(map(str, a[0].tolist())), list(map(str, b[0].tolist()))
            groups, x, y = [], 0, 0
            for i, j in zip(upto_a[both].tolist(), upto_b[both].tolist()):
                groups.append((text_a[x] if i - x == 1 else ",".join(text_a[x:i])) + "|" + (text_b[y] if j - y == 1 else ",".join(text_b[y:j])))
                x, y = i, j
            at = 0
            for k, g in enumerate(upto[last].tolist()):
                texts[k], at = ";".join(groups[at:g]), g
        return [True] * len(units), numbers, np.diff(last, prepend=-1), texts, links

    def learn(self, units: list[bytes]) -> None:
        """Give every unit a slot."""
        found, at = [], 0
        while at < len(units):
            end, size = at, 0
            while end < len(units) and (end == at or size + len(units[end]) < JOINED):
                size += len(units[end])
                end += 1
            found.append(self.align(units[at:end]))
            at = end
        valid, numbers, lens, texts, links = zip(*found)
        first = len(self.groups)
        self.slot.update(zip(units, range(first, first + len(units))))
        self.groups += chain.from_iterable(texts)
        self.valid = np.concatenate((self.valid, *valid))
        self.numbers = np.concatenate((self.numbers, *numbers), axis=1)
        self.links = np.concatenate((self.links, *links))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(np.concatenate(lens))))
        self.hits = np.concatenate((self.hits, np.zeros(len(units), dtype=np.int64)))

    def units(self, data: bytes) -> list[bytes]:
        """The units of a text, each without the space before it; none for an empty text."""
        if not data:
            return []
        if not self.separable:
            return [data]
        if data[0] > 32 and data[-1] > 32 and not _UNEVEN.search(data):
            return data.split(b" ")
        cuts = [m.start() for m in _CUT.finditer(data)]
        return [data[i:j] for i, j in zip([0, *(c + 1 for c in cuts)], [*cuts, len(data)])]

    def slots(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the units of all texts back to back, and each text's range in them; none for a text without tokens."""
        units = [self.units(t) for t in texts]
        every = list(chain.from_iterable(units))
        got = np.fromiter(map(self.slot.get, every, repeat(-1)), dtype=np.int64, count=len(every))
        unknown = np.flatnonzero(got < 0)
        if len(unknown):
            self.learn(list(dict.fromkeys(every[k] for k in unknown.tolist())))
            got[unknown] = [self.slot[every[k]] for k in unknown.tolist()]
        bounds = np.concatenate(([0], np.cumsum([len(u) for u in units]))).astype(np.int64)
        bad = np.unique(np.searchsorted(bounds, np.flatnonzero(~self.valid[got]), "right") - 1)
        if len(bad):  # a unit is not given back by its own tokens: the whole text decides
            per = [got[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            for k in bad.tolist():
                if texts[k] not in self.slot:
                    self.learn([texts[k]])
                whole = self.slot[texts[k]]
                per[k] = np.array([whole] if self.valid[whole] else [], dtype=np.int64)
            got, bounds = np.concatenate(per), np.concatenate(([0], np.cumsum([len(p) for p in per]))).astype(np.int64)
        self.hits += np.bincount(got, minlength=len(self.hits))
        return got, bounds


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All positions of the runs that start at ``starts`` and are ``lens`` long."""
    return np.repeat(starts - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(int(lens.sum())) if len(lens) else np.zeros(0, np.int64)


_WORKER: dict = {}


def _aligner(shared) -> Aligner:
    """The worker's aligner for these vocabularies; a worker keeps one."""
    use = shared.value
    if _WORKER.get("use") != use:
        _WORKER.clear()
        _WORKER.update(use=use, aligner=Aligner(*use))
    return _WORKER["aligner"]


def pack(links: np.ndarray, at: np.ndarray, wide: bool) -> list[bytes]:
    """The links of each text as compressed id pairs: two bytes an id, four if a vocabulary is ``wide``; nothing for no links."""
    ids = np.stack((links >> _SHIFT, links & ((1 << _SHIFT) - 1)), axis=1).astype("<u4" if wide else "<u2")
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return [squeeze(ids[a:b].tobytes()) if a < b else b"" for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def unpack(packed: list[bytes], n: int) -> np.ndarray:
    """The ``n`` links that several packed texts hold, back to back."""
    unsqueeze = zstandard.ZstdDecompressor().decompress
    raw = b"".join([unsqueeze(p) for p in packed if p])
    ids = np.frombuffer(raw, dtype="<u4" if len(raw) == 8 * n else "<u2").reshape(-1, 2).astype(np.int64)
    return ids[:, 0] << _SHIFT | ids[:, 1]


def _read(shared, n_cols: int, names: list[str]):
    """Task function: carried columns and text -> the same with counts, digest and links of every text, then rows of partial pair counts."""

    def row_batch(carried, values, sha, links, at, wide):
        packed, none = pa.array(pack(links, at, wide), pa.binary()), pa.nulls(len(sha), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*carried, *[pa.array(v, pa.int64()) for v in values], pa.array(sha, pa.string()), packed, none, none], names)

    def pair_batches(aligner: Aligner, types):
        pairs, of = np.unique(aligner.links, return_inverse=True)
        n = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(n, of, np.repeat(aligner.hits, np.diff(aligner.bounds)))
        pairs, n = pairs[n > 0], n[n > 0]
        for at in range(0, len(pairs), _PAIRS_A_ROW):
            lists = [pa.array([x[at:at + _PAIRS_A_ROW]], pa.list_(pa.int64())) for x in (pairs, n)]
            empty = [pa.nulls(1, t) for t in [*types, *[pa.int64()] * 4, pa.string(), pa.binary()]]
            yield pa.RecordBatch.from_arrays([*empty, *lists], names)

    def run(batches):
        aligner, types = _aligner(shared), None
        wide = max(len(aligner.a_bytes), len(aligner.b_bytes)) > 1 << 16
        aligner.hits[:] = 0
        for batch in batches:
            types = [c.type for c in batch.columns[:n_cols]]
            for first, end, data, off in slabs(batch.column(n_cols), _SLAB):
                raw = data.tobytes()
                got, bounds = aligner.slots([raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())])
                own = [got[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
                sha = [hashlib.sha256(";".join([aligner.groups[k] for k in o]).encode()).hexdigest() if o else "" for o in own]
                lens = np.diff(aligner.bounds)[got]
                values = [_run_sums(v, bounds) for v in (*aligner.numbers[:, got], lens)]
                links = aligner.links[_ranges(aligner.bounds[got], lens)]
                carried = [c.slice(first, end - first) for c in batch.columns[:n_cols]]
                yield row_batch(carried, values, sha, links, np.concatenate(([0], np.cumsum(values[3]))), wide)
                if aligner.full:
                    yield from pair_batches(aligner, types)
                    aligner.trim()
        if types is not None:
            yield from pair_batches(aligner, types)
        aligner.hits[:] = 0

    return run


def _price(heavy, n_cols: int, names: list[str]):
    """Task function: carried columns (the number of links last) and packed links of texts -> carried columns, best links and sum of counts of heavy pairs, links of rare pairs."""

    def price(keys: np.ndarray, at: np.ndarray):
        pairs, counts, best = heavy.value
        found = np.searchsorted(pairs, keys).clip(max=len(pairs) - 1) if len(pairs) else None
        hit = pairs[found] == keys if len(pairs) else np.zeros(len(keys), dtype=bool)
        n, top = (np.where(hit, counts[found], 0), hit & best[found]) if len(pairs) else (np.zeros(len(keys), np.int64), hit)
        rare = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(~hit)))[at], pa.int32()), pa.array(keys[~hit], pa.int64()))
        return [pa.array(_run_sums(top, at), pa.int64()), pa.array(_run_sums(n, at), pa.int64()), rare]

    def run(batches):
        _WORKER.clear()  # texts are read: the worker needs no units any more
        release()
        for batch in batches:
            at = np.concatenate(([0], np.cumsum(batch.column(n_cols - 1).to_numpy())))
            first = 0
            while first < len(batch):  # some rows at a time: as many as hold ``_LINKS`` links, one at least
                end = max(first + 1, int(np.searchsorted(at, at[first] + _LINKS, "right")) - 1)
                keys = unpack(batch.column(n_cols).slice(first, end - first).to_pylist(), int(at[end] - at[first]))
                carried = [c.slice(first, end - first) for c in batch.columns[:n_cols]]
                yield pa.RecordBatch.from_arrays([*carried, *price(keys, at[first:end + 1] - at[first])], names)
                first = end

    return run


def _run_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


_NEW = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def pair_counts(partial: DataFrame, store: Store) -> DataFrame:
    """(a, b, n, best): how many links of the corpus hold an id pair linked, and whether no pair of that b has more."""
    each = partial.select(F.explode(F.arrays_zip("_pairs", "_ns")).alias("p"))
    counts = store.cut(each.groupBy(F.col("p._pairs").alias("pair")).agg(F.sum("p._ns").alias("n"))
                       .select(F.shiftright("pair", _SHIFT).alias("a"), F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1)).alias("b"), "n"))
    top = counts.groupBy("b").agg(F.max("n").alias("top"))  # at most one row per id of b
    return counts.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def align_tokens(docs: DataFrame, bpe_path: str, pieces_path: str, text_col: str = "text", heavy: int = HEAVY, kept: int = KEPT) -> DataFrame:
    """Documents (all columns but the text; same-named inputs replaced) with n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The paths are files the driver can read; tasks get their content. n_a and n_b are tokens, n_groups the stretches between
    byte positions where tokens of both sides end, n_links the pairs of an A and a B token that share bytes, count_sum the sum over
    the links of how many links of all texts hold the same two ids, n_best the links whose number is the highest of their B id
    (ties included). groups_sha256 is the lowercase hex SHA-256 of ``a1,a2|b1;a3|b2,b3`` (decimal ids in order).

    Texts that are null or empty, or that either side does not give back byte for byte after the added space, have no tokens: zeros and an
    empty groups_sha256. Special tokens' strings are plain text. Repeated rows count and are returned each for itself; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    store = Store(spark, "alignment")
    with open(bpe_path, encoding="utf-8") as f:
        bpe = f.read()
    with open(pieces_path, "rb") as f:
        pieces = f.read()
    shared = spark.sparkContext.broadcast((bpe, pieces, kept))  # bounded by the two files
    keep = [c for c in docs.columns if c not in _NEW and c != text_col]
    cols = [f"c{i}" for i in range(len(keep))]
    src = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, cols)], F.col(f"`{text_col}`").cast("string").alias("_text"))
    carried = [T.StructField(f.name, f.dataType) for f in src.schema.fields[:-1]]
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    counted = [T.StructField(n, long) for n in ("_n_a", "_n_b", "_n_groups", "_n_links")] + [T.StructField("_groups_sha256", T.StringType())]
    schema = T.StructType([*carried, *counted, T.StructField("_links", T.BinaryType()),
                           T.StructField("_pairs", longs), T.StructField("_ns", longs)])
    read = store.cut(src.mapInArrow(tidy(_read(shared, len(cols), schema.names)), schema))
    counts = store.cut(pair_counts(read.filter("_pairs is not null").select("_pairs", "_ns"), store))
    least = _heavy_from(counts, heavy)
    frequent = counts.filter(F.col("n") >= least).select(F.shiftleft("a", _SHIFT).bitwiseOR(F.col("b")).alias("pair"), "n", "best")
    got = frequent.toPandas().sort_values("pair")  # at most ``heavy`` rows
    table = spark.sparkContext.broadcast((got["pair"].to_numpy(np.int64), got["n"].to_numpy(np.int64), got["best"].to_numpy(bool)))

    known = [*carried, *(f for f in counted if f.name != "_n_links"), T.StructField("_n_links", long)]
    schema = T.StructType([*known, T.StructField("_n_best", long), T.StructField("_count_sum", long), T.StructField("_rare", longs)])
    texts = read.filter("_pairs is null").select(*[f.name for f in known], "_links")
    out = texts.mapInArrow(tidy(_price(table, len(known), schema.names)), schema)
    if least > 1 and not counts.filter(F.col("n") < least).isEmpty():
        out = _with_rare(out, counts.filter(F.col("n") < least), store)
    return out.select(*[F.col(a).alias(c) for c, a in zip(keep, cols)], *[F.col(f"_{n}").alias(n) for n in _NEW])


def _heavy_from(counts: DataFrame, heavy: int) -> int:
    """The least power of two such that at most ``heavy`` pairs have that count or more."""
    rows = counts.groupBy(F.floor(F.log2(F.col("n").cast("double"))).cast("int").alias("size")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    total = 0
    for r in sorted(rows, key=lambda r: -r["size"]):  # one row per size
        total += r["pairs"]
        if total > heavy:
            return 2 ** (r["size"] + 1)
    return 1


def _with_rare(out: DataFrame, rare: DataFrame, store: Store) -> DataFrame:
    """Adds the counts of rare pairs: their links meet the pairs by a shuffle and are added up by row."""
    rows = store.cut(out.withColumn("_row", F.monotonically_increasing_id()))
    links = rows.select("_row", F.explode("_rare").alias("pair"))
    rare = rare.select(F.shiftleft("a", _SHIFT).bitwiseOR(F.col("b")).alias("pair"), "n", F.col("best").cast("long").alias("best"))
    more = links.join(rare, "pair").groupBy("_row").agg(F.sum("n").alias("_more"), F.sum("best").alias("_more_best"))
    zero = F.lit(0).cast("long")
    return rows.join(more, "_row", "left").withColumns({
        "_count_sum": F.col("_count_sum") + F.coalesce("_more", zero), "_n_best": F.col("_n_best") + F.coalesce("_more_best", zero)})
