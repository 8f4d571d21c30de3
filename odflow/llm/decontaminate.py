"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows.

The benchmark's windows are normalised and grouped in Spark. They are then
broadcast in parts of at most ``part_windows`` windows (one part for any usual
benchmark; a larger one only adds parts, each a pass in the same chain), so the
broadcast never grows with the data. Documents are scanned where they lie, with
no shuffle: window hashes of whole texts are looked up in the part's table and
every hit is confirmed on the words themselves before it counts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.llm.textarrays import ALNUM, ASCII_LOWER, slabs, window_hashes, word_hashes, word_spans
from odflow.llm.workers import tidy

PART_WINDOWS = 500_000
_BITS = 22


def _windows(size: int):
    """Task function: (item, text) batches -> one row per window, with its words."""

    def run(batches):
        for batch in batches:
            items, rows = batch.column(0).to_pylist(), []
            for i, j, data, off in slabs(batch.column(1)):
                low = ASCII_LOWER[data]
                starts, ends, words = word_spans(low, off, ALNUM)
                raw = low.tobytes()
                for k in range(j - i):
                    a, b = words[k], words[k + 1]
                    n = min(size, b - a)
                    if n <= 0:
                        continue
                    own = [raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]
                    rows += [(items[i + k], n, b" ".join(own[p:p + n])) for p in range(len(own) - n + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.binary())], ["item", "len", "words"])

    return run


def benchmark_windows(benchmark: DataFrame, size: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the benchmark with the sorted items that hold each of them; last a null if any of these has no id."""
    raw = benchmark.select(F.col(item_col).cast("string"), F.col(text_col)).mapInArrow(
        tidy(_windows(size)), "item string, len int, words binary")
    return raw.groupBy("words", "len").agg(F.concat(
        F.sort_array(F.collect_set("item")),
        F.when(F.bool_or(F.col("item").isNull()), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))).alias("items"))


def _table(rows) -> tuple:
    """Look-up table of one part: per window length sorted hashes, and a dictionary to confirm on words."""
    by_len: dict[int, list] = {}
    for r in rows:
        by_len.setdefault(r["len"], []).append((bytes(r["words"]), tuple(r["items"])))
    table = []
    for n, found in sorted(by_len.items()):
        data = np.frombuffer(b" ".join(w for w, _ in found), dtype=np.uint8)
        starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALNUM)
        hashes = window_hashes(word_hashes(data, starts, ends), n)[::n]  # the windows lie back to back, n words each
        table.append((n, np.unique(hashes), dict(found)))
    return tuple(table)


def _scan(part, last: bool, text_at: int, n_cols: int, want_spans: bool):
    """Task function of one part: adds its hits to the carried columns ``_hit`` and ``_items``."""

    def run(batches):
        tables = []
        for n, hashes, exact in part.value:
            near = np.zeros(1 << _BITS, dtype=bool)
            near[hashes >> np.uint64(64 - _BITS)] = True
            tables.append((n, hashes, near, exact))
        for batch in batches:
            before_hit, before_items = batch.column(n_cols).to_pylist(), batch.column(n_cols + 1).to_pylist()
            counts, hits, items, spans = [], [], [], []
            for i, j, data, off in slabs(batch.column(text_at)):
                low = ASCII_LOWER[data]
                starts, ends, words = word_spans(low, off, ALNUM)
                h = word_hashes(low, starts, ends)
                end_of = np.repeat(words[1:], np.diff(words))  # each word's end of text
                hit, found = np.zeros(len(h), dtype=bool), [set(x or ()) for x in before_items[i:j]]
                for n, hashes, near, exact in tables:
                    w = window_hashes(h, n)
                    at = np.flatnonzero(near[w >> np.uint64(64 - _BITS)])
                    at = at[(at + n <= end_of[at]) & (hashes[np.searchsorted(hashes, w[at]).clip(max=len(hashes) - 1)] == w[at])]
                    text = np.searchsorted(words, at, "right") - 1
                    for p, k in zip(at.tolist(), text.tolist()):
                        own = b" ".join(low[s:e].tobytes() for s, e in zip(starts[p:p + n].tolist(), ends[p:p + n].tolist()))
                        if own in exact:
                            hit[p:p + n] = True
                            found[k].update(exact[own])
                for k in range(j - i):
                    a, b = int(words[k]), int(words[k + 1])
                    old = before_hit[i + k]
                    if old:
                        hit[a + np.array(old)] = True
                    own = np.flatnonzero(hit[a:b])
                    counts.append(b - a)
                    hits.append(own.tolist())
                    items.append(sorted(found[k] - {None}) + [None] * (None in found[k]))
                    if last and want_spans:
                        spans.append(_char_spans(data[off[k]:off[k + 1]], starts[a:b] - off[k], ends[a:b] - off[k], own))
            kept = [batch.column(c) for c in range(n_cols)]
            names = [batch.schema.names[c] for c in range(n_cols)]
            if not last:
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                    [*names, "_hit", "_items"])
                continue
            extra = [pa.array(counts, pa.int64()), pa.array([len(x) for x in hits], pa.int64()),
                     pa.array([len(x) for x in items], pa.int64()),
                     pa.array([hashlib.sha256(",".join(v for v in x if v is not None).encode()).hexdigest() for x in items], pa.string()),
                     pa.array([bool(x) for x in hits], pa.bool_())]
            more = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
            if want_spans:
                extra += [pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.list_(pa.int32())))]
                more += ["items", "spans"]
            yield pa.RecordBatch.from_arrays([*kept, *extra], [*names, *("_new_" + m for m in more)])

    return run


def _char_spans(data, starts, ends, own) -> list[list[int]]:
    """Runs of neighbouring hit words as [first, end) in characters of the text."""
    if not len(own):
        return []
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    cut = np.flatnonzero(np.diff(own) > 1)
    first, last = own[np.concatenate(([0], cut + 1))], own[np.concatenate((cut, [len(own) - 1]))]
    return [[int(chars[starts[a]]), int(chars[ends[b]])] for a, b in zip(first, last)]


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", spans: bool = False,
                  part_windows: int = PART_WINDOWS) -> DataFrame:
    """Benchmark windows found in every document.

    Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z;
    a window is ``size`` words of an item, or all words of a shorter, non-empty item.
    Every column of ``docs`` is kept (an input column with the name of a result is replaced)
    and these are added: n_words, n_hit (words inside any occurrence), n_items, items_sha256
    (of the sorted item ids as strings, comma-joined; of the empty string without any),
    contaminated; with ``spans`` also items and spans ([first, end) character positions).

    Null or empty texts have no words and no hits; an empty or all-null benchmark hits
    nothing; repeated rows are scanned each for itself. Items with a null id hit like any other; in
    n_items (and items) they count as one item together, in items_sha256 they have no part.
    """
    spark = docs.sparkSession
    more = [("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"), ("items_sha256", "string"),
            ("contaminated", "boolean")]
    if spans:
        more += [("items", "array<string>"), ("spans", "array<array<int>>")]
    windows = benchmark_windows(benchmark, size, item_col, item_text).cache()
    parts = max(1, -(-windows.count() // part_windows))
    keep = [c for c in docs.columns if c not in {m for m, _ in more}]
    if text_col not in keep:
        raise ValueError(f"the text column may not be called {text_col!r}")
    cols = [f"c{i}" for i in range(len(keep))]
    out = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, cols)])
    fields = out.schema.fields
    out = out.withColumns({"_hit": F.lit(None).cast("array<int>"), "_items": F.lit(None).cast("array<string>")})
    carried = T.StructType([*fields, *out.schema.fields[-2:]])
    for p in range(parts):
        rows = windows.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == p).collect()
        table, last = spark.sparkContext.broadcast(_table(rows)), p == parts - 1
        schema = carried
        if last:
            schema = T.StructType([*fields, *T._parse_datatype_string(", ".join(f"_new_{m} {t}" for m, t in more)).fields])
        out = out.mapInArrow(tidy(_scan(table, last, keep.index(text_col), len(cols), spans)), schema)
    windows.unpersist()
    return out.select(*[F.col(a).alias(c) for c, a in zip(keep, cols)],
                      *[F.col("_new_" + m).alias(m) for m, _ in more])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10, text_col: str = "text",
                        whole_share: float = 0.5, **names) -> DataFrame:
    """Documents without the benchmark's passages; the columns of ``docs`` as they were.

    A document with more than ``whole_share`` of its words hit is dropped; from any other
    the hit spans are cut out, each leaving one space. Clean documents stay untouched. Null and empty texts are clean; repeated rows
    are decided each for itself; an empty benchmark changes nothing; columns named like results of ``contamination`` are kept as they are.
    """
    rest = [c for c in docs.columns if c != text_col]  # in one struct, so that no name clashes with a result
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]).alias("_row")
    found = contamination(docs.select(row, F.col(f"`{text_col}`").alias("_text")), benchmark, size,
                          "_text", spans=True, **names)
    ends = F.col("spans")
    n = F.size(ends)
    pieces = F.transform(F.sequence(F.lit(0), n), lambda i: F.substring(
        F.col("_text"),
        F.when(i == 0, 1).otherwise(F.get(F.get(ends, i - 1), F.lit(1)) + 1),
        F.when(i == n, F.char_length("_text")).otherwise(F.get(F.get(ends, i), F.lit(0)))
        - F.when(i == 0, 0).otherwise(F.get(F.get(ends, i - 1), F.lit(1)))))
    cleaned = F.when(n == 0, F.col("_text")).otherwise(F.array_join(pieces, " "))
    return (found.filter(F.col("n_hit") <= whole_share * F.col("n_words"))
            .withColumn("_text", cleaned)
            .select(*[F.col("_text" if c == text_col else f"_row.c{rest.index(c)}").alias(c) for c in docs.columns]))
