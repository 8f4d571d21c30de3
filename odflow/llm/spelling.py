"""Spelling variants: words one edit apart, found with an index of variable-length grams.

1. Words of all texts are counted where they lie (partial counts per task, then one aggregate).
2. Gram dictionary, pruned by frequency: a gram of ``Q_MIN`` symbols is used as it is if at most ``FREQUENT`` words
   hold it, else its occurrences are made longer by one symbol, and so on up to ``Q_MAX``. Only the frequent grams of fewer
   than ``Q_MAX`` symbols are kept; over this alphabet there are at most 92**2 + 92**3 of them, however many words.
3. A word, with a mark before and after it, is decomposed into the gram that starts at each of its places. Where a gram ends
   depends on its own symbols alone, so an edit only affects the grams that contain the edited place. The largest number of
   grams around one place bounds what one edit can affect; all others are shared with any word one edit apart.
4. List merging: a word is looked up and indexed by its rarest grams only, one more than that bound: two words that
   share all but so many grams share one of these. Keys hold the gram, its place and the word's length, as one
   edit moves a gram by one place at most. Long lists are dealt over several tasks.
5. Pairs that meet are verified by their edit distance. The word of the largest count among those one edit away is a word's form,
   if it occurs at least twice as often; forms are followed to their last by pointer doubling.

Rarity is read from hashed counters, which only decides how many pairs meet, never which are found.

Joins whose sides both grow with the words are sort-merge joins by hint. Spark sizes a side by the stored file it came from, which knows
nothing of the rows that task functions and explode make of it, nor of its compression, and would send a large one through the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.textarrays import ASCII_LOWER, slabs
from odflow.store import Store

#: Fixed values of the task: letters, one in how many runs loses a code point, least length and count of a word.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
ONE_IN, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3
#: Gram lengths. Words of 5 letters have 6 grams, of which one edit affects at most Q_MAX.
Q_MIN, Q_MAX = 2, 4
#: A gram that more words hold is made longer.
FREQUENT = 64
_BEFORE, _AFTER = "\x01", "\x02"
_COUNTERS = 1 << 18
#: Entries a task holds before it sends them on, and rows of one list that one task meets.
_HELD, _LIST = 500_000, 4096
_PLACE = (1 << 15) - 1


# ------------------------------------------------------------------------- words

def _count_words(ids, texts):
    """Word -> occurrences of some documents (texts lower-cased)."""
    for doc, text in zip(ids, texts):
        start = crc32(f"{'' if doc is None else doc}:".encode())
        for run, n in Counter(_RUN.findall(text)).items():
            if len(run) < LEAST_LENGTH:
                continue
            h = crc32(run.encode(), start)
            if h % ONE_IN == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < LEAST_LENGTH:
                    continue
            yield run, n


def _flush(counts: dict, kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(list(counts), kind), pa.array(list(counts.values()), pa.int64())], names)
    counts.clear()
    return out


def _word_counts(batches):
    """Task function: (id, text) -> partial (word, n)."""
    counts: dict = {}
    for batch in batches:
        for i, j, data, off in slabs(batch.column(1)):
            low = ASCII_LOWER[data].tobytes()
            texts = (low[a:b].decode() for a, b in zip(off[:-1].tolist(), off[1:].tolist()))
            for word, n in _count_words(batch.column(0).slice(i, j - i).to_pylist(), texts):
                counts[word] = counts.get(word, 0) + n
            if len(counts) > _HELD:
                yield _flush(counts, pa.string(), ["word", "n"])
    yield _flush(counts, pa.string(), ["word", "n"])


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough."""
    parts = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return (parts.mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= LEAST_COUNT))


# ------------------------------------------------------------------------- grams

def short_grams(word: str):
    """All grams of a word that may have to be made longer."""
    w = _BEFORE + word + _AFTER
    for q in range(Q_MIN, Q_MAX):
        for p in range(len(w) - q + 1):
            yield w[p:p + q]


def decompose(word: str, frequent: set) -> list[str]:
    """The gram at each place of the marked word: the shortest one that is not frequent, at most ``Q_MAX`` symbols."""
    w = _BEFORE + word + _AFTER
    out = []
    for p in range(len(w) - Q_MIN + 1):
        q = Q_MIN
        while q < Q_MAX and p + q < len(w) and w[p:p + q] in frequent:
            q += 1
        out.append(w[p:p + q])
    return out


def affected(grams: list[str]) -> int:
    """The largest number of grams that contain one place of the word: no edit changes more of them."""
    change = [0] * (len(grams) + Q_MAX + 1)
    for p, g in enumerate(grams):
        change[p] += 1
        change[p + len(g)] -= 1
    most = here = 0
    for p in range(len(grams) + 1):  # the places of the marked word
        here += change[p]
        if 0 < p < len(grams):  # letters
            most = max(most, here)
    return most


def _number(gram: str) -> int:
    return int.from_bytes(gram.encode("latin-1"), "little")


def key_grams(word: str, frequent: set, rarity: np.ndarray) -> list[tuple[int, int]]:
    """(gram, place) of the rarest grams of a word, one more than an edit can affect."""
    grams = decompose(word, frequent)
    order = []
    for place, gram in enumerate(grams):
        g = _number(gram)
        order.append((rarity[crc32(gram.encode("latin-1")) % _COUNTERS], g, place))
    order.sort()
    return [(g, place) for _, g, place in order[:affected(grams) + 1]]


def _key(gram: int, place: int, length: int) -> int:
    """One number for a gram at a place of a word of a length; exact for words of less than 32,768 letters."""
    return gram | (place & _PLACE) << 32 | (length & _PLACE) << 47


def _gram_counts(batches):
    """Task function: word -> partial (gram, n) of the grams that may be frequent."""
    counts: dict = {}
    for batch in batches:
        for word in batch.column(0).to_pylist():
            for g in set(short_grams(word)):
                counts[g] = counts.get(g, 0) + 1
            if len(counts) > _HELD:
                yield _flush(counts, pa.string(), ["gram", "n"])
    yield _flush(counts, pa.string(), ["gram", "n"])


def _counters(shared):
    """Task function: word -> (counter, n) of the hashed counters of grams."""

    def run(batches):
        total = np.zeros(_COUNTERS, dtype=np.int64)
        for batch in batches:
            for word in batch.column(0).to_pylist():
                for g in decompose(word, shared.value):
                    total[crc32(g.encode("latin-1")) % _COUNTERS] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    return run


def _keys(shared, rarity, asking: bool):
    """Task function: (word, n) -> rows (key, word, n), to be looked up in a word of the same length or one longer, or to be found."""

    def run(batches):
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys, at = [], []
            for k, word in enumerate(words):
                size = len(word)
                for g, place in key_grams(word, shared.value, rarity.value):
                    keys.append(_key(g, place, size))
                    if asking:
                        keys += [_key(g, place, size + 1), _key(g, place + 1, size + 1)]
                at += [k] * (len(keys) - len(at))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(0).take(rows), batch.column(1).take(rows)],
                                             ["key", "word", "n"])

    return run


# ------------------------------------------------------------------------- pairs

def near_words(words: DataFrame, store: Store) -> DataFrame:
    """(a, na, b, nb): all pairs of ``words`` (word, n) that differ by exactly one inserted, deleted or replaced code point, each once."""
    spark = words.sparkSession
    plain = words.select("word")
    grams = plain.mapInArrow(_gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > FREQUENT)
    frequent = spark.sparkContext.broadcast({r["gram"] for r in grams.collect()})  # bounded by the alphabet, see above
    counted = plain.mapInArrow(_counters(frequent), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(_COUNTERS, dtype=np.int64)
    for r in counted:  # at most _COUNTERS rows
        table[r["at"]] = r["n"]
    rarity = spark.sparkContext.broadcast(table)
    schema = "key long, word string, n long"
    found = store.cut(words.select("word", "n").mapInArrow(_keys(frequent, rarity, False), schema))
    asked = words.select("word", "n").mapInArrow(_keys(frequent, rarity, True), schema)
    # Long lists are dealt over tasks by a salt; who looks there meets every part. Their keys are fewer than
    # one in _LIST of the rows of ``found``, so this table alone may be broadcast.
    longer = store.cut(found.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > _LIST).select(
        "key", F.ceil(F.col("c") / _LIST).alias("salts")))
    one = F.lit(1).cast("long")
    dealt = found.join(longer, "key", "left").select(
        "key", F.pmod(F.xxhash64("word"), F.coalesce("salts", one)).alias("salt"), F.col("word").alias("b"), F.col("n").alias("nb"))
    looking = asked.join(longer, "key", "left").select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", one) - 1)).alias("salt"), F.col("word").alias("a"), F.col("n").alias("na"))
    met = looking.join(dealt.hint("merge"), ["key", "salt"]).filter(
        (F.col("a") != F.col("b")) & ((F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b")))
        & (F.levenshtein("a", "b", 1) >= 0))
    return store.cut(met.select("a", "na", "b", "nb").distinct())


def _roots(forms: DataFrame, store: Store) -> DataFrame:
    """(word, root) of the words that have a form: the last word that following forms leads to."""
    now = store.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        a, b = now.alias("a"), now.alias("b")
        after = store.cut(a.join(b.hint("merge"), F.col("a.root") == F.col("b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.word").isNotNull().alias("moved")))
        store.drop(now)
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = store.cut(after.select("word", "root"))
        store.drop(after)


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word.

    Words are runs of letters (A-Z, a-z, U+00C0 to U+00FF), lower-cased within A-Z, of at least 5 code points and 3 occurrences in all
    texts; one in 97 runs of a document, chosen by the crc32 of ``<doc_id>:<run>``, has lost the code point that the same number names.
    n_near counts the words one edit away; form is the one of them with the largest n (ties: smallest in code-point order) if that
    is at least twice the word's n, else null, as is form_n; root follows forms to the last, and is the word itself without one.

    Null and empty texts have no words; a null id counts as empty text in the crc32. Repeated rows count each. Other columns
    are not read; an empty table gives an empty result.
    """
    store = Store(docs.sparkSession, "spelling")
    words = store.cut(word_counts(docs, id_col, text_col))
    pairs = near_words(words, store)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("top"))
    takes = F.col("top.less") <= -2 * F.col("n")
    formed = store.cut(words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, F.col("top.other")).alias("form"), F.when(takes, -F.col("top.less")).alias("form_n")))
    roots = _roots(formed.filter("form is not null"), store)
    return formed.join(roots.hint("merge"), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
