"""Toxicity by a subsequence string kernel: Nystroem landmarks and a linear support vector machine.

The unit of text is a word without the punctuation around or inside it (and a run of single
letters, joined: "i d i o t"). Units are compared by the gap-weighted subsequence kernel of order
``ORDER``: all common subsequences of that many characters, each weighted ``DECAY`` to the
length it spans in both strings, so a word with inserted characters stays close to the
original. Landmarks are short strings typical of sentences from toxic documents; a unit is its kernel
values with them, mapped by the inverse square root of the landmarks' own kernel (Nystroem). A
linear SVM gives units a margin, and a sentence is as bad as its worst unit. The SVM is trained on
the sentences of labelled documents: all units of clean documents are on the clean side, and
which sentences of a toxic document are toxic is settled in turns with the fit. A document's worst
sentences and its units on the toxic side go through a logistic calibration whose weights are positive, so a
text never scores lower for one more unit on the toxic side, and one without any has the lowest score. (Letters
spaced out in two words in a row are one run, so the second word may hide the first.)

Kernel values of a unit and a landmark that share too few characters to matter count as 0; each
distinct unit is evaluated once per worker. Texts are scored where they lie.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.llm.textarrays import ASCII_LOWER, NOT_SPACE, mix, slabs, word_hashes, word_spans
from odflow.llm.training import fit_in_task, held_out, labelled_sample, logistic, rising_fit
from odflow.llm.workers import tidy

ORDER, DECAY = 3, 0.6
#: Units longer than this are compared in overlapping parts of this length.
UNIT_CHARS = 24
LANDMARKS, CONFUSABLE, PER_CLASS, MAX_CHARS = 64, 48, 1200, 40_000
#: A pair is evaluated when the unit has this share of the landmark's characters, in their order;
#: smaller values than ``LEAST_VALUE`` count as 0.
SHARED, LEAST_VALUE = 0.7, 0.2
#: Units with less than this value with every typical landmark are clean.
LIKE = 0.35
#: Strings at least so many times as frequent in toxic texts as in others may become landmarks.
RATIO = 8
#: Margin from which a unit counts as toxic in a text's evidence.
SURE = 0.4
#: Worst sentences of a text that its score looks at.
WORST = 3
EVIDENCE = WORST + 2
#: Every kind of evidence weighs at least this much in the calibration, so no score falls with more of it.
LEAST_WEIGHT = 0.05
THRESHOLD = 0.7
SVM_COST, RIDGE = 100.0, 0.03
KEPT_UNITS = 200_000

_INNER = re.compile(r"[\W_]+")


def clean_unit(word: str) -> str:
    """Lower-case letters and digits of a word between the markers ^ and $; empty without any."""
    own = _INNER.sub("", word.lower())
    return f"^{own}$" if own else ""


def _parts(unit: str) -> list[str]:
    if len(unit) <= UNIT_CHARS:
        return [unit]
    return [unit[i:i + UNIT_CHARS] for i in range(0, len(unit) - UNIT_CHARS // 2, UNIT_CHARS // 2)]


def _codes(strings: list[str], width: int, pad: int) -> np.ndarray:
    """Code points of strings as rows of one matrix, padded with ``pad`` (which matches nothing else)."""
    out = np.full((len(strings), width), pad, dtype=np.int32)
    lens = np.array([len(s) for s in strings], dtype=np.int64)
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    row = np.repeat(np.arange(len(strings)), lens)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out


def subsequence_kernel(s: np.ndarray, t: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted subsequence kernel of row pairs of two code matrices (padding must not match)."""
    s, t = np.ascontiguousarray(s.T), np.ascontiguousarray(t.T)
    same = s[:, None, :] == t[None, :, :]
    d2 = np.float32(decay * decay)
    decay = np.float32(decay)
    part = same * d2  # [i, j] weighs the common subsequences of one character that end at or before i and j
    for level in range(1, order):
        for j in range(1, part.shape[1]):
            part[:, j] += decay * part[:, j - 1]
        for i in range(1, part.shape[0]):
            part[i] += decay * part[i - 1]
        longer = np.zeros_like(part)
        np.multiply(part[:-1, :-1], d2, out=longer[1:, 1:], where=same[1:, 1:])
        part = longer
    return part.sum(axis=(0, 1), dtype=np.float32)


def _buckets(codes: np.ndarray) -> np.ndarray:
    """Characters as one of 64 hash buckets."""
    return (mix(codes.astype(np.int64).astype(np.uint64)) >> np.uint64(58)).astype(np.int64)


def _common_length(s: np.ndarray, length: np.ndarray, places: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of row pairs, bit-parallel: s as buckets, each landmark as the
    bit places of every bucket. Equal buckets count as equal, so it is never too small."""
    one = np.uint64(1)
    v = np.full(len(s), ~np.uint64(0))
    for i in range(s.shape[1]):
        m = np.where(i < length, places[np.arange(len(s)), s[:, i]], np.uint64(0))
        u = v & m
        v = (v + u) | (v - u)
    return np.bitwise_count(~v & ((one << width.astype(np.uint64)) - one))


@dataclass(frozen=True)
class Landmarks:
    strings: tuple[str, ...]
    codes: np.ndarray
    places: np.ndarray  # bits of the places of each character bucket
    masks: np.ndarray
    width: np.ndarray
    own: np.ndarray

    @classmethod
    def of(cls, strings: list[str]) -> "Landmarks":
        codes = _codes(strings, max(map(len, strings)), -2)
        places = np.zeros((len(strings), 64), dtype=np.uint64)
        width = np.array([len(x) for x in strings])
        for k, bucket in enumerate(_buckets(codes)):
            for i in range(width[k]):
                places[k, bucket[i]] |= np.uint64(1) << np.uint64(i)
        masks = ((places != 0).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        own = subsequence_kernel(codes, np.where(codes == -2, -3, codes))
        return cls(tuple(strings), codes, places, masks, width, np.maximum(own, 1e-6))

    def take(self, a: int, b: int) -> "Landmarks":
        return Landmarks(self.strings[a:b], self.codes[a:b], self.places[a:b], self.masks[a:b], self.width[a:b], self.own[a:b])

    def values(self, units: list[str]) -> np.ndarray:
        """Kernel of every unit with every landmark, over the landmark's kernel with itself."""
        out = np.zeros((len(units), len(self.strings)), dtype=np.float32)
        parts = sorted(((p, i) for i, u in enumerate(units) for p in _parts(u) if len(p) > ORDER), key=lambda x: len(x[0]))
        needed = np.ceil(SHARED * self.width).astype(np.int64)
        few = np.ceil((np.bitwise_count(self.masks) - (self.width - needed)).clip(min=1)).astype(np.int64)
        for a in range(0, len(parts), 8192):
            some = parts[a:a + 8192]
            unit, length = np.array([i for _, i in some]), np.array([len(p) for p, _ in some])
            codes = _codes([p for p, _ in some], int(length.max()), -1)
            bucket = _buckets(codes)
            bits = np.where(codes == -1, np.uint64(0), np.uint64(1) << bucket.astype(np.uint64))
            mask = np.bitwise_or.reduce(bits, axis=1)
            rows, cols = np.nonzero((np.bitwise_count(mask[:, None] & self.masks[None, :]) >= few[None, :])
                                    & (length[:, None] >= needed[None, :]))
            near = np.empty(len(rows), dtype=bool)
            for b in range(0, len(rows), 1 << 15):
                r, c = rows[b:b + (1 << 15)], cols[b:b + (1 << 15)]
                near[b:b + (1 << 15)] = _common_length(bucket[r], length[r], self.places[c], self.width[c]) >= needed[c]
            rows, cols = rows[near], cols[near]
            for b in range(0, len(rows), 4096):
                r, c = rows[b:b + 4096], cols[b:b + 4096]
                k = subsequence_kernel(codes[r], self.codes[c]) / self.own[c]
                np.maximum.at(out, (unit[r], c), np.where(k >= LEAST_VALUE, k, np.float32(0)))
        return np.minimum(out, np.float32(1.0))


class Units:
    """Distinct units seen so far, and texts as rows of (unit number, sentence, text)."""

    def __init__(self):
        self.number: dict[int, int] = {}  # of word hashes
        self.of: dict[str, int] = {}
        self.strings: list[str] = []

    def _add(self, unit: str) -> int:
        n = self.of.get(unit)
        if n is None:
            n = self.of[unit] = len(self.strings)
            self.strings.append(unit)
        return n

    def _numbers(self, hashes: np.ndarray, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(hashes), dtype=np.int64)
        for k, h in enumerate(hashes.tolist()):
            n = self.number.get(h)
            if n is None:
                n = self.number[h] = self._add(clean_unit(words[k].decode()))
            out[k] = n
        return out

    def split(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of a slab, by text; a sentence ends at a line's end or after a word ending in . ! or ?"""
        low = ASCII_LOWER[data]
        starts, ends, words = word_spans(low, off, NOT_SPACE)
        if not len(starts):
            return (np.zeros(0, np.int64),) * 3
        hashes, at, back = np.unique(word_hashes(low, starts, ends), return_index=True, return_inverse=True)
        raw = low.tobytes()
        numbers = self._numbers(hashes, [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        unit, text = numbers[back], np.repeat(np.arange(len(off) - 1), np.diff(words))
        line = np.cumsum(low == 10)[starts]
        stop = np.isin(low[ends - 1], np.frombuffer(b".!?", dtype=np.uint8))
        new = np.ones(len(starts), dtype=np.int64)
        new[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1]) | stop[:-1]
        sentence = np.cumsum(new) - 1
        # Three or more single letters in a row are one more unit, in the sentence of the first.
        single = np.flatnonzero(np.array([len(self.strings[n]) == 3 for n in numbers.tolist()])[back])
        runs = np.split(single, np.flatnonzero((np.diff(single) != 1) | (np.diff(text[single]) != 0)) + 1)
        found = [(self._add("^" + "".join(self.strings[n][1] for n in unit[r].tolist()) + "$"), r[0]) for r in runs if len(r) >= 3]
        if found:
            where = np.array([r for _, r in found])
            rows = np.concatenate((np.arange(len(unit)), where))
            order = np.argsort(rows, kind="stable")
            unit = np.concatenate((unit, [n for n, _ in found]))[order]
            sentence, text = sentence[rows[order]], text[rows[order]]
        return unit, sentence, text


def _near(landmarks: Landmarks, typical: int, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Units that are ``LIKE`` one of the first, typical landmarks, and their kernel values with all landmarks."""
    first, rest = landmarks.take(0, typical), landmarks.take(typical, len(landmarks.strings))
    found, values = [np.zeros(0, np.int64)], [np.zeros((0, len(landmarks.strings)), np.float32)]
    for a in range(0, len(units), 16384):
        v = first.values(units[a:a + 16384])
        some = np.flatnonzero(v.max(axis=1, initial=0) >= LIKE)
        found.append(some + a)
        values.append(np.concatenate((v[some], rest.values([units[a + i] for i in some.tolist()])), axis=1) if rest.strings else v[some])
    return np.concatenate(found), np.concatenate(values)


@dataclass(frozen=True)
class ToxicityModel:
    landmarks: Landmarks
    typical: int  # landmarks from toxic sentences come first; the others are clean units like them
    weights: np.ndarray  # of a unit's kernel values, the Nystroem map multiplied in
    constant: float
    scale: np.ndarray  # of the logistic calibration

    def margins(self, units: list[str]) -> np.ndarray:
        out = np.full(len(units), self.constant)
        some, values = _near(self.landmarks, self.typical, units)
        out[some] += values @ self.weights
        return out


def _whole(units: list[str]) -> np.ndarray:
    """Units of two characters or more."""
    return np.array([len(u) > 3 for u in units], dtype=bool)


def _evidence(margin: np.ndarray, whole: np.ndarray, sentence: np.ndarray, text: np.ndarray, n: int, constant: float) -> np.ndarray:
    """Rows of the logistic calibration: each text's worst sentences (a sentence is as bad as its worst unit), and its units that
    are surely toxic, as a count and as a percentage of them and the clean units (``whole`` ones, so not the letters of a spaced
    word). Another unit on the toxic side lowers none of them."""
    out = np.full((n, EVIDENCE), np.clip(constant, -2.0, 1.0))
    sure = np.bincount(text[margin > SURE], minlength=n)
    out[:, WORST] = np.log1p(sure)
    out[:, WORST + 1] = np.log1p(100 * sure / np.maximum(sure + np.bincount(text[whole & (margin <= 0)], minlength=n), 1))
    hit = np.flatnonzero(margin > constant)
    if len(hit):
        margin, sentence, text = margin[hit], sentence[hit], text[hit]
        first = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
        margin, text = np.maximum.reduceat(margin, first), text[first]
        order = np.lexsort((-margin, text))
        margin, text = margin[order], text[order]
        rank = np.arange(len(text)) - np.searchsorted(text, text)
        top = rank < WORST
        out[text[top], rank[top]] = np.clip(margin[top], -2, 1)
    return out


class Scorer:
    """Scores texts, keeping the margins of units from slab to slab up to a bound."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.units, self.margin, self.whole = Units(), np.zeros(0), np.zeros(0, dtype=bool)

    def evidence(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Rows of the calibration for every text of a slab."""
        if len(self.units.number) > KEPT_UNITS:
            self._forget()
        unit, sentence, text = self.units.split(data, off)
        new = self.units.strings[len(self.margin):]
        self.margin = np.concatenate((self.margin, self.model.margins(new)))
        self.whole = np.concatenate((self.whole, _whole(new)))
        return _evidence(self.margin[unit], self.whole[unit], sentence, text, len(off) - 1, self.model.constant)

    def scores(self, texts: pa.Array) -> np.ndarray:
        rows = [self.evidence(data, off) for _, _, data, off in slabs(texts)]
        return logistic(np.concatenate(rows), self.model.scale) if rows else np.zeros(0)


def _copies(units: list[np.ndarray]) -> np.ndarray:
    """Number of the first text with nearly the same units (half of 32 minimum hashes equal, one of 8 bands of 4)."""
    salts = mix(np.arange(1, 33, dtype=np.uint64))
    sig = np.array([[mix(u.astype(np.uint64) ^ s).min() if len(u) else s for s in salts] for u in units])
    first, seen = np.arange(len(units)), {}
    for i in range(len(units)):
        for band in range(8):
            key = (band, sig[i, 4 * band:4 * band + 4].tobytes())
            j = seen.setdefault(key, i)
            if j != i and (sig[i] == sig[j]).sum() >= 16:
                first[i] = min(first[i], first[j])
    return first


def _different(text: np.ndarray, unit: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The different (text, unit) pairs, by text."""
    pairs = np.unique(text.astype(np.int64) * n + unit)
    return pairs // n, pairs % n


def choose_landmarks(strings: list[str], unit: np.ndarray, text: np.ndarray, y: np.ndarray) -> list[str]:
    """Strings typical of units of toxic texts: greedily those that cover most of their tell-tale units.

    A unit is tell-tale when it is at least ``RATIO`` times as frequent in toxic texts (near copies count
    once) as in others; candidates are its substrings of 4 to 8 characters, its markers included, and
    the whole unit. Of equal ones the longest is taken.
    """
    of_text, of_unit = _different(text, unit, len(strings))
    per_text = np.split(of_unit, np.searchsorted(of_text, np.arange(1, len(y))))
    first = _copies(per_text)
    counts = {0: defaultdict(int), 1: defaultdict(int)}
    lone = [i for i in range(len(y)) if first[i] == i]
    for i in lone:
        for u in per_text[i].tolist():
            if len(strings[u]) >= 5:
                counts[int(y[i])][u] += 1
    n1, n0 = max(1, sum(y[i] == 1 for i in lone)), max(1, sum(y[i] == 0 for i in lone))
    telling = {strings[u]: c for u, c in counts[1].items() if c >= 2 and c / n1 >= RATIO * counts[0].get(u, 0) / n0}

    def parts(s: str) -> set[str]:
        return {s[i:i + n] for n in range(4, 9) for i in range(len(s) - n + 1)} | ({s} if len(s) <= 14 else set())

    holders = defaultdict(set)
    for s in telling:
        for p in parts(s):
            holders[p].add(s)
    other = defaultdict(int)
    for u, c in counts[0].items():
        for p in parts(strings[u]):
            if p in holders:
                other[p] += c
    gain = {p: sum(telling[s] for s in h) for p, h in holders.items()}
    cost = {p: RATIO * other.get(p, 0) * n1 / n0 for p in gain}
    # So many sightings that no string of as many as there are gathers them among toxic texts by chance.
    least = min(max(3.0, np.log(10 * max(1, len(counts[1]))) / np.log((n1 + n0) / n1)), max(2.0, 0.25 * n1))
    gain = {p: g for p, g in gain.items() if g >= max(least, cost[p])}
    chosen = []
    while gain and len(chosen) < LANDMARKS:
        best = max(gain, key=lambda p: (gain[p] - cost[p], len(p), p))
        if gain[best] < least:
            break
        chosen.append(best)
        for s in list(holders[best]):
            for p in parts(s):
                if p in gain and s in holders[p]:
                    holders[p].discard(s)
                    gain[p] -= telling[s]
        gain = {p: g for p, g in gain.items() if g >= max(least, cost[p])}
    return chosen


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Linear SVM with squared hinge by Newton steps on the rows inside the margin; last weight the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), np.diag(np.append(np.full(x.shape[1] - 1, penalty), 1e-6))
    for _ in range(40):
        inside = y * (x @ w) < 1
        xi, wi = x[inside], weight[inside]
        new = np.linalg.solve(ridge + (xi * wi[:, None]).T @ xi, xi.T @ (wi * y[inside]))
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return w


def _with_insertions(strings: tuple[str, ...]) -> list[str]:
    """Landmarks with one foreign character put in at each inner place."""
    return [s[:i] + "\u25a1" + s[i:] for s in strings for i in range(3, len(s) - 2)]


def fit(sample: list[tuple[str, int]]) -> ToxicityModel:
    """Fit on (text, label 0/1) pairs of documents; without typical strings every score is the share of label 1."""
    texts, y = pa.array([t for t, _ in sample], pa.string()), np.array([v for _, v in sample], dtype=np.int64)
    units, rows = Units(), []
    done = 0
    for i, j, data, off in slabs(texts):
        u, s, t = units.split(data, off)
        rows.append((u.astype(np.int32), (s + done).astype(np.int32), (t + i).astype(np.int32)))
        done += int(s[-1]) + 1 if len(s) else 0
    unit, sentence, text = (np.concatenate(c) if rows else np.zeros(0, np.int64) for c in (zip(*rows) if rows else ((), (), ())))
    chosen = choose_landmarks(units.strings, unit, text, y) if len(y) else []
    share = float(np.clip(y.mean() if len(y) else 0.02, 0.02, 0.98))
    typical = tuple(chosen)
    if not chosen or y.min() == y.max():
        return ToxicityModel(Landmarks.of(["^none$"]), 1, np.zeros(1), 0.0,
                             np.array([0.0] * EVIDENCE + [np.log(share / (1 - share))]))
    # The clean units most like them, frequent ones first, are landmarks too, so that both sides of the border are.
    of_text, of_unit = _different(text, unit, len(units.strings))
    clean = np.bincount(of_unit[y[of_text] == 0], minlength=len(units.strings))  # clean texts with each unit
    some, values = _near(Landmarks.of(chosen), len(chosen), units.strings)
    order = some[np.argsort(-(clean[some] + values.max(axis=1)), kind="stable")][:CONFUSABLE].tolist()
    chosen += [units.strings[k] for k in order if len(units.strings[k]) <= 20 and units.strings[k] not in chosen]
    marks = Landmarks.of(chosen)
    gram = np.array([subsequence_kernel(np.repeat(marks.codes[i:i + 1], len(chosen), axis=0),
                                        np.where(marks.codes == -2, -3, marks.codes)) for i in range(len(chosen))])
    gram = gram / np.sqrt(np.outer(marks.own, marks.own))
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    root = vector / np.sqrt(np.maximum(value, 0.05)) @ vector.T  # the Nystroem map
    some, values = _near(marks, len(typical), units.strings)
    x, at, strength = values @ root, np.full(len(units.strings), -1), np.zeros(len(units.strings))
    at[some], strength[some] = np.arange(len(some)), values[:, :len(typical)].max(axis=1)
    extra = _near(marks, len(typical), _with_insertions(typical))[1] @ root
    against = some[clean[some] > 0]
    of_toxic = np.flatnonzero((y[text] == 1) & (strength[unit] > 0))
    margin, w = strength - 0.9, None
    for _ in range(5):
        # A toxic sentence is one whose worst unit is on the toxic side; that unit stands for it.
        u, s = unit[of_toxic], sentence[of_toxic]
        order = np.lexsort((-margin[u], s))
        worst = u[order][np.concatenate(([True], np.diff(s[order]) > 0))] if len(u) else u
        support = np.bincount(worst[margin[worst] > 0], minlength=len(at))
        toxic = np.flatnonzero(support)
        rows = np.concatenate((x[at[toxic]], extra, x[at[against]], np.zeros((1, x.shape[1]))))
        label = np.concatenate((np.ones(len(toxic) + len(extra)), -np.ones(len(against) + 1)))
        weight = np.concatenate((support[toxic] / max(1, support.sum()), np.full(len(extra), 0.2 / max(1, len(extra))),
                                 clean[against] / max(1, clean[against].sum()), [0.2]))
        w = _svm(rows, label, SVM_COST * weight)
        before, margin = margin, np.full(len(at), w[-1])
        margin[some] += x @ w[:-1]
        if ((before > 0) == (margin > 0)).all():
            break
    rows = _evidence(margin[unit], _whole(units.strings)[unit], sentence, text, len(y), float(w[-1]))
    return ToxicityModel(marks, len(typical), root @ w[:-1], float(w[-1]), rising_fit(rows, y, LEAST_WEIGHT, RIDGE))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label: str = "toxic", per_class: int = PER_CLASS, keep_text: bool = False) -> DataFrame:
    """Documents with held_out, score and predicted (1 from a score of 0.7); same-named input columns are replaced.

    The text itself is kept only with ``keep_text``. Null and empty texts score as texts without any sentence; repeated rows
    are scored each for itself; null ids count as not held out; without labels every
    score is 0.02; an empty table gives an empty result.
    """
    model = fit_in_task(labelled_sample(docs, labels, label, per_class, MAX_CHARS, id_col, text_col), fit)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LANDMARKS short strings
    new = ("held_out", "score", "predicted")
    keep = [c for c in docs.columns if c not in new and (keep_text or c != text_col)]
    cols = [f"c{i}" for i in range(len(keep))]
    src = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, cols)], F.col(f"`{text_col}`").alias("_text"))

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            score = scorer.scores(batch.column(len(cols)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(cols)], pa.array(score, pa.float64())], [*cols, "score"])

    out = src.mapInArrow(tidy(run), T.StructType([*src.schema.fields[:-1], T.StructField("score", T.DoubleType())]))
    out = out.select(*[F.col(a).alias(c) for c, a in zip(keep, cols)], "score")
    return (out.withColumn("held_out", held_out(id_col) if id_col in keep else F.lit(False))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
            .select(*keep, "held_out", "score", "predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit_options) -> DataFrame:
    """The documents that are not predicted toxic, with the columns they came with."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    scored = toxicity_scores(docs.select(whole, F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")),
                             labels.withColumnRenamed(id_col, "_id"), "_id", "_text", **fit_options)
    return scored.filter("predicted = 0").select("_row.*")
