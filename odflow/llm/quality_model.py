"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are trained on a bounded sample of labelled documents. A text is compressed in
short blocks under either one; the difference of the two sizes per byte of text, together with
the compressed share and the length, goes through a logistic calibration to a score in 0..1.
Texts are scored where they lie, block by block, so memory stays bounded for any text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.llm.textarrays import slabs
from odflow.llm.training import fit_in_task, held_out, labelled_sample, logistic, logistic_fit

#: Sample bounds, dictionary size and zstandard parameters.
PER_CLASS, MAX_CHARS = 3000, 40_000
DICT_BYTES, PIECE, PIECES_PER_DOC = 112_640, 400, 12
BLOCK, LEVEL = 1000, 3
THRESHOLD = 0.5


def _dictionary(texts: list[bytes]) -> bytes:
    """Dictionary content from pieces spread evenly over each text."""
    pieces = []
    for t in texts:
        cuts = range(0, len(t), PIECE)
        keep = cuts[:: max(1, len(cuts) // PIECES_PER_DOC)][:PIECES_PER_DOC]
        pieces += [t[i:i + PIECE] for i in keep if len(t) - i >= 8]
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: its pieces are the dictionary
        return b"".join(pieces)[-DICT_BYTES:] or b"\x00" * 8


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(content)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)


def _features(n: int, good: int, bad: int) -> list[float]:
    d, r, size = (bad - good) / max(n, 1), (good + bad) / (2 * max(n, 1)), np.log1p(n)
    r = min(r, 1.5)
    return [d, d * size, max(d, 0.0), r, r * r, 1 / (0.05 + r), size, size * size, d / (0.02 + r)]


def _sizes(text: memoryview, compressors) -> tuple[int, int]:
    good = bad = 0
    for i in range(0, len(text), BLOCK):
        block = text[i:i + BLOCK]
        good += len(compressors[0].compress(block))
        bad += len(compressors[1].compress(block))
    return good, bad


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, texts: pa.Array, compressors=None) -> np.ndarray:
        """Score of every text; null counts as empty."""
        both, x = compressors or (_compressor(self.good), _compressor(self.bad)), []
        for i, j, data, off in slabs(texts):
            raw = memoryview(data)
            for k in range(j - i):
                t = raw[off[k]:off[k + 1]]
                x.append(_features(len(t), *_sizes(t, both)))
        if not x:
            return np.zeros(0)
        return logistic((np.array(x) - self.mean) / self.scale, self.weights)


def fit(sample: list[tuple[str, int]]) -> QualityModel:
    """Fit on (text, label 0/1) pairs; without one of the classes every score is the share of label 1 (or 0.5)."""
    texts, y = [t.encode() for t, _ in sample], np.array([v for _, v in sample], dtype=float)
    good, bad = [t for t, v in zip(texts, y) if v == 1], [t for t, v in zip(texts, y) if v == 0]
    width = len(_features(1, 1, 1))
    if not good or not bad:
        share = np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98)
        w = np.zeros(width + 1)
        w[-1] = np.log(share / (1 - share))
        return QualityModel(_dictionary(good), _dictionary(bad), np.zeros(width), np.ones(width), w)
    fold, x = np.arange(len(texts)) % 2, np.zeros((len(texts), width))
    for f in (0, 1):  # a document is never measured with a dictionary that has seen it
        own = [_compressor(_dictionary([t for t, v, g in zip(texts, y, fold) if v == c and g != f])) for c in (1, 0)]
        for i in np.flatnonzero(fold == f):
            x[i] = _features(len(texts[i]), *_sizes(memoryview(texts[i]), own))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return QualityModel(_dictionary(good), _dictionary(bad), mean, scale, logistic_fit((x - mean) / scale, y))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label: str = "quality", per_class: int = PER_CLASS) -> DataFrame:
    """Documents (all columns but the text; same-named inputs replaced) with held_out, score and predicted.

    Null and empty texts get the model's score of the empty text; repeated rows are scored each for
    itself; null ids count as not held out; without labels every score is 0.5; an empty table gives an empty result.
    """
    model = fit_in_task(labelled_sample(docs, labels, label, per_class, MAX_CHARS, id_col, text_col), fit)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of at most DICT_BYTES
    new = ("held_out", "score", "predicted")
    keep = [c for c in docs.columns if c not in new and c != text_col]
    cols = [f"c{i}" for i in range(len(keep))]
    src = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, cols)], F.col(f"`{text_col}`").alias("_text"))

    def run(batches):
        own = shared.value
        both = (_compressor(own.good), _compressor(own.bad))
        for batch in batches:
            score = own.scores(batch.column(len(cols)), both)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(cols)], pa.array(score)], [*cols, "score"])

    out = src.mapInArrow(run, T.StructType([*src.schema.fields[:-1], T.StructField("score", T.DoubleType())]))
    out = out.select(*[F.col(a).alias(c) for c, a in zip(keep, cols)], "score")
    return (out.withColumn("held_out", held_out(id_col) if id_col in keep else F.lit(False))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
            .select(*keep, "held_out", "score", "predicted"))
