"""Bounded samples of labelled documents, fitting a classifier on one in a task, and a small logistic fit."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.columns import fraction_text
from odflow.llm.workers import tidy


def held_out(id_col: str):
    """True where crc32 of the id as text leaves 1 modulo 3; such rows are never learnt from."""
    return F.coalesce(fraction_text(F.col(f"`{id_col}`")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(at, y, text) of at most ``per_class`` ids of each class, chosen by a hash ``at`` of the ids.

    Rows held out, null labels and ids, ids with two different labels, empty texts and texts over
    ``max_chars`` characters are left out; of repeated ids one text counts.
    """
    ids = (labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("_id")).agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("z"))
           .filter("y = z").drop("z").filter(~held_out("_id"))
           .join(docs.select(F.col(f"`{id_col}`").alias("_id")), "_id", "left_semi")
           .withColumn("at", F.md5(F.col("_id").cast("string").cast("binary"))))
    chosen = ids.filter("y = 0").orderBy("at").limit(per_class).unionByName(ids.filter("y = 1").orderBy("at").limit(per_class))
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text")).filter(
        (F.char_length("text") > 0) & (F.char_length("text") <= max_chars))
    return texts.join(F.broadcast(chosen), "_id").select("at", "y", "text")  # at most 2 * per_class ids


def fit_in_task(sample: DataFrame, fit: Callable):
    """``fit`` of the sample's (text, label) pairs in the order of ``at``, run in one task; the model comes back pickled.

    The sample is bounded, so neither that task nor the driver holds more with more input.
    """

    def run(batches):
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        one = {at: (text, y) for at, y, text in rows}
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(list(one.values())))], pa.binary())], ["model"])

    row = sample.select("at", "y", "text").repartition(1).mapInArrow(tidy(run), "model binary").first()
    return fit([]) if row is None else pickle.loads(row["model"])


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60, base: np.ndarray | float = 0.0) -> np.ndarray:
    """Weights (last one the constant) of a logistic regression by Newton steps; classes weigh as they are. ``base`` is
    added to every row's sum."""
    x = np.column_stack([x, np.ones(len(x))])
    w, pen = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * max(1, len(x)) / 100)
    pen[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w + base, -35, 35)))
        grad = x.T @ (p - y) + pen * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pen + 1e-9)
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        w -= step * min(1.0, 4.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return w


def rising_fit(x: np.ndarray, y: np.ndarray, least: float, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression whose weights (not the constant) are ``least`` or more: the likeliest fit over all choices of columns
    held at ``least``. For a handful of columns."""
    best, loss, n = None, np.inf, x.shape[1]
    for held in range(1 << n):
        free = np.array([k for k in range(n) if not held >> k & 1], dtype=int)
        w = np.full(n + 1, least)
        fitted = logistic_fit(x[:, free], y, ridge, base=least * np.delete(x, free, axis=1).sum(axis=1))
        w[free], w[-1] = fitted[:-1], fitted[-1]
        if (w[:-1] < least - 1e-9).any():
            continue
        z = np.clip(x @ w[:-1] + w[-1], -35, 35)
        cost = np.logaddexp(0, np.where(y == 1, -z, z)).sum() + ridge * max(1, len(x)) / 200 * (w[:-1] ** 2).sum()
        if cost < loss:
            best, loss = w, cost
    return best


def logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -35, 35)))
