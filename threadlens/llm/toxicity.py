"""Operator 2, toxicity by FTRL-proximal logistic regression.

Features: hashed words (A-Z lower-cased, parted by anything but letters,
digits and non-ASCII bytes), pairs of neighbours and skip-grams (a word and the
next but one), each present or absent in a document. FTRL-proximal keeps a
learning rate per coordinate; its L1 term leaves most weights exactly zero, so
the model travels as a short list of (feature, weight).

Training uses at most ``sample`` labelled documents (documented bound; the
labelled rows of least hash), and only rows with crc32(doc_id as text) modulo
``folds`` other than ``held_out``. Every document is scored, on its whole text.
Null and empty texts get the bias alone. Without labels the score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm import common as C

BITS = 20


def _parting() -> np.ndarray:
    part = np.ones(256, dtype=bool)
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        part[lo:hi] = False
    return part


def features(data: np.ndarray, offs: np.ndarray, bits: int = BITS):
    """(feature, document) of every occurrence."""
    _, _, h, ptr = C.words(data, offs, lower=True, space=_parting())
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(ptr))
    feats, docs = [h], [doc]
    for gap, salt in ((1, 0x5BD1E995), (2, 0x1B873593)):
        if len(h) > gap:
            same = doc[gap:] == doc[:-gap]
            both = C.mix(h[:-gap] * np.uint64(3) + C.mix(h[gap:] + np.uint64(salt)))
            feats.append(both[same])
            docs.append(doc[gap:][same])
    return (np.concatenate(feats) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(docs)


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int, alpha: float, beta: float,
         l1: float, l2: float, bits: int = BITS):
    """Weights (features, values, bias) after some passes over (features, label)."""
    dim = 1 << bits
    z, n = np.zeros(dim + 1), np.zeros(dim + 1)

    def weight(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) > l1, w, 0.0)

    def bias():
        return -z[dim] / ((beta + np.sqrt(n[dim])) / alpha)

    for _ in range(epochs):
        for i, y in rows:
            w, b = weight(i), bias()
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -35, 35)))
            g = p - y
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - step * w
            n[i] += g * g
            z[dim] += g - (np.sqrt(n[dim] + g * g) - np.sqrt(n[dim])) / alpha * b
            n[dim] += g * g
    w = weight(np.arange(dim))
    some = np.flatnonzero(w)
    return some, w[some], float(bias())


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = 12_000, folds: int = 4,
          held_out: int = 2, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0,
          l1: float = 4.0, l2: float = 0.0):
    """(features, weights, bias) learnt from a bounded sample, in one task."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .where(F.crc32(F.col("doc_id").cast("string")) % folds != held_out)
              .groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = C.whole(docs).join(F.broadcast(chosen), "doc_id").select("text", "doc_id", "y")

    def extract(batches):
        for batch in batches:
            data, offs = C.strings(batch.column(0))
            f, d = features(data, offs)
            key = np.unique((d << BITS) | f)
            ptr = np.searchsorted(key >> BITS, np.arange(batch.num_rows + 1))
            f = (key & ((1 << BITS) - 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2),
                 pa.array([f[ptr[i]:ptr[i + 1]].tobytes() for i in range(batch.num_rows)], pa.binary())],
                names=["doc_id", "y", "f"])

    def fit(table):
        order = np.argsort(C.mix(np.asarray(table.column("doc_id")).astype(np.uint64)), kind="stable")
        f, y = table.column("f").to_pylist(), table.column("y").to_pylist()
        rows = [(np.frombuffer(f[i], np.int32), y[i]) for i in order.tolist()]
        i, w, b = ftrl(rows, epochs, alpha, beta, l1, l2)
        del rows, f
        C.give_back()
        return pa.table({"i": [i.astype(np.int64).tobytes()], "w": [w.tobytes()], "b": [b]})

    model = (rows.mapInArrow(C.lean(extract), "doc_id long, y int, f binary")
             .groupBy(F.lit(0).alias("one")).applyInArrow(fit, "i binary, w binary, b double").first())
    if model is None:
        return np.zeros(0, np.int64), np.zeros(0), 0.0
    return np.frombuffer(model.i, np.int64), np.frombuffer(model.w), model.b


def score(docs: DataFrame, model, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score (and ``extra`` columns) of every document."""
    at, weights, bias = model
    base = docs.where(F.col("doc_id").isNotNull()).select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
        F.col("doc_id").cast("long").alias("doc_id"), *extra)
    schema = base.drop("_text").schema.add("score", "double")

    def run(batches):
        w = np.zeros(1 << BITS)
        w[at] = weights
        for batch in batches:
            data, offs = C.strings(batch.column(0))
            total = np.full(batch.num_rows, bias)
            for i, j in C.pieces(offs, 1 << 20):
                f, d = features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                use = w[f] != 0
                key = np.unique((d[use] << BITS) | f[use])
                total[i:j] += np.bincount(key >> BITS, weights=w[key & ((1 << BITS) - 1)], minlength=j - i)
            p = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(1, batch.num_columns)] + [pa.array(p)],
                names=[*batch.schema.names[1:], "score"])

    C.small_batches(docs.sparkSession)
    return base.mapInArrow(C.lean(run), schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 4,
             held_out: int = 2, **options) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, folds=folds, held_out=held_out, **options)
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    return score(docs, model).select(
        "doc_id", (fold == held_out).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
