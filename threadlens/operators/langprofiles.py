"""Language identification by character trigrams (naive Bayes over profiles).

A profile counts, per language, the trigrams of the training texts: runs of
characters that are no letters count as one blank, so words need no blanks
between them and scripts without any are told too. Training is one pass with a
combined count per task and one group-by over distinct (language, trigram)
pairs. The table is bounded by the alphabets: its size is counted, and checked
against ``MAX_BYTES``, before it is brought together and sent to the workers.
Scoring is one Arrow function a batch (sorted trigram keys, array sums): nothing
of a text crosses the network, a row keeps its partition. (A trigram a character
as a row each in the JVM is an order of magnitude more work.)

score(text, l) = ln prior_l - n * ln(T_l + V) + sum over trigrams of ln(c_l + 1)

n: the text's trigrams that any language has, T_l: all of l, V: distinct ones.
The best score wins, of equal ones the first label by name. A text without known
trigrams (NULL, under three characters, other scripts) has no language: NULL.
Rows without label do not train.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.operators.langid import MAX_LABELS
from threadlens.session import small_batches

MAX_BYTES = 256 << 20
HELD = 1_000_000                                             # counts a task combines before it passes them on
BLOCK = 1 << 18                                              # characters looked at together
ROWS = 200                                                   # texts that are Python strings together


def gram_text(c) -> Column:
    """What trigrams are taken of: letters as they are, one blank for all else between them."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"[^\p{L}]+", " ")


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(key of each trigram, row it is of); no trigram spans two texts."""
    texts = [t or "" for t in texts]
    size = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(texts)), size)
    inside = row[:-2] == row[2:]
    keys = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
    return keys[inside], row[:-2][inside]


def blocks(texts: list[str | None]):
    """(places, parts) of about ``BLOCK`` characters; parts of a longer text share the two
    characters at a cut, so that each of its trigrams lies in exactly one."""
    places, parts, size = [], [], 0
    for k, t in enumerate(texts):
        for at in range(0, max(len(t or "") - 2, 0), BLOCK):
            part = t[at:at + BLOCK + 2]
            if parts and size + len(part) > BLOCK:
                yield places, parts
                places, parts, size = [], [], 0
            places.append(k)
            parts.append(part)
            size += len(part)
    if parts:
        yield places, parts


@dataclass
class TrigramProfiles:
    labels: list[str]
    priors: list[float]                                      # ln prior
    totals: list[float]                                      # ln(T_l + V)
    keys: np.ndarray = field(repr=False)                     # sorted trigram keys
    weights: np.ndarray = field(repr=False)                  # ln(c_l + 1), a row for each key

    def predict(self, texts: list[str | None]) -> list[str | None]:
        n = np.zeros(len(texts), dtype=np.int64)
        sums = np.zeros((len(texts), len(self.labels)))
        for places, parts in blocks(texts) if len(self.keys) else ():
            keys, row = trigrams(parts)
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[place] == keys
            place, many = place[known], np.bincount(row[known], minlength=len(parts))
            some = np.flatnonzero(many)
            if len(some):                                    # a part's sum does not depend on its neighbours
                start = (np.cumsum(many) - many)[some]
                of = np.array(places)[some]
                np.add.at(n, of, many[some])
                for k in range(len(self.labels)):
                    np.add.at(sums[:, k], of, np.add.reduceat(self.weights[place, k], start))
        scores = np.array(self.priors) - n[:, None] * np.array(self.totals) + sums
        best = scores.argmax(axis=1) if self.labels else np.zeros(len(texts), dtype=int)
        return [self.labels[b] if m else None for b, m in zip(best.tolist(), n.tolist())]

    def column(self, text) -> Column:
        """The language of a text column (``gram_text`` form)."""
        @F.arrow_udf("string")
        def language(s: pa.Array) -> pa.Array:
            got: list[str | None] = []
            for at in range(0, len(s), ROWS):
                got += profiles.predict(s.slice(at, ROWS).to_pylist())
            return pa.array(got, pa.string())
        profiles = self
        return language(F.col(text) if isinstance(text, str) else text)


def _counts(batches):
    """Partial counts of (label, trigram); a task combines what it can hold."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush():
        for label, (keys, c) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(keys), pa.string()), pa.array(keys), pa.array(c)],
                                             names=["label", "gram", "c"])
        held.clear()

    for part in (batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS)):
        labels, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
        for label in sorted(set(labels)):
            for _, parts in blocks([t for x, t in zip(labels, texts) if x == label]):
                new, c = np.unique(trigrams(parts)[0], return_counts=True)
                if label in held:
                    new, c = np.concatenate([held[label][0], new]), np.concatenate([held[label][1], c])
                    new, at = np.unique(new, return_inverse=True)
                    c = np.bincount(at, weights=c)
                held[label] = new, c.astype(np.int64)
                if sum(len(k) for k, _ in held.values()) > HELD:
                    yield from flush()
    yield from flush()


def train_profiles(docs: DataFrame, text: str, label: str, max_bytes: int = MAX_BYTES) -> TrigramProfiles:
    """Profiles of the labels of ``docs`` from its texts (``gram_text`` form).

    A Python worker holds one Arrow batch, the model, and arrays for ``BLOCK``
    characters and ``HELD`` counts, however many texts there are."""
    small_batches(docs.sparkSession)
    labelled = docs.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), F.col(text).alias("t"))
    priors = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LABELS + 1).collect()
    if len(priors) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    labels = sorted(r["label"] for r in priors)
    n = {r["label"]: r["n"] for r in priors}
    counts = (labelled.where(F.length("t") >= 3).mapInArrow(_counts, "label string, gram long, c long")
              .groupBy("label", "gram").agg(F.sum("c").alias("c")).persist())
    try:
        distinct = counts.select("gram").distinct().count()
        size = distinct * 8 * (len(labels) + 1)
        if size > max_bytes:
            raise ValueError(f"profiles take {size} bytes, more than {max_bytes}")
        got = counts.toPandas()                              # at most ``size`` in all
    finally:
        counts.unpersist()
    keys = np.unique(got["gram"].to_numpy(dtype=np.int64))
    table = np.zeros((len(keys), len(labels)))
    place = np.searchsorted(keys, got["gram"].to_numpy(dtype=np.int64))
    which = got["label"].map({x: k for k, x in enumerate(labels)}).to_numpy(dtype=np.int64)
    table[place, which] = got["c"].to_numpy(dtype=np.float64)
    totals = table.sum(axis=0)
    every = sum(n.values())
    return TrigramProfiles(labels, [math.log(n[x] / every) for x in labels],
                           [math.log(t + len(keys)) if t + len(keys) else 0.0 for t in totals.tolist()],
                           keys, np.log(table + 1.0))
