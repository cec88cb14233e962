"""Operator 8, substring dedup by difference-cover anchors.

A window is ``length`` consecutive words of one document; a word is removed if
a window covering it has the same word sequence as a window starting anywhere
else (same document included). Windows are judged on the input.

Anchors: hashes of ``length - period + 1`` words, taken only where the word's
position modulo ``period`` lies in a difference cover. For any two positions
some shift below ``period`` brings both onto the cover, so two equal windows
always share an aligned anchor. Only windows with an anchor that occurs again
are extended to the full length and compared by a 128-bit hash of their words.

Both comparisons work on whole tables: chunks of documents send their distinct
marks to buckets and get a bit for each one back. A mark that a chunk holds
twice needs no answer, so a hot passage costs a bucket at most one entry a
chunk. Three passes over the packed texts, two small shuffles.

Null or empty texts have no words: n_words 0, nothing removed, hash of the
empty string. Repeated rows are documents of their own. Empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm import common as C

#: Perfect difference sets: every residue modulo the period is a difference of two members.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
ANCHOR, WINDOW = 1, 2


class _Doc:
    """Word hashes of a chunk and its anchors."""

    def __init__(self, chunk: C.Chunk, length: int, period: int):
        self.starts, self.ends, self.h, self.ptr = C.words(chunk.data, chunk.offs, lower=False)
        n, count = len(self.h), np.diff(self.ptr)
        doc = np.repeat(np.arange(len(count)), count)
        self.at = np.arange(n) - self.ptr[:-1][doc]          # position in its document
        self.left = count[doc] - self.at                     # words from here to its document's end
        self.roll = C.Roll(self.h)
        self.span = length - period + 1
        on = np.isin(self.at % period, COVERS[period]) & (self.left >= self.span)
        self.anchor = np.flatnonzero(on)
        self.marks = C.mix(self.roll.span(self.anchor, self.anchor + self.span))

    def windows(self, yes: np.ndarray, length: int) -> np.ndarray:
        """Starts of windows that hold a repeated anchor."""
        hot = np.zeros(len(self.h) + 1, dtype=np.int64)
        hot[self.anchor[yes] + 1] = 1
        hot = np.cumsum(hot)                                 # hot anchors before a position
        start = np.flatnonzero(self.left >= length)
        last = start + length - self.span + 1                # an anchor must start before this
        return start[hot[last] > hot[start]]


class _Pairs:
    """Distinct 128-bit window hashes of a chunk, dealt to buckets."""

    def __init__(self, d: _Doc, start: np.ndarray, length: int, buckets: int):
        a = C.mix(d.roll.span(start, start + length))
        b = C.mix(C.Roll(C.mix(d.h), C.BASE_B).span(start, start + length))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        group = np.cumsum(new) - 1
        self.inverse = np.empty(len(a), dtype=np.int64)
        self.inverse[order] = group
        multi = np.bincount(group, minlength=int(new.sum())) > 1
        self.a, self.b = a[new], b[new]
        bucket = (self.a >> np.uint64(20)) % np.uint64(buckets)
        self.order = np.argsort(bucket, kind="stable")
        self.bucket, self.multi = bucket[self.order].astype(np.int64), multi[self.order]

    def questions(self):
        out = []
        for k, s in C.by_bucket(self.bucket):
            o, m = self.order[s], self.multi[s]
            out.append((WINDOW, k, C.blob(self.a[o[~m]], self.b[o[~m]], self.a[o[m]], self.b[o[m]])))
        return out

    def repeated(self, answers):
        yes = self.multi.copy()
        found = {x["bucket"]: x["payload"] for x in answers if x["kind"] == WINDOW}
        for k, s in C.by_bucket(self.bucket):
            if k in found:
                single = np.flatnonzero(~self.multi[s]) + s.start
                bits = np.unpackbits(np.frombuffer(found[k], np.uint8), count=len(single))
                yes[single[bits.astype(bool)]] = True
        out = np.zeros(len(yes), dtype=bool)
        out[self.order] = yes
        return out[self.inverse]


def _windows_in_bucket(kind, chunks, payloads):
    parts = [C.unblob(p, np.uint64, np.uint64, np.uint64, np.uint64) for p in payloads]
    size = [len(p[0]) for p in parts]
    a = np.concatenate([p[0] for p in parts] + [p[2] for p in parts])
    b = np.concatenate([p[1] for p in parts] + [p[3] for p in parts])
    single = sum(size)
    order = np.lexsort((b, a))
    same = np.zeros(len(a) + 1, dtype=bool)
    same[1:-1] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    hit = np.empty(len(a), dtype=bool)
    hit[order] = same[1:] | same[:-1]                        # equal to a neighbour in order
    rows, at = [], 0
    for chunk, n in zip(chunks, size):
        if hit[at:at + n].any():
            rows.append((kind, chunk, -1, np.packbits(hit[at:at + n]).tobytes()))
        at += n
    assert at == single
    return rows


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def substring_dedup(docs: DataFrame, length: int = 35, period: int = 21,
                    with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (and kept text)."""
    if period not in COVERS or length < period:
        raise ValueError(f"period must be one of {sorted(COVERS)} and at most length")
    base = C.whole(docs)
    sizes = C.Sizes(C.text_bytes(base))
    buckets = sizes.buckets

    def first(chunk):
        d = _Doc(chunk, length, period)
        return C.Marks(d.marks, buckets).questions(ANCHOR)

    chunks = C.stage(C.chunked(base, sizes.chunk, first), "anchors")
    got = C.stage(C.each_bucket(chunks.where(F.col("kind") == ANCHOR), C.repeated_in_bucket),
                  "anchor-answers")

    def extend(d, answers):
        yes = C.Marks(d.marks, buckets).repeated(ANCHOR, answers)
        return d.windows(yes, length)

    def second(batches):
        for batch in batches:
            for key, chunk, answers in C.answer_lists(batch):
                d = _Doc(chunk, length, period)
                start = extend(d, answers)
                if len(start):
                    yield C.part_batch([(k, key, b, p) for k, b, p in
                                        _Pairs(d, start, length, buckets).questions()])

    asked = C.with_answers(chunks, got).mapInArrow(C.lean(second), C.PART)
    more = C.stage(C.each_bucket(asked, _windows_in_bucket), "window-answers")
    schema = RESULT + (", text string" if with_text else "")

    def third(batches):
        for batch in batches:
            for _, chunk, answers in C.answer_lists(batch):
                d = _Doc(chunk, length, period)
                start = extend(d, answers)
                gone = np.zeros(len(d.h), dtype=bool)
                if len(start):
                    dup = start[_Pairs(d, start, length, buckets).repeated(answers)]
                    gone = C.cover(len(d.h), dup, dup + length)
                raw = chunk.data.tobytes()
                rows = []
                for i, doc_id in enumerate(chunk.ids.tolist()):
                    lo, hi = int(d.ptr[i]), int(d.ptr[i + 1])
                    keep = np.flatnonzero(~gone[lo:hi]) + lo
                    kept = b" ".join(raw[s:e] for s, e in
                                     zip(d.starts[keep].tolist(), d.ends[keep].tolist()))
                    rows.append((doc_id, hi - lo, hi - lo - len(keep),
                                 hashlib.sha256(kept).hexdigest()) +
                                ((kept.decode(),) if with_text else ()))
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["text"] * with_text
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))

    return C.with_answers(chunks, got.unionByName(more)).mapInArrow(C.lean(third), schema)
