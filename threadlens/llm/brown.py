"""Operator 6, language-model scores by a Brown class-based bigram model.

Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end token
a document. Training documents are those whose crc32(doc_id as text) modulo
``folds`` is not ``held_out``; every token of them is counted.

Classes. Each word starts in the class given by its last bytes. An exchange
sweep counts, for each word, the classes before and after it, brings these
counts together in the word's bucket and moves the word to the class that
raises the class-bigram likelihood most, the other words held fixed. All words of
the first sweep move at once; a later sweep has two rounds, in which the halves of
the vocabulary (by hash) move in turn, each against the counts the last one left.

Model. P(word | previous) = (1 - u) P(class | previous class) count / class count;
transitions are smoothed by class frequency, and u, the chance of an unseen
word after that class, is the share of words seen once (Good-Turing). All
unseen words are one event, as in the base score. Each probability sums to one
over the known words, the end token and the unseen event.

Driver and closures hold only tables of (classes + 2)^2 cells. Null and empty
texts consist of the end token. No training documents: both scores 0 for
everything unseen. Rows without doc_id take no part. Empty table: no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm import common as C

WORD, CELLS, DOC, KINDS = 1, 2, 3, 4


def is_held_out(ids, folds, held_out):
    return np.array([zlib.crc32(str(i).encode()) % folds == held_out for i in ids.tolist()], dtype=bool)


class _Words:
    """Tokens of a chunk: distinct words, their classes, and each token's neighbours."""

    def __init__(self, chunk: C.Chunk, classes: int, folds: int, held_out: int):
        starts, ends, h, ptr = C.words(chunk.data, chunk.offs, lower=True)
        self.ids, self.k = chunk.ids, classes
        self.count = np.diff(ptr)
        self.held = is_held_out(chunk.ids, folds, held_out)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)
        self.values, self.word = np.unique(h, return_inverse=True)
        at = np.empty(len(self.values), dtype=np.int64)
        at[self.word] = np.arange(len(h))                    # any place of the word tells its ending
        self.trained = ~self.held[self.doc]
        self.here = np.bincount(self.word[self.trained], minlength=len(self.values))
        self.first = np.zeros(len(h), dtype=bool)
        self.first[ptr[:-1][self.count > 0]] = True
        self.last = np.zeros(len(h), dtype=bool)
        self.last[ptr[1:][self.count > 0] - 1] = True
        self.cls = self._by_ending(chunk.data, starts[at], ends[at])
        self.total = np.zeros(len(self.values), dtype=np.int64)

    def _by_ending(self, data, starts, ends):
        codes, out = C.byte_codes(lower=True), np.zeros(len(starts), dtype=np.uint64)
        for back in (1, 2, 3):
            pos = np.maximum(ends - back, 0)
            out += np.where(ends - back >= starts, codes[data[pos]] * np.uint64(2 * back + 1), np.uint64(0))
        return (C.mix(out) % np.uint64(self.k)).astype(np.int64)

    def deal(self, buckets):
        bucket = ((self.values >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, C.by_bucket(bucket[order])

    def learn(self, answers, buckets):
        """Classes and counts from the buckets."""
        found = {x["bucket"]: x["payload"] for x in answers if x["kind"] == WORD}
        order, slices = self.deal(buckets)
        for b, s in slices:
            if b in found:
                cls, total = C.unblob(found[b], np.uint8, np.int64)
                self.cls[order[s]], self.total[order[s]] = cls, total

    def neighbours(self):
        """Classes before and after each token (the end token's where there is none)."""
        own = self.cls[self.word]
        before = np.concatenate(([self.k], own[:-1])) if len(own) else own.copy()
        after = np.concatenate((own[1:], [self.k])) if len(own) else own.copy()
        before[self.first] = self.k
        after[self.last] = self.k
        return own, before, after

    def questions(self, buckets):
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=1).compress
        _, before, after = self.neighbours()
        t, w, k1 = self.trained, len(self.values), self.k + 1
        sparse = []
        for side in (before, after):
            key, x = np.unique(self.word[t] * k1 + side[t], return_counts=True)
            sparse.append((key // k1, (key % k1).astype(np.uint8), x.astype(np.uint32)))
        order, slices = self.deal(buckets)
        place = np.empty(w, dtype=np.int64)
        place[order] = np.arange(w)
        sides = []
        for word, c, x in sparse:
            o = np.argsort(place[word], kind="stable")
            n = np.bincount(word, minlength=w)[order]
            sides.append((n.astype(np.uint16), np.concatenate(([0], np.cumsum(n))), c[o], x[o]))
        for b, s in slices:
            parts = [self.values[order[s]], self.cls[order[s]].astype(np.uint8)]
            for n, ptr, c, x in sides:
                inner = slice(ptr[s.start], ptr[s.stop])
                parts += [n[s], c[inner], x[inner]]
            yield WORD, b, squeeze(C.blob(*parts))

    def cells(self, single=None):
        """Class bigrams of the training text; row k is before a first word,
        column k the end; with ``single`` row k+1 counts what follows words
        seen once, column k+1 words seen once that follow."""
        side = self.k + 2
        m = np.zeros((side, side), dtype=np.int64)
        own, before, after = self.neighbours()
        t = self.trained

        def count(r, c):
            m.ravel()[:] += np.bincount(r * side + c, minlength=side * side)

        count(before[t], own[t])
        end = t & self.last
        count(own[end], np.full(end.sum(), self.k))
        empty = int((~self.held & (self.count == 0)).sum())
        m[self.k, self.k] += empty
        if single is not None:
            one = single[self.word] & t
            count(before[one], np.full(one.sum(), self.k + 1))
            count(np.full(one.sum(), self.k + 1), after[one])
        return m


def _rounds(sweeps: int) -> list[int]:
    """What moves in each round: all words (0), then the first (1) and the second half (2)."""
    return [0, *[1, 2] * (sweeps - 1)] if sweeps > 0 else []


def _exchange(cells: np.ndarray, k: int, half: int):
    """Answer of a bucket: for each asked word its new class and its count."""
    n = cells[:k + 1, :k + 1].astype(np.float64)

    def phi(x):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

    into, out_of = n.sum(0), n.sum(1)                       # per class, as follower and as leader
    ones = phi(n[:, :k] + 1) - phi(n[:, :k])                # most counts are one
    ones_t = np.ascontiguousarray((phi(n[:k] + 1) - phi(n[:k])).T)

    def answer(kind, chunks, payloads):
        import zstandard
        expand = zstandard.ZstdDecompressor().decompress
        types = (np.uint64, np.uint8, np.uint16, np.uint8, np.uint32, np.uint16, np.uint8, np.uint32)
        parts = [C.unblob(expand(p), *types) for p in payloads]
        value = np.concatenate([p[0] for p in parts])
        words, at, word = np.unique(value, return_index=True, return_inverse=True)
        now = np.concatenate([p[1] for p in parts])[at].astype(np.int64)
        w = len(words)
        sides, total = [], np.zeros(w, dtype=np.int64)
        for i in (2, 5):
            owner = np.repeat(word, np.concatenate([p[i] for p in parts]))
            key = owner * (k + 1) + np.concatenate([p[i + 1] for p in parts])
            x = np.concatenate([p[i + 2] for p in parts])
            key, inv = np.unique(key, return_inverse=True)
            x = np.bincount(inv, weights=x, minlength=len(key))
            sides.append((key // (k + 1), key % (k + 1), x))
        total = np.bincount(sides[0][0], weights=sides[0][2], minlength=w).astype(np.int64)
        new = now.copy()
        moving = np.arange(w)
        if half:                                            # the others are not weighed
            turn = (words >> np.uint64(7)) % np.uint64(2) == np.uint64(half - 1)
            moving, place = np.flatnonzero(turn), np.cumsum(turn) - 1
            sides = [(place[o[turn[o]]], c[turn[o]], x[turn[o]]) for o, c, x in sides]
        size = (1 << 18) // k
        for lo in range(0, len(moving), size):
            hi = min(lo + size, len(moving))
            m = hi - lo
            own = now[moving[lo:hi]]
            gain = np.zeros((m, k))
            count = total[moving[lo:hi]].astype(np.float64)
            mine = np.arange(m), own
            for axis, (owner, c, x) in enumerate(sides):
                i, j = np.searchsorted(owner, [lo, hi])
                o, cc, xx = owner[i:j] - lo, c[i:j], x[i:j]
                base = n[cc, :k] if axis == 0 else n[:k, cc].T
                add = ones[cc] if axis == 0 else ones_t[cc]
                more = np.flatnonzero(xx > 1)
                if len(more):
                    add[more] = phi(base[more] + xx[more, None]) - phi(base[more])
                stay = base[np.arange(len(o)), own[o]]
                add[np.arange(len(o)), own[o]] = phi(stay) - phi(np.maximum(stay - xx, 0))
                if len(o):
                    first = np.flatnonzero(np.concatenate(([True], o[1:] != o[:-1])))
                    gain[o[first]] += np.add.reduceat(add, first, axis=0)
                size_of = (into if axis == 0 else out_of)[:k]
                loss = phi(size_of[None, :] + count[:, None]) - phi(size_of)[None, :]
                loss[mine] = phi(size_of[own]) - phi(np.maximum(size_of[own] - count, 0))
                gain -= loss
            best = gain.argmax(1)
            better = gain[np.arange(m), best] > gain[mine] + 1e-9
            new[moving[lo:hi]] = np.where(better & (count > 0), best, own)
        rows, lo = [(KINDS, -1, -1, np.array([(total > 0).sum()]).tobytes())], 0
        for chunk, p in zip(chunks, parts):
            mine = word[lo:lo + len(p[0])]
            lo += len(p[0])
            rows.append((kind, chunk, -1, C.blob(new[mine].astype(np.uint8), total[mine])))
        return rows

    return answer


def _sum_cells(parts: DataFrame, k: int) -> np.ndarray:
    """Sum of the chunks' tables: added up in tasks, then a few bounded ones here."""
    def add(batches):
        m = np.zeros((k + 2) ** 2, dtype=np.int64)
        for batch in batches:
            for x in batch.column(0):
                m += np.frombuffer(x.as_py(), dtype=np.int64)
        yield pa.RecordBatch.from_pydict({"cell": np.arange(len(m)), "n": m})

    rows = (parts.where(F.col("kind") == CELLS).select("payload")
            .mapInArrow(add, "cell long, n long").where("n > 0")
            .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    m = np.zeros((k + 2) ** 2, dtype=np.int64)
    m[rows["cell"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return m.reshape(k + 2, k + 2)


RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def class_scores(docs: DataFrame, classes: int = 128, sweeps: int = 2, folds: int = 7,
                 held_out: int = 2, alpha: float = 1.0) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    if not 2 <= classes <= 250:
        raise ValueError("classes must be between 2 and 250")
    base = C.whole(docs)
    total = C.text_bytes(base)
    sizes = C.Sizes(total)
    buckets = sizes.buckets
    # larger chunks than for hashing alone: fewer repeats of a word across chunks
    size = int(min(32 << 20, max(1 << 20, total // 64)))

    def words(chunk):
        return _Words(chunk, classes, folds, held_out)

    def first(chunk):
        w = words(chunk)
        rows = [(CELLS, -1, w.cells().tobytes())]
        return rows + list(w.questions(buckets)) if len(w.values) else rows

    chunks = C.stage(C.chunked(base, size, first), "text")
    cells = _sum_cells(chunks, classes)

    def ask(key, w):
        return C.part_batch([(k, key, b, p) for k, b, p in w.questions(buckets)])

    questions = chunks.where(F.col("kind") == WORD)
    rounds = _rounds(sweeps)
    for turn, half in enumerate(rounds):
        answers = C.stage(C.each_bucket(questions, _exchange(cells, classes, half)), "classes")
        if turn < len(rounds) - 1:
            def again(batches):
                for batch in batches:
                    for key, chunk, got in C.answer_lists(batch):
                        w = words(chunk)
                        w.learn(got, buckets)
                        yield C.part_batch([(CELLS, key, -1, w.cells().tobytes())])
                        if len(w.values):
                            yield ask(key, w)

            both = C.stage(C.with_answers(chunks, answers).mapInArrow(again, C.PART), "sweep")
            cells = _sum_cells(both, classes)
            questions = both.where(F.col("kind") == WORD)

    def per_document(batches):
        for batch in batches:
            for key, chunk, got in C.answer_lists(batch):
                w = words(chunk)
                w.learn(got, buckets)
                rows = [(CELLS, key, -1, w.cells(w.total == 1).tobytes())]
                known = w.total[w.word] > 0
                cls = np.where(known, w.cls[w.word], classes + 1).astype(np.uint8)
                d = len(w.ids)
                logs = np.log10(np.maximum(w.total, 1))[w.word]
                plus = np.log10(w.total + 1.0)[w.word]
                rows.append((DOC, key, -1, C.blob(
                    w.ids, w.held.astype(np.uint8), w.count,
                    np.bincount(w.doc, weights=known, minlength=d),
                    np.bincount(w.doc, weights=logs, minlength=d),
                    np.bincount(w.doc, weights=plus, minlength=d), cls)))
                yield C.part_batch(rows)

    final = C.stage(C.with_answers(chunks, answers).mapInArrow(per_document, C.PART), "tokens")
    cells = _sum_cells(final, classes)
    k = classes
    ends = int(cells[:k + 1, k].sum())                       # training documents
    tokens = int(cells[:k + 1, :k + 1].sum())
    kinds = _vocabulary(answers) + (ends > 0)
    score = _model(cells, k, alpha)
    floor = np.log10(tokens + 1.0 * (kinds + 1))
    end_plus = np.log10(ends + 1.0)

    def scored(batches):
        for batch in batches:
            for x in batch.column(0):
                ids, held, count, known, logs, plus, cls = C.unblob(
                    x.as_py(), np.int64, np.uint8, np.int64, np.float64, np.float64, np.float64, np.uint8)
                ptr = np.concatenate(([0], np.cumsum(count)))
                cls = cls.astype(np.int64)
                prev = np.concatenate(([k], cls[:-1])) if len(cls) else cls
                if len(cls):
                    prev[ptr[:-1][count > 0]] = k
                doc = np.repeat(np.arange(len(ids)), count)
                last = np.full(len(ids), k)
                last[count > 0] = cls[ptr[1:][count > 0] - 1]
                sums = np.bincount(doc, weights=score[prev, cls], minlength=len(ids)) + logs + score[last, k]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids, "held_out": held.astype(bool), "n_tokens": count + 1,
                    "n_known": known.astype(np.int64) + (ends > 0),
                    "train_tokens": np.full(len(ids), tokens, np.int64),
                    "base_score": plus + end_plus - (count + 1) * floor, "score": sums})

    return final.where(F.col("kind") == DOC).select("payload").mapInArrow(scored, RESULT)


def _vocabulary(answers: DataFrame) -> int:
    """Distinct words of the training text: the sum of the buckets' numbers."""
    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {"n": [int(np.frombuffer(x.as_py(), np.int64)[0]) for x in batch.column(0)]})

    return int(answers.where(F.col("kind") == KINDS).select("payload")
               .mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0)


def _model(cells: np.ndarray, k: int, alpha: float) -> np.ndarray:
    """log10 of transition over class size; add log10(count) for a word's probability.

    Rows: previous class (k: start, k+1: unseen). Columns: classes, end, unseen.
    """
    n = cells[:, :k + 1].astype(np.float64)
    size = n[:k + 1].sum(0)                                  # class counts, end counts
    share = size / max(size.sum(), 1.0)
    leave = n.sum(1)
    unseen = (cells[:, k + 1] + 0.5) / (leave + 1.0)
    if not size.sum():
        unseen[:] = 1.0
    p = (n + alpha * share[None, :]) / (leave + alpha)[:, None] * (1 - unseen)[:, None]
    p[:, :k] /= np.maximum(size[:k], 1.0)[None, :]
    with np.errstate(divide="ignore"):
        out = np.log10(np.concatenate([p, unseen[:, None]], axis=1))
    return np.where(np.isfinite(out), out, 0.0)
