"""Operator 10, suffix-array dedup by prefix-free parsing.

Every byte covered by a ``length``-byte string that also starts in a document
with a smaller doc_id is removed. Matches never cross documents, overlaps
count, strings are judged on the input.

Parse. The rolling hash of ``gram`` bytes picks triggers: the least hash among
the grams inside a window of ``length`` bytes is that window's trigger, so two
equal windows always have their trigger at the same place. Windows with one
trigger form a run; some triggers (one in ``every``) start a phrase, which
reaches ``length - 1`` bytes into the next one, so that every window lies in
exactly one phrase and the phrases of equal text are equal.

Dictionary. Equal phrases meet in a bucket and learn their smallest doc_id:
a phrase that a smaller document also holds is removed whole. This settles
repetitive text without looking at its positions.

Window hashes. What is left can only match another phrase in part. Only runs
whose trigger occurs again are sent to the trigger's bucket, with the bytes
around it; there the ``length``-byte windows of the runs are grouped by hash,
and a group shows its smallest document. These hashes replace the suffix
arrays of dictionary and parse, of which none is built: equal windows share
their trigger, and only equality of ``length`` bytes matters, not order.

Hot triggers (in many chunks, or many times in a chunk) send distinct suffix
hashes instead, at most one a chunk, dealt to buckets by their own value.
Hashes that decide are 128 bits wide.

Null texts are empty: n_bytes 0, nothing removed. Rows of one doc_id never
remove each other's bytes. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm import common as C

MARK, PHRASE, SUFFIX, HOT = 1, 2, 3, 4
#: A trigger in more chunks, or more often in one chunk, is hot.
HOT_CHUNKS, HOT_IN_CHUNK = 64, 16
_POS = np.uint64((1 << 22) - 1)


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        v = np.minimum(v[:-k], v[k:])
        k *= 2
    rest = width - k
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


class _Parse:
    """Runs and phrases of a chunk. Positions are bytes of the chunk."""

    def __init__(self, chunk: C.Chunk, length: int, gram: int, every: int):
        self.chunk, self.length, self.gram = chunk, length, gram
        out: list[list[np.ndarray]] = [[] for _ in range(9)]
        phrases = 0
        for lo, stop, hi, i, j in self._blocks(chunk.offs):
            got = self._block(lo, stop, hi, i, j, every)
            if got is not None:
                got[4] += phrases
                phrases += len(got[5])
                for store, x in zip(out, got):
                    store.append(x)
        kinds = [np.int64, np.int64, np.int64, np.uint64, np.int64, np.int64, np.int64, np.uint64, np.uint64]
        (self.first, self.last, self.trigger, self.mark, self.phrase,
         self.p_first, self.p_last, self.p_a, self.p_b) = [
            np.concatenate(x) if x else np.zeros(0, k) for x, k in zip(out, kinds)]
        self.doc = chunk.ids[np.searchsorted(chunk.offs, self.first, side="right") - 1]
        self.p_doc = chunk.ids[np.searchsorted(chunk.offs, self.p_first, side="right") - 1]

    def _blocks(self, offs, size=1 << 20):
        """(first byte, end of window starts, end of bytes, documents i:j)."""
        for i, j in C.pieces(offs, size):
            lo, hi = int(offs[i]), int(offs[j])
            for at in range(lo, hi, 2 * size):               # only one document can be larger
                stop = min(at + 2 * size, hi)
                yield at, stop, min(stop + self.length - 1, hi), i, j

    def _block(self, lo, stop, hi, i, j, every):
        n, length, gram = hi - lo, self.length, self.gram
        if n < length:
            return None
        data = self.chunk.data[lo:hi]
        roll = C.Roll(C.byte_codes()[data])
        g = C.mix(roll.windows(gram))
        low = _sliding_min((g & ~_POS) | np.arange(len(g), dtype=np.uint64), length - gram + 1) & _POS
        inside = np.ones(len(low), dtype=bool)               # windows that lie in one document
        inside[stop - lo:] = False
        for end in np.unique(np.clip(self.chunk.offs[i + 1:j + 1], lo, hi)).tolist():
            inside[max(end - lo - length + 1, 0):end - lo] = False
        other = low[1:] != low[:-1]
        new, close = inside.copy(), inside.copy()
        new[1:] &= other | ~inside[:-1]
        close[:-1] &= other | ~inside[1:]
        first, last = np.flatnonzero(new), np.flatnonzero(close)
        if not len(first):
            return None
        trig = low[first].astype(np.int64)
        head = np.ones(len(first), dtype=bool)
        head[1:] = ((first[1:] != last[:-1] + 1) |
                    ((g[trig[1:]] >> np.uint64(40)) % np.uint64(every) == 0))
        tail = np.append(np.flatnonzero(head)[1:] - 1, len(first) - 1)
        p_first, p_last = first[head], last[tail]
        size = (p_last - p_first).astype(np.uint64)
        a = C.mix(roll.span(p_first, p_last + length) + size)
        other = C.Roll(C.mix(C.byte_codes())[data], C.BASE_B)
        b = C.mix(other.span(p_first, p_last + length) + size)
        return [first + lo, last + lo, trig + lo, g[trig], np.cumsum(head) - 1,
                p_first + lo, p_last + lo, a, b]

    def bytes_at(self, at: np.ndarray, width: int) -> np.ndarray:
        return self.chunk.data[np.clip(at[:, None] + np.arange(width), 0, len(self.chunk.data) - 1)]


class _Triggers:
    """A chunk's distinct triggers by bucket: singles, multis, hot ones (as in
    ``common.Marks``, with the hot ones told apart)."""

    def __init__(self, marks, buckets):
        self.values, self.inverse, count = np.unique(marks, return_inverse=True, return_counts=True)
        level = np.where(count > HOT_IN_CHUNK, 2, np.where(count > 1, 1, 0))
        bucket = ((self.values >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        self.order = np.lexsort((level, bucket))
        self.bucket, self.level = bucket[self.order], level[self.order]

    def questions(self):
        low = (self.values[self.order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return [(MARK, b, C.blob(*[low[s][self.level[s] == k] for k in range(3)]))
                for b, s in C.by_bucket(self.bucket)]

    def state(self, answers) -> np.ndarray:
        """Per given mark: 0 occurs once, 1 repeats, 2 is hot."""
        out = self.level.copy()
        found = {x["bucket"]: x["payload"] for x in answers if x["kind"] == MARK}
        for b, s in C.by_bucket(self.bucket):
            if b in found:
                out[s] = np.maximum(out[s], np.frombuffer(found[b], np.uint8))
        back = np.zeros(len(out), dtype=np.int64)
        back[self.order] = out
        return back[self.inverse]


def _answer_marks(chunks, payloads):
    parts = [C.unblob(p, np.uint32, np.uint32, np.uint32) for p in payloads]
    size = [sum(map(len, p)) for p in parts]
    flat = np.concatenate([x for p in parts for x in p])
    level = np.concatenate([np.full(len(x), k) for p in parts for k, x in enumerate(p)])
    values, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    top = np.zeros(len(values), dtype=np.int64)
    np.maximum.at(top, inverse, level)
    state = np.where((top == 2) | (count > HOT_CHUNKS), 2, np.where((top == 1) | (count > 1), 1, 0))
    got = state[inverse].astype(np.uint8)
    at = 0
    for chunk, n in zip(chunks, size):
        if got[at:at + n].any():
            yield MARK, chunk, -1, got[at:at + n].tobytes()
        at += n


class _Owned:
    """Distinct 128-bit keys of a chunk with their smallest document, by bucket."""

    def __init__(self, kind, a, b, doc, buckets):
        self.kind, self.doc = kind, doc
        order = np.lexsort((doc, b, a))
        a, b, d = a[order], b[order], doc[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.inverse = np.empty(len(a), dtype=np.int64)
        self.inverse[order] = np.cumsum(new) - 1
        self.a, self.b, self.least = a[new], b[new], d[new]
        bucket = ((self.a >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.order]

    def questions(self):
        for k, s in C.by_bucket(self.bucket):
            o = self.order[s]
            yield self.kind, k, C.blob(self.a[o], self.b[o], self.least[o])

    def elsewhere(self, answers) -> np.ndarray:
        """Per given key: does a document smaller than its own hold it?"""
        less = np.zeros(len(self.a), dtype=bool)
        found = {x["bucket"]: x["payload"] for x in answers if x["kind"] == self.kind}
        for k, s in C.by_bucket(self.bucket):
            if k in found:
                less[self.order[s]] = np.unpackbits(np.frombuffer(found[k], np.uint8),
                                                    count=s.stop - s.start).astype(bool)
        return less[self.inverse] | (self.doc > self.least[self.inverse])


def _answer_owned(kind, chunks, payloads):
    parts = [C.unblob(p, np.uint64, np.uint64, np.int64) for p in payloads]
    a, b, d = (np.concatenate([p[k] for p in parts]) for k in range(3))
    less = d > _least(a, b, d)
    at = 0
    for chunk, p in zip(chunks, parts):
        bits = less[at:at + len(p[0])]
        at += len(p[0])
        if bits.any():
            yield kind, chunk, -1, np.packbits(bits).tobytes()


def _least(a, b, doc):
    """The smallest document among equal keys."""
    order = np.lexsort((doc, b, a))
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    out = np.empty(len(a), dtype=np.int64)
    out[order] = doc[order][new][np.cumsum(new) - 1]
    return out


def _suffix_hashes(text: np.ndarray, length: int):
    """For rows of bytes: hashes of the ``length`` bytes from any column (of all or some rows)."""
    width = text.shape[1]
    out = []
    for codes, base in ((C.byte_codes(), C.BASE_A), (C.mix(C.byte_codes()), C.BASE_B)):
        sums = np.zeros((len(text), width + 1), dtype=np.uint64)
        np.cumsum(codes[text] * C.powers(base, width)[:width], axis=1, out=sums[:, 1:])
        inv = C.powers(pow(base, -1, 1 << 64), width + 1)
        out.append((sums, inv))
    return lambda col, rows=slice(None): [C.mix((s[rows, col + length] - s[rows, col]) * inv[col]) for s, inv in out]


def _deal(p: _Parse, sel: np.ndarray, buckets: int):
    """Order of runs by the bucket of their trigger, and the buckets in that order."""
    bucket = ((p.mark[sel] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def _send_suffixes(p: _Parse, sel: np.ndarray, buckets: int):
    """Runs to compare, once each: bytes around the trigger and the shifts that count."""
    import zstandard
    squeeze = zstandard.ZstdCompressor(level=3).compress
    back = p.length - p.gram
    order, bucket = _deal(p, sel, buckets)
    rows = []
    for k, s in C.by_bucket(bucket):
        o = sel[order[s]]
        text = p.bytes_at(p.trigger[o] - back, back + p.length)
        rows.append((SUFFIX, k, squeeze(C.blob(
            (p.mark[o] & np.uint64(0xFFFFFFFF)).astype(np.uint32), p.doc[o],
            (p.trigger[o] - p.last[o]).astype(np.uint8), (p.trigger[o] - p.first[o]).astype(np.uint8),
            text.ravel()))))
    return rows


def _answer_suffixes(chunks, payloads, length, gram):
    import zstandard
    expand = zstandard.ZstdDecompressor().decompress
    back = length - gram
    parts = [C.unblob(expand(x), np.uint32, np.int64, np.uint8, np.uint8, np.uint8) for x in payloads]
    mark, doc, least, most = (np.concatenate([x[k] for x in parts]) for k in range(4))
    text = np.concatenate([x[4] for x in parts]).reshape(len(mark), back + length)
    order = np.argsort(mark, kind="stable")
    cuts = np.flatnonzero(np.diff(mark[order])) + 1          # triggers are compared among themselves
    mask = np.zeros(len(mark), dtype=np.uint64)
    lo = 0
    while lo < len(mark):
        k = int(np.searchsorted(cuts, lo + 20_000))
        hi = int(cuts[k]) if k < len(cuts) else len(mark)
        o = order[lo:hi]
        lo = hi
        hashes = _suffix_hashes(text[o], length)
        from_, to, docs = least[o], most[o], doc[o]
        for shift in range(back + 1):
            use = np.flatnonzero((from_ <= shift) & (shift <= to))
            if len(use) > 1:
                a, b = hashes(back - shift, use)
                d = docs[use]
                dup = d > _least(a, b, d)
                mask[o[use[dup]]] |= np.uint64(1 << shift)
    at = 0
    for chunk, x in zip(chunks, parts):
        got = mask[at:at + len(x[0])]
        at += len(x[0])
        if got.any():
            yield SUFFIX, chunk, -1, got.tobytes()


def _starts(p: _Parse, runs: np.ndarray) -> np.ndarray:
    """All window starts of the given runs."""
    size = p.last[runs] - p.first[runs] + 1
    shift = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(p.first[runs], size) + shift


def _hot_keys(p: _Parse, start: np.ndarray, buckets: int) -> _Owned:
    a, b = np.empty(len(start), np.uint64), np.empty(len(start), np.uint64)
    for lo in range(0, len(start), 20_000):
        part = slice(lo, lo + 20_000)
        a[part], b[part] = _suffix_hashes(p.bytes_at(start[part], p.length), p.length)(0)
    doc = p.chunk.ids[np.searchsorted(p.chunk.offs, start, side="right") - 1]
    return _Owned(HOT, a, b, doc, buckets)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _whole_chars(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Keep every byte of a character of which a byte is kept."""
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    if not len(char):
        return gone
    kept = np.zeros(int(char[-1]) + 2, dtype=bool)
    kept[char[~gone]] = True
    return ~kept[char]


def suffix_dedup(docs: DataFrame, length: int = 50, gram: int = 24, every: int = 8,
                 with_text: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with
    ``with_text`` also the kept text, in which characters stay whole; and the
    document's own ``extra`` columns."""
    if not 4 <= gram < length <= 64:
        raise ValueError("need 4 <= gram < length <= 64")
    base = C.whole(docs, extra)
    sizes = C.Sizes(C.text_bytes(base))
    buckets = sizes.buckets

    def parse(chunk):
        return _Parse(chunk, length, gram, every)

    def first(chunk):
        p = parse(chunk)
        return [*_Triggers(p.mark, buckets).questions(),
                *_Owned(PHRASE, p.p_a, p.p_b, p.p_doc, buckets).questions()]

    def answer(kind, chunks, payloads):
        if kind == MARK:
            return list(_answer_marks(chunks, payloads))
        if kind == SUFFIX:
            return list(_answer_suffixes(chunks, payloads, length, gram))
        return list(_answer_owned(kind, chunks, payloads))

    chunks = C.stage(C.chunked(base, sizes.chunk, first, extra), "phrases")
    got = C.stage(C.each_bucket(chunks.where(F.col("kind") != C.TEXT), answer), "phrase-answers")

    def open_runs(p, answers):
        """(phrases to remove, runs to compare, hot runs)."""
        owned = _Owned(PHRASE, p.p_a, p.p_b, p.p_doc, buckets).elsewhere(answers)
        state = _Triggers(p.mark, buckets).state(answers)
        left = ~owned[p.phrase]
        return owned, np.flatnonzero(left & (state == 1)), np.flatnonzero(left & (state == 2))

    def second(batches):
        for batch in batches:
            for key, chunk, answers in C.answer_lists(batch):
                p = parse(chunk)
                _, runs, hot = open_runs(p, answers)
                rows = _send_suffixes(p, runs, buckets)
                rows += _hot_keys(p, _starts(p, hot), buckets).questions()
                if rows:
                    yield C.part_batch([(k, key, b, x) for k, b, x in rows])

    more = C.stage(C.each_bucket(C.with_answers(chunks, got).mapInArrow(C.lean(second), C.PART), answer),
                   "suffix-answers")
    schema = RESULT + (", text string" if with_text else "")
    schema += "".join(f", `{c}` {base.schema[c].dataType.simpleString()}" for c in extra)

    def third(batches):
        for batch in batches:
            for _, chunk, answers in C.answer_lists(batch):
                p = parse(chunk)
                owned, runs, hot = open_runs(p, answers)
                lo, hi = [p.p_first[owned]], [p.p_last[owned] + length]
                order, bucket = _deal(p, runs, buckets)
                found = {x["bucket"]: x["payload"] for x in answers if x["kind"] == SUFFIX}
                mask = np.zeros(len(order), dtype=np.uint64)
                for b, s in C.by_bucket(bucket):
                    if b in found:
                        mask[s] = np.frombuffer(found[b], np.uint64)
                some = np.flatnonzero(mask)
                mask, at = mask[some], p.trigger[runs[order[some]]]
                for shift in range(length - gram + 1):
                    hit = at[(mask >> np.uint64(shift)) & np.uint64(1) == 1]
                    lo.append(hit - shift)
                    hi.append(hit - shift + length)
                start = _starts(p, hot)
                if len(start):
                    dup = start[_hot_keys(p, start, buckets).elsewhere(answers)]
                    lo.append(dup)
                    hi.append(dup + length)
                gone = C.cover(len(chunk.data), np.concatenate(lo), np.concatenate(hi))
                rows = []
                for i, doc_id in enumerate(chunk.ids.tolist()):
                    part = slice(int(chunk.offs[i]), int(chunk.offs[i + 1]))
                    data, off = chunk.data[part], gone[part]
                    row = (doc_id, len(data), int(off.sum()), len(C.runs_of(off)[0]),
                           hashlib.sha256(data[~off].tobytes()).hexdigest())
                    if with_text:
                        row += (data[~_whole_chars(data, off)].tobytes().decode(),)
                    rows.append(row)
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["text"] * with_text
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows))))
                                                 | dict(zip(extra, chunk.columns())))

    return C.with_answers(chunks, got.unionByName(more)).mapInArrow(C.lean(third), schema)
