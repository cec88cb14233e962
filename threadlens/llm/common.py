"""Helpers shared by the operators: stage tables, Arrow text access, vectorised
hashing, the question/answer exchange between chunks and buckets, components.

Conventions: a row whose ``doc_id`` is null names no document and takes no
part; a null text counts as an empty one; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.session import ensure_checkpoint_dir, scratch_path

DOCS = "documents"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{DOCS}.parquet")


def whole(docs: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(doc_id long, text string without nulls, ``extra`` columns) of every named document."""
    return (docs.where(F.col("doc_id").isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *extra))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


# ------------------------------------------------------------------ hashing

#: Odd bases of the polynomial hashes (arbitrary fixed odd numbers).
BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xC2B2AE3D27D4EB4F


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer over uint64 (xor-shift and multiply, a bijection)."""
    x = np.asarray(x, dtype=np.uint64)
    if not x.ndim:
        return mix(x[None])[0]
    moved = x >> np.uint64(32)
    x = x ^ moved
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= np.right_shift(x, np.uint64(29), out=moved)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= np.right_shift(x, np.uint64(32), out=moved)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod 2^64; kept up to 2^21 of them."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 10), base, dtype=np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        if n <= 1 << 21:
            _POWERS[base] = held
    return held[:n]


class Roll:
    """Polynomial hash of any span of a uint64 sequence, by prefix sums mod 2^64."""

    def __init__(self, values: np.ndarray, base: int = BASE_A):
        n = len(values)
        self.inv = powers(pow(base, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(base, n)[:n], out=self.sums[1:])

    def windows(self, width: int) -> np.ndarray:
        """The hash of ``width`` values from each position on."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.inv[:n]

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inv[start]


def byte_codes(lower: bool = False) -> np.ndarray:
    """A random-looking uint64 per byte; A-Z as a-z with ``lower``."""
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += np.uint64(32)
    return mix(b + np.uint64(0x51ED270B))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def strings(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column without nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    d = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]:o[-1]], o - o[0]


def pieces(offs: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive documents of at most ``limit`` bytes (or one document)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data: np.ndarray, offs: np.ndarray, lower: bool, block: int = 1 << 20,
          space: np.ndarray = _SPACE):
    """Words ``[^\\x20\\x09-\\x0D]+`` of concatenated documents (``space``: the
    bytes that part them).

    Returns (starts, ends, hash of each word, pointer: words of document i are
    pointer[i]:pointer[i+1]).
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    inside = ~space[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True                                   # a document starts (or all ends) here
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    codes = byte_codes(lower)
    h = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):                              # whole words, about ``block`` bytes at once
        j = max(int(np.searchsorted(ends, starts[i] + block, side="right")), i + 1)
        lo = starts[i]
        r = Roll(codes[data[lo:ends[j - 1]]])
        h[i:j] = r.span(starts[i:j] - lo, ends[i:j] - lo)
        i = j
    h = mix(h + (ends - starts).astype(np.uint64))
    return starts, ends, h, np.searchsorted(starts, offs)


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    d = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean mask of positions below n in any [start, end)."""
    d = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(d[:-1]) > 0


# ------------------------------------------------------- chunks and buckets

PART = "kind int, chunk long, bucket int, payload binary"
PART_ARROW = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()),
                        ("bucket", pa.int32()), ("payload", pa.binary())])
TEXT = 0


def part_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.record_batch([pa.array(list(c), t.type) for c, t in zip(cols, PART_ARROW)],
                           schema=PART_ARROW)


def part_table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([part_batch(rows)], schema=PART_ARROW)


def blob(*arrays: np.ndarray) -> bytes:
    """Arrays as one byte string: their lengths in bytes, then their contents."""
    parts = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return np.array([len(p) for p in parts], dtype=np.int64).tobytes() + b"".join(parts)


def unblob(raw: bytes, *types) -> list[np.ndarray]:
    sizes = np.frombuffer(raw, dtype=np.int64, count=len(types))
    out, at = [], 8 * len(types)
    for size, t in zip(sizes.tolist(), types):
        out.append(np.frombuffer(raw, dtype=t, count=size // np.dtype(t).itemsize, offset=at))
        at += size
    return out


class Chunk:
    """Some whole documents: ids, offsets and the bytes of their texts, and their
    further columns, if asked for, as an Arrow stream."""

    def __init__(self, ids: np.ndarray, offs: np.ndarray, data: np.ndarray,
                 further: np.ndarray | None = None):
        self.ids, self.offs, self.data = ids, offs, data
        self.further = np.zeros(0, np.uint8) if further is None else further

    def pack(self) -> bytes:
        import zstandard
        return zstandard.ZstdCompressor(level=3).compress(blob(self.ids, self.offs, self.data, self.further))

    @staticmethod
    def unpack(raw: bytes) -> Chunk:
        import zstandard
        return Chunk(*unblob(zstandard.ZstdDecompressor().decompress(raw), np.int64, np.int64, np.uint8, np.uint8))

    def columns(self) -> list[pa.Array]:
        """The further columns, a value for each document."""
        if not len(self.further):
            return []
        with pa.ipc.open_stream(pa.py_buffer(self.further)) as reader:
            return [c.combine_chunks() for c in reader.read_all().columns]


def _stream(batches: list[pa.RecordBatch]) -> np.ndarray:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema) as writer:
        for batch in batches:
            writer.write_batch(batch)
    return np.frombuffer(sink.getvalue(), np.uint8)


class Sizes:
    """Chunk bytes and number of buckets for a corpus: both grow with it, so
    that a bucket's share and a chunk stay small enough for one task."""

    def __init__(self, total: int):
        self.chunk = int(min(32 << 20, max(1 << 18, total // 256)))
        self.buckets = int(min(1 << 16, max(16, math.ceil(total / (8 << 20)))))


def chunked(docs: DataFrame, size: int, ask: Callable[[Chunk], list[tuple[int, int, bytes]]],
            extra: Sequence[str] = ()) -> DataFrame:
    """Deal documents, with their ``extra`` columns, into chunks of about ``size`` bytes (no shuffle).

    Gives PART rows: one of kind TEXT with the packed documents of each chunk,
    and for each (kind, bucket, payload) of ``ask(chunk)`` a row.
    """
    def run(batches):
        from pyspark import TaskContext
        base, seq = TaskContext.get().partitionId() << 32, 0
        held: list[Chunk] = []
        others: list[pa.RecordBatch] = []
        amount = 0

        def flush():
            nonlocal held, others, amount, seq
            offs = np.concatenate([[0]] + [np.diff(c.offs) for c in held]).cumsum()
            c = Chunk(np.concatenate([c.ids for c in held]), offs,
                      np.concatenate([c.data for c in held]), _stream(others) if others else None)
            held, others, amount = [], [], 0
            rows = [(TEXT, base + seq, -1, c.pack())]
            rows += [(k, base + seq, b, p) for k, b, p in ask(c)]
            seq += 1
            return part_batch(rows)

        for batch in batches:
            ids = np.asarray(batch.column(0).cast(pa.int64()))
            data, offs = strings(batch.column(1))
            for i, j in pieces(offs, size):
                held.append(Chunk(ids[i:j].copy(), offs[i:j + 1] - offs[i],
                                  data[offs[i]:offs[j]].copy()))
                if extra:
                    others.append(batch.select(list(extra)).slice(i, j - i))
                amount += int(offs[j] - offs[i])
                if amount >= size or len(held) > 5000:
                    yield flush()
        if held:
            yield flush()

    small_batches(docs.sparkSession)
    return whole(docs, extra).mapInArrow(lean(run), PART)


def with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """(chunk, payload, answers: array of (kind, bucket, payload)) for each chunk."""
    got = (answers.where("chunk >= 0").groupBy("chunk")
           .agg(F.collect_list(F.struct("kind", "bucket", "payload")).alias("answers")))
    return (chunks.where(F.col("kind") == TEXT).select("chunk", "payload")
            .join(got, "chunk", "left"))


def answer_lists(batch: pa.RecordBatch) -> Iterator[tuple[int, Chunk, list[dict]]]:
    for i in range(batch.num_rows):
        yield (batch.column(0)[i].as_py(), Chunk.unpack(batch.column(1)[i].as_py()),
               batch.column(2)[i].as_py() or [])


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Slices of equal values of a sorted array."""
    if len(bucket):
        cut = np.flatnonzero(np.diff(bucket)) + 1
        for lo, hi in zip(np.concatenate(([0], cut)).tolist(), np.concatenate((cut, [len(bucket)])).tolist()):
            yield int(bucket[lo]), slice(lo, hi)


# ------------------------------------------------- marks that occur repeatedly


class Marks:
    """A chunk's distinct 64-bit marks, dealt to buckets.

    A mark that occurs at least twice in the chunk is known to repeat; of the
    others (singles) the buckets are asked. Payloads carry 32 bits a mark, so
    an answer may rarely be a false yes, never a false no.
    """

    def __init__(self, marks: np.ndarray, buckets: int):
        self.values, self.inverse, count = np.unique(marks, return_inverse=True, return_counts=True)
        bucket = (self.values >> np.uint64(32)) % np.uint64(buckets)
        self.order = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.order].astype(np.int64)
        self.multi = count[self.order] > 1

    def questions(self, kind: int) -> list[tuple[int, int, bytes]]:
        low = (self.values[self.order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return [(kind, b, blob(low[s][~self.multi[s]], low[s][self.multi[s]]))
                for b, s in by_bucket(self.bucket)]

    def repeated(self, kind: int, answers: list[dict]) -> np.ndarray:
        """For each given mark: does it occur anywhere else (as far as 64 bits tell)?"""
        yes = self.multi.copy()
        found = {a["bucket"]: a["payload"] for a in answers if a["kind"] == kind}
        for b, s in by_bucket(self.bucket):
            if b in found:
                single = np.flatnonzero(~self.multi[s]) + s.start
                bits = np.unpackbits(np.frombuffer(found[b], np.uint8), count=len(single))
                yes[single[bits.astype(bool)]] = True
        out = np.zeros(len(self.values), dtype=bool)
        out[self.order] = yes
        return out[self.inverse]


def repeated_in_bucket(kind: int, chunks: list[int], payloads: list[bytes]) -> list[tuple]:
    """Answers of one bucket: a bit for each single of each chunk."""
    parts = [unblob(p, np.uint32, np.uint32) for p in payloads]
    singles = np.concatenate([p[0] for p in parts])
    multis = np.unique(np.concatenate([p[1] for p in parts]))
    values, inverse, count = np.unique(singles, return_inverse=True, return_counts=True)
    yes = count > 1
    if len(multis):
        at = np.searchsorted(multis, values)
        yes |= multis[np.minimum(at, len(multis) - 1)] == values
    hit = yes[inverse]
    rows, at = [], 0
    for chunk, p in zip(chunks, parts):
        bits = hit[at:at + len(p[0])]
        at += len(p[0])
        if bits.any():
            rows.append((kind, chunk, -1, np.packbits(bits).tobytes()))
    return rows


def each_bucket(questions: DataFrame, answer: Callable[[int, list[int], list[bytes]], list[tuple]]) -> DataFrame:
    """Apply ``answer(kind, chunks, payloads)`` to the questions of each (kind, bucket)."""
    def run(key, table):
        kind, bucket = key[0].as_py(), key[1].as_py()
        rows = answer(kind, table.column("chunk").to_pylist(), table.column("payload").to_pylist())
        out = part_table([(k, c, bucket, p) for k, c, _, p in rows])
        del rows
        give_back()
        return out

    return questions.groupBy("kind", "bucket").applyInArrow(run, PART)


# ---------------------------------------------------------------- components


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(id, component: smallest id reachable) for the ends of edges (a, b).

    Min-label propagation with pointer jumping; each round is a reliable
    checkpoint, so the number of rounds is logarithmic for chains in practice
    and a lost executor costs one round.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    both = (edges.select(F.col("a").alias("id"), F.col("b").alias("other"))
            .unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("other"))).distinct())
    both = both.checkpoint()
    label = both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component")).checkpoint()
    while True:
        near = (both.join(label.select(F.col("id").alias("other"), "component"), "other")
                .groupBy("id").agg(F.min("component").alias("near")))
        step = (label.join(near, "id", "left")
                .select("id", F.col("component").alias("old"),
                        F.least("component", F.coalesce("near", "component")).alias("component")))
        jump = label.select(F.col("id").alias("component"), F.col("component").alias("root"))
        new = (step.join(jump, "component", "left")
               .select("id", "old", F.least("component", F.coalesce("root", "component")).alias("component"))
               .checkpoint())
        moved = new.where(F.col("old") != F.col("component")).limit(1).count()
        label = new.select("id", "component")
        if not moved:
            return label


# ------------------------------------------------------------- worker state


WORKER_STATE = "_llm_worker_state"


def worker_state(name: str, make: Callable):
    """An object kept by the Python worker across tasks (closures are shipped by
    value, so module globals are not)."""
    import sys
    import types
    held = sys.modules.setdefault(WORKER_STATE, types.ModuleType(WORKER_STATE))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def give_back():
    """Return freed memory to the system: Python workers outlive their tasks."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable) -> Callable:
    """``run`` of mapInArrow in a worker that keeps nothing: what another operator
    left there goes before, freed memory after."""
    def task(batches):
        import gc
        import sys
        sys.modules.pop(WORKER_STATE, None)
        try:
            yield from run(batches)
        finally:
            gc.collect()
            give_back()
    return task


def small_batches(spark: SparkSession, rows: int = 2000):
    """Let Arrow batches hold at most ``rows`` rows; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


class Memo:
    """Ids of byte strings, kept for up to ``most`` of them; ``encode`` makes them,
    as little-endian 32-bit strings. When full, those asked for most often stay (half at most)."""

    most = 250_000

    def __init__(self):
        self.clear()

    def clear(self):
        self.slot, self.used = {}, 0
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.ptr = np.zeros(1 << 12, dtype=np.int64)
        self.asked = np.zeros(1 << 12, dtype=np.int32)

    def _thin(self):
        n = len(self.slot)
        asked = self.asked[:n]
        least = max(2, int(np.partition(asked, n // 2)[n // 2]) + 1)
        keep = asked >= least
        stay = np.flatnonzero(keep)
        size = np.diff(self.ptr[:n + 1])[stay]
        ids = self.gather(stay)
        words = [w for w, k in zip(self.slot, keep.tolist()) if k]
        self.clear()
        self.slot = dict(zip(words, range(len(words))))
        self.used = len(ids)
        self._grow("ids", len(ids))
        self._grow("ptr", len(words) + 1)
        self._grow("asked", len(words) + 1)
        self.ids[:len(ids)] = ids
        self.ptr[1:len(words) + 1] = np.cumsum(size)
        self.asked[:len(words)] = 1

    def encode(self, words: list[bytes]) -> list[bytes]:
        raise NotImplementedError

    def _grow(self, name, need):
        a = getattr(self, name)
        if need > len(a):
            b = np.zeros(max(need, 2 * len(a)), dtype=a.dtype)
            b[:len(a)] = a
            setattr(self, name, b)

    def slots(self, words: list[bytes]) -> np.ndarray:
        """Places of the ids of (distinct) words; valid until the next call."""
        if len(self.slot) + len(words) > self.most:
            self._thin()
        slot = self.slot
        new = [w for w in words if w not in slot]
        for lo in range(0, len(new), 5000):
            part = new[lo:lo + 5000]
            got = self.encode(part)
            n = len(slot)
            slot.update(zip(part, range(n, n + len(part))))
            ends = self.used + np.cumsum([len(g) // 4 for g in got])
            self._grow("ptr", n + len(part) + 1)
            self._grow("asked", n + len(part) + 1)
            self._grow("ids", int(ends[-1]))
            self.ptr[n + 1:n + len(part) + 1] = ends
            self.ids[self.used:ends[-1]] = np.frombuffer(b"".join(got), "<u4")
            self.used = int(ends[-1])
        got = np.array([slot[w] for w in words], dtype=np.int64)
        self.asked[got] += 1
        return got

    def gather(self, slot: np.ndarray) -> np.ndarray:
        """The ids of all slots, one after the other."""
        size = self.ptr[slot + 1] - self.ptr[slot]
        total = np.concatenate(([0], np.cumsum(size)))
        return self.ids[np.repeat(self.ptr[slot] - total[:-1], size) + np.arange(total[-1])]
