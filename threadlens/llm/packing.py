"""Operator 3, packing token sequences by cutting-stock column generation.

A document's ids are cut into pieces of ``capacity`` and a remainder. Lengths
are counted in classes of ``unit`` tokens. The linear program over patterns
(how many pieces of each class share a sequence) starts from one class a
pattern; a knapsack by dynamic programming prices new patterns with the duals
until none is worth more than a sequence. Patterns are used as often as their
rounded-down share says, the small rest is packed first-fit decreasing into
further patterns, and the pieces, ranked within their class, take the slots.

The driver holds one count a class and the patterns, whatever the input. Ranks
come from counts of (class, part) and a window within each, so no class meets
in one task. Null text is empty: one piece with the closing id. Repeated rows
are packed once each. Empty table: no rows.

Tokenizing: white space parts the text into words that the tokenizer treats
independently (it drops white space and its patterns never cross it), so each
distinct word of a block is encoded once, with a bounded memo in the worker.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from threadlens.llm import common as C

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: The normalizer and splitting pattern (fixed values of word_bpe_49k.json) for
#: which words of ASCII and Latin-1 letters are split here.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class _Encoder(C.Memo):
    """Ids of words by a tokenizer file. Where the file lower-cases and splits by
    ``_SPLIT``, plain words are split here and only their distinct parts go to the
    tokenizer's model; all other words take the whole tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = [x.get("pattern", {}).get("Regex") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.plain = steps == ["NFC", "Replace", "Lowercase"] and splits == [_SPLIT, None]
        # byte-level alphabet: printable bytes stand for themselves, others for code points from 256
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.letter = {b: chr(256 + k) for k, b in enumerate(rest)}
        self.part: dict[str, bytes] = {}
        super().__init__()

    def _part_ids(self, part: str) -> bytes:
        got = self.part.get(part)
        if got is None:
            if len(self.part) >= self.most:
                self.part.clear()
            text = part if part.isascii() else part.encode().decode("latin-1").translate(self.letter)
            got = self.part[part] = array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()
        return got

    def encode(self, words):
        out: list = [None] * len(words)
        others = []
        for k, w in enumerate(words):
            text = w.decode()
            if self.plain and _PLAIN.fullmatch(text) and "<|" not in text:
                parts = _PARTS.findall(text.lower())
                out[k] = self._part_ids(parts[0]) if len(parts) == 1 else b"".join(map(self._part_ids, parts))
            else:
                others.append(k)
        got = self.tokenizer.encode_batch([words[k].decode() for k in others], add_special_tokens=False)
        for k, e in zip(others, got):
            out[k] = array("I", e.ids).tobytes()
        return out


def token_ids(data: np.ndarray, offs: np.ndarray, encoder: _Encoder, closing: int):
    """Ids of all documents (each closed by ``closing``) and their pointer."""
    starts, ends, h, ptr = C.words(data, offs, lower=False)
    _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
    raw = data.tobytes()
    slot = encoder.slots([raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])[inverse]
    size = encoder.ptr[slot + 1] - encoder.ptr[slot]
    total = np.concatenate(([0], np.cumsum(size)))
    ids = encoder.gather(slot)
    close = total[ptr[1:]]
    return np.insert(ids, close, closing).astype("<u4"), np.concatenate(([0], close + np.arange(1, len(offs))))


def cut(docs: DataFrame, path: str, capacity: int, closing: int) -> DataFrame:
    """PIECE rows: full pieces and the remainder of each document."""
    def run(batches):
        encoder = C.worker_state("encoder_" + "".join(c if c.isalnum() else "_" for c in path),
                                 lambda: _Encoder(path))
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            data, offs = C.strings(batch.column(1))
            for i, j in C.pieces(offs, 4 << 20):
                ids, ptr = token_ids(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], encoder, closing)
                raw, rows = memoryview(ids.tobytes()), []
                for d, lo, hi in zip(doc_ids[i:j], ptr[:-1].tolist(), ptr[1:].tolist()):
                    for at in range(lo, hi, capacity):
                        end = min(at + capacity, hi)
                        rows.append((d, at - lo, end - at, zlib.crc32(raw[4 * at:4 * end]), hi - lo))
                yield pa.RecordBatch.from_pydict(dict(zip(
                    ("doc_id", "start", "length", "ids_crc32", "doc_tokens"), map(list, zip(*rows)))))

    return C.whole(docs).mapInArrow(run, PIECE)


# ------------------------------------------------------------ column generation


def _best_pattern(value: np.ndarray, size: np.ndarray, room: int):
    """Unbounded knapsack: counts of each item of greatest value within ``room``."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        best[r] = best[r - 1]
        fit = np.searchsorted(size, r, side="right")
        if fit:
            v = best[r - size[:fit]] + value[:fit]
            k = int(v.argmax())
            if v[k] > best[r] + 1e-12:
                best[r], pick[r] = v[k], k
    count, r = np.zeros(len(size), dtype=np.int64), room
    while r > 0:
        if pick[r] < 0:
            r -= 1
        else:
            count[pick[r]] += 1
            r -= int(size[pick[r]])
    return best[room], count


def column_generation(size: np.ndarray, demand: np.ndarray, room: int, rounds: int = 3000):
    """Patterns (rows: counts by class) and their fractional use.

    Revised simplex on the restricted program; every basis is feasible, so
    stopping after ``rounds`` only leaves it a little short of the optimum.
    """
    m = len(size)
    patterns = np.diag(room // size).astype(np.float64)      # a column per basis member
    inverse = np.diag(1.0 / np.diag(patterns))
    use = inverse @ demand
    for _ in range(rounds):
        dual = inverse.sum(axis=0)                           # all costs are one
        value, count = _best_pattern(dual, size, room)
        if value <= 1 + 1e-7:
            break
        u = inverse @ count
        ok = u > 1e-9
        ratio = np.where(ok, use / np.where(ok, u, 1), np.inf)
        k = int(ratio.argmin())
        step = max(ratio[k], 0.0)
        use = use - step * u
        use[k] = step
        patterns[:, k] = count
        row = inverse[k] / u[k]
        inverse = inverse - np.outer(u, row)
        inverse[k] = row
    return patterns.T.astype(np.int64), np.maximum(use, 0)


def plan(size: np.ndarray, demand: np.ndarray, room: int):
    """Patterns and whole numbers of sequences that hold exactly the demand."""
    some = demand > 0
    out, times = [], []
    left = demand.copy()
    if some.any():
        s = size[some]
        patterns, use = column_generation(s, demand[some].astype(np.float64), room)
        for p, x in zip(patterns, np.floor(use + 1e-9).astype(np.int64)):
            full = np.zeros(len(size), dtype=np.int64)
            full[some] = p
            used = full > 0
            x = min(int(x), int((left[used] // full[used]).min())) if used.any() else 0
            if x:
                out.append(full)
                times.append(x)
                left = left - x * full
    while left.any():                                        # first-fit decreasing, equal sequences at once
        free, p = room, np.zeros(len(size), dtype=np.int64)
        for c in np.flatnonzero(left)[::-1]:
            p[c] = min(left[c], free // size[c])
            free -= p[c] * size[c]
        used = p > 0
        x = int((left[used] // p[used]).min())
        out.append(p)
        times.append(x)
        left = left - x * p
    return np.array(out, dtype=np.int64).reshape(-1, len(size)), np.array(times, dtype=np.int64)


def assign(pieces: DataFrame, capacity: int, unit: int) -> DataFrame:
    """sequence_id and offset for pieces with a ``length``."""
    cls = F.ceil(F.col("length") / F.lit(unit)).cast("int")
    staged = pieces.withColumn("_class", cls)
    room = capacity // unit
    counts = {r["_class"]: r["n"] for r in
              staged.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = np.arange(1, room + 1)
    demand = np.array([counts.get(int(c), 0) for c in size], dtype=np.int64)
    patterns, times = plan(size, demand, room)
    base = np.concatenate(([0], np.cumsum(times)))[:-1]
    slots = {}                                               # class: slot bounds, pattern, pieces a sequence
    for c in np.flatnonzero(demand):
        p = np.flatnonzero(patterns[:, c])
        slots[int(c) + 1] = (np.cumsum(times[p] * patterns[p, c]), base[p], patterns[p, c])
    parts = max(1, int(demand.sum()) // 5000)
    part = staged.withColumn("_part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)))
    before = (part.groupBy("_class", "_part").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(
                  W.partitionBy("_class").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .drop("_n"))
    ranked = (part.withColumn("_rank", F.row_number().over(
                  W.partitionBy("_class", "_part").orderBy("doc_id", "start")) - 1)
              .join(before, ["_class", "_part"])
              .withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before", "_part"))
    schema = T.StructType(list(ranked.schema)).add("sequence_id", "long").add("_slot", "long")

    def place(batches):
        for batch in batches:
            c = np.asarray(batch.column(batch.schema.get_field_index("_class")))
            r = np.asarray(batch.column(batch.schema.get_field_index("_rank")))
            seq, slot = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
            for k in np.unique(c).tolist():
                ends, first, many = slots[k]
                mine = c == k
                p = np.searchsorted(ends, r[mine], side="right")
                t = r[mine] - np.concatenate(([0], ends))[p]
                seq[mine], slot[mine] = first[p] + t // many[p], t % many[p]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seq), pa.array(slot)],
                                             names=[*batch.schema.names, "sequence_id", "_slot"])

    order = W.partitionBy("sequence_id").orderBy(F.desc("_class"), "_slot")
    return (ranked.mapInArrow(place, schema)
            .withColumn("offset", F.coalesce(F.sum("length").over(
                order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("long"))
            .drop("_class", "_rank", "_slot"))


def pack(docs: DataFrame, path: str | None = None, capacity: int = 4096, unit: int = 16,
         closing: int = 2) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if capacity % unit:
        raise ValueError("unit must divide capacity")
    pieces = C.stage(cut(docs, path or default_tokenizer(), capacity, closing), "pieces")
    return assign(pieces, capacity, unit)
