"""Operator 4, document fingerprints by Merkle trees over sections and paragraphs.

Tree: a document has sections, a section has paragraphs (lines), a paragraph
has leaves. A leaf ends where the hash of the last eight bytes says so (one
byte in ``leaf`` on average) or with its paragraph, so an edit changes only the
leaves it touches. A paragraph's digest is BLAKE2b over its bytes; a section
ends with an empty line or by its last paragraph's digest; digests of sections
and of the root are BLAKE2b over their children. Equal roots: equal texts.

The fingerprint is ``root:leaves``, leaves as 24-bit digests, ``.`` between
sections and ``,`` between paragraphs. Likeness is the Dice coefficient of the
leaf multisets; ``differing`` walks two trees from the roots to the paragraphs
that differ.

Neighbours: documents are dealt to ranges of doc_id and sorted there; each
range also gets the first document of the next one, so every document meets its
successor while a task streams its range. One shuffle of the texts; the driver
holds the range bounds only. Rows of one doc_id are ordered by text. Null texts
are empty; no text at all has likeness 1 to another empty one, 0 to others.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from threadlens.llm import common as C

LEAF = 32


def _leaves(texts: list[bytes], leaf: int):
    """Ends of the leaves of each text and their digests (24 bits)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    offs = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n = len(data)
    if n == 0:
        return offs, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    end = np.zeros(n + 1, dtype=bool)
    end[offs[1:]] = True
    begin = np.repeat(offs[:-1], sizes)                      # a window never reaches into another text
    for lo in range(0, n, 1 << 20):                          # bounded work on very long texts
        hi, back = min(lo + (1 << 20), n), min(lo, 8)
        roll = C.Roll(C.byte_codes()[data[lo - back:hi]])
        at = np.arange(lo, hi) - lo + back + 1
        g = C.mix(roll.span(np.maximum(at - 8, begin[lo:hi] - lo + back), at))
        end[lo + 1:hi + 1] |= g % np.uint64(leaf) == 0
    end[1:] |= data == 10
    end[0] = False
    ends = np.flatnonzero(end)
    starts = np.concatenate(([0], ends[:-1]))
    digest = np.empty(len(ends), dtype=np.uint64)
    i = 0
    while i < len(ends):
        j = max(int(np.searchsorted(ends, starts[i] + (1 << 20), side="right")), i + 1)
        lo = int(starts[i])
        roll = C.Roll(C.byte_codes()[data[lo:ends[j - 1]]])
        digest[i:j] = C.mix(roll.span(starts[i:j] - lo, ends[i:j] - lo) + (ends[i:j] - starts[i:j]).astype(np.uint64))
        i = j
    return offs, ends, digest & np.uint64(0xFFFFFF)


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=16).digest()


def trees(texts: list[bytes], leaf: int = LEAF) -> list[tuple[bytes, list]]:
    """(root, sections) of each text; section: (digest, paragraphs); paragraph:
    (digest, start byte, end byte, leaf digests)."""
    offs, ends, digest = _leaves(texts, leaf)
    digest = digest.tolist()
    out = []
    for k, text in enumerate(texts):
        base, at = int(offs[k]), int(np.searchsorted(ends, offs[k], side="right"))
        stop = int(np.searchsorted(ends, offs[k + 1], side="right"))
        sections, paragraphs, lo = [], [], 0
        mine = (ends[at:stop] - base).tolist()
        pos = 0
        while lo < len(text):
            hi = text.find(b"\n", lo) + 1 or len(text)
            first = pos
            while pos < len(mine) and mine[pos] <= hi:
                pos += 1
            d = _digest(text[lo:hi])
            paragraphs.append((d, lo, hi, digest[at + first:at + pos]))
            if hi - lo == 1 or d[0] % 8 == 0 or hi == len(text):
                sections.append((_digest(*[p[0] for p in paragraphs]), paragraphs))
                paragraphs = []
            lo = hi
        out.append((_digest(*[s[0] for s in sections]), sections))
    return out


def fingerprint(tree) -> str:
    root, sections = tree
    return root.hex() + ":" + ".".join(
        ",".join("".join(f"{x:06x}" for x in p[3]) for p in s[1]) for s in sections)


def leaves_of(tree) -> Counter:
    return Counter(x for s in tree[1] for p in s[1] for x in p[3])


def likeness(a: Counter, b: Counter) -> float:
    n = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / n if n else 1.0


def differing(a, b) -> list[tuple[int, int]]:
    """Byte ranges of a's paragraphs that b lacks, found from the root down."""
    if a[0] == b[0]:
        return []
    other_sections = {s[0] for s in b[1]}
    other = {p[0] for s in b[1] for p in s[1]}
    return [(p[1], p[2]) for s in a[1] if s[0] not in other_sections for p in s[1] if p[0] not in other]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _ranges(base: DataFrame, total: int) -> tuple[DataFrame, int]:
    """base with ``_range``: ascending ranges of doc_id of about equal rows."""
    from pyspark.ml.feature import Bucketizer
    many = int(min(10_000, max(1, total // (4 << 20))))
    bounds = base.select("doc_id").approxQuantile("doc_id", [i / many for i in range(1, many)], 0.1 / many) \
        if many > 1 else []
    inner = sorted({float(b) for b in bounds})
    splits = [-float("inf"), *inner, float("inf")]
    if len(splits) < 3:
        return base.withColumn("_range", F.lit(0)), 1
    cut = Bucketizer(splits=splits, inputCol="_id", outputCol="_range")
    out = cut.transform(base.withColumn("_id", F.col("doc_id").cast("double"))).drop("_id")
    return out.withColumn("_range", F.col("_range").cast("int")), len(splits) - 1


def document_fingerprints(docs: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    base = C.whole(docs)
    ranged, many = _ranges(base, C.text_bytes(base))
    # first document of each range (at most one a range), handed to the range before it
    first = ranged.groupBy("_range").agg(F.min("doc_id").alias("doc_id"))
    heads = (ranged.join(F.broadcast(first), ["_range", "doc_id"])
             .groupBy("_range", "doc_id").agg(F.min("text").alias("text")))
    before = first.select("_range", F.lag("_range").over(W.orderBy("_range")).alias("_to"),
                          F.max("_range").over(W.orderBy(F.lit(0)).rowsBetween(
                              W.unboundedPreceding, W.unboundedFollowing)).alias("_last"))
    heads = (heads.join(F.broadcast(before), "_range")
             .select(F.coalesce("_to", "_last").alias("_range"), "doc_id", "text", F.lit(1).alias("_head")))
    rows = (ranged.withColumn("_head", F.lit(0)).unionByName(heads)
            .repartition(many, "_range").sortWithinPartitions("_range", "_head", "doc_id", "text")
            .select("_range", "_head", "doc_id", "text"))

    def run(batches):
        held = None                                          # the document waiting for its successor
        for batch in batches:
            ranges, heads_, ids = (batch.column(k).to_pylist() for k in range(3))
            data, offs = C.strings(batch.column(3))
            for i, j in C.pieces(offs, 1 << 19):
                texts = [data[offs[x]:offs[x + 1]].tobytes() for x in range(i, j)]
                now = [(ranges[x], heads_[x], ids[x], t, tr)
                       for x, t, tr in zip(range(i, j), texts, trees(texts, leaf))]
                line = ([held] if held else []) + now
                todo = []
                for a, b in zip(line, line[1:]):
                    if not a[1]:                             # b is a's successor, or the head handed over
                        own = a[3].decode()
                        k = len(own) // 4
                        todo.append((a, b, own, (own[:len(own) - k] + b[3].decode()[:k]).encode()))
                held = line[-1]
                if todo:
                    rows = []
                    for (a, b, own, _), tree, raw in zip(todo, trees([t[3] for t in todo], leaf),
                                                         [t[3] for t in todo]):
                        mine = leaves_of(a[4])
                        rows.append((a[2], len(own), hashlib.sha256(raw).hexdigest(), fingerprint(a[4]),
                                     fingerprint(tree), likeness(mine, leaves_of(tree)),
                                     likeness(mine, leaves_of(b[4]))))
                    yield pa.RecordBatch.from_pydict(dict(zip(
                        ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                         "near_edited", "near_next"), map(list, zip(*rows)))))

    return rows.mapInArrow(run, RESULT)
