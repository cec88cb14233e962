"""Operator 11, ranked lexical search over buckets of falling vector length (LEMP).

Terms are maximal runs of ASCII letters and digits and of all characters beyond
ASCII; A-Z are lower-cased. N documents hold a term, with L terms in all; a
document has n terms, df documents hold a term, it occurs tf times in one. A
term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); with m = 10 + (90 n N) div L
a document's impact on it is w * ((10^9 tf) div (1000 tf + 8 m)). An item scores
the sum of a document's impacts over its distinct terms: the inner product of
the item's 0/1 vector and the document's impact vector.

Impact vectors (over the terms that any item has) lie in buckets of falling
length. The longest bucket gives each item a score that k documents reach; with
this floor the items meet the other buckets. There:

- Cauchy-Schwarz: a bucket whose greatest length times the item's length (the
  root of its terms found in the bucket) is below the floor is left;
- coordinates: so is one whose greatest impacts on the item's terms add up to
  less; terms are then taken by falling greatest impact until what remains can
  no longer reach the floor: a document without any of these cannot either;
- inside, a document stays if its partial sum plus the lesser of the remaining
  greatest impacts and the product of the residual lengths can reach the floor;
- survivors are scored anew in 64-bit integers.

Items are the query set: they go to the workers, in blocks of at most
``ITEM_BYTES`` of text (a longer item is a block's share by itself), one pass
over the documents a block. No table of documents or vectors is broadcast or
collected; per block the driver holds its items, the df of its terms and a
floor an item.

Rows without doc_id or item_id name nothing and take no part. A null text has
no terms; items without terms, and documents that score 0, give no rows. Rows
that share an item_id are one item with the terms of all; rows that share a
doc_id are a document each. Ties go to the smaller doc_id. Empty tables: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from threadlens.llm import common as C

ITEM_BYTES = 16 << 20                                        # text of the items of one block
ENTRIES = 1 << 20                                            # vector entries of a bucket, about
LEVELS = 256

#: Bytes that part terms: ASCII other than letters and digits (fixed values).
_APART = np.zeros(256, dtype=bool)
_APART[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def _terms(data: np.ndarray, offs: np.ndarray):
    """(pointer by document, hash) of all terms."""
    _, _, h, ptr = C.words(data, offs, lower=True, space=_APART)
    return ptr, h


class Items:
    """A block of items: ids, and for each the places of its terms among the
    block's distinct term hashes."""

    def __init__(self, rows: list[tuple[int, str]]):
        found: dict[int, list[np.ndarray]] = {}
        for item, text in rows:
            raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
            found.setdefault(item, []).append(_terms(raw, np.array([0, len(raw)]))[1])
        sets = {i: np.unique(np.concatenate(h)) for i, h in found.items()}
        sets = {i: h for i, h in sorted(sets.items()) if len(h)}
        self.ids = np.array(list(sets), dtype=np.int64)
        self.hashes = np.unique(np.concatenate([*sets.values(), np.zeros(0, np.uint64)]))
        self.terms = [np.searchsorted(self.hashes, h) for h in sets.values()]


def item_blocks(items: DataFrame, id_col: str, text_col: str):
    """Blocks of items, dealt by id; each holds about ``ITEM_BYTES`` of text."""
    named = items.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = C.text_bytes(named)
    blocks = max(1, math.ceil(total / ITEM_BYTES))
    for b in range(blocks):
        yield Items([tuple(r) for r in named.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()])


COUNTS = "doc_id long, n long, terms array<int>, tfs array<int>"


def term_counts(docs: DataFrame, items: Items) -> DataFrame:
    """COUNTS rows of all documents with a term: n, and tf of the items' terms."""
    hashes = items.hashes

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            data, offs = C.strings(batch.column(1))
            for i, j in C.pieces(offs, 4 << 20):
                ptr, h = _terms(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                n = np.diff(ptr)
                place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                hit = np.flatnonzero(hashes[place] == h)
                doc = np.repeat(np.arange(j - i), n)[hit]
                key, tf = np.unique(doc * len(hashes) + place[hit], return_counts=True)
                some = np.flatnonzero(n)
                cut = pa.array(np.searchsorted(key, np.append(some, j - i) * len(hashes)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i).take(pa.array(some)), pa.array(n[some]),
                     pa.ListArray.from_arrays(cut, pa.array(key % len(hashes), pa.int32())),
                     pa.ListArray.from_arrays(cut, pa.array(tf, pa.int32()))],
                    names=["doc_id", "n", "terms", "tfs"])

    C.small_batches(docs.sparkSession)
    return C.whole(docs).mapInArrow(C.lean(run), COUNTS)


class Impacts:
    """Impact vectors from counts, for a corpus of ``docs`` documents and ``total`` terms."""

    def __init__(self, docs: int, total: int, df: np.ndarray):
        self.docs, self.total = docs, total
        self.weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * x + 1))) for x in df.tolist()],
                               dtype=np.int64)

    def of(self, batch):
        """(documents' pointer, terms, impacts, lengths) of COUNTS columns."""
        lists = batch.column("terms")
        ptr = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        terms, tf = np.asarray(lists.flatten()), np.asarray(batch.column("tfs").flatten()).astype(np.int64)
        m = 10 + 90 * np.asarray(batch.column("n")) * self.docs // self.total
        x = self.weight[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(ptr))))
        length = np.sqrt(np.bincount(np.repeat(np.arange(len(ptr) - 1), np.diff(ptr)),
                                     weights=x.astype(np.float64) ** 2, minlength=len(ptr) - 1))
        return ptr, terms, x, length


def _buckets(counts: DataFrame, impacts: Impacts) -> DataFrame:
    """(bucket, data): documents with their impact vectors, buckets of falling length."""
    def measure(batches):
        for batch in batches:
            ptr, _, _, length = impacts.of(batch)
            yield pa.RecordBatch.from_pydict({"length": length, "entries": np.diff(ptr).astype(np.int64)})

    lengths = C.stage(counts.mapInArrow(measure, "length double, entries long").where("length > 0"), "lengths")
    entries = lengths.agg(F.sum("entries")).first()[0] or 0
    levels = max(1, min(LEVELS, math.ceil(entries / ENTRIES)))
    bounds = (np.unique(lengths.approxQuantile("length", [i / levels for i in range(1, levels)], 0.1 / levels))
              if levels > 1 else np.zeros(0))

    def level_of(length):                                    # 0: the longest
        return len(bounds) - np.searchsorted(bounds, length, side="right")

    def level(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"level": level_of(np.asarray(batch.column(0))), "entries": batch.column(1)})

    held = {r["level"]: r["entries"] for r in lengths.mapInArrow(level, "level long, entries long")
            .groupBy("level").agg(F.sum("entries").alias("entries")).collect()}
    subs = np.array([max(1, math.ceil(held.get(k, 0) / ENTRIES)) for k in range(len(bounds) + 1)], dtype=np.int64)
    first = np.cumsum(subs) - subs

    def deal(batches):
        for batch in batches:
            _, _, _, length = impacts.of(batch)
            k = level_of(length)
            spread = C.mix(np.asarray(batch.column("doc_id")).astype(np.uint64) * np.uint64(C.BASE_A)
                           + np.arange(batch.num_rows, dtype=np.uint64))
            bucket = first[k] + (spread % subs[k].astype(np.uint64)).astype(np.int64)
            out = pa.RecordBatch.from_arrays([pa.array(bucket), *batch.columns],
                                             names=["bucket", *batch.schema.names])
            yield out.filter(pa.array(length > 0))

    def pack(key, table):
        batch = table.combine_chunks()
        cols = {c: batch.column(c).combine_chunks() for c in ("doc_id", "n", "terms", "tfs")}
        ptr, terms, x, length = impacts.of(pa.RecordBatch.from_pydict(cols))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "data": pa.array(
            [C.blob(np.asarray(cols["doc_id"]), ptr.astype(np.int64), terms.astype(np.int32), x, length)], pa.binary())})

    return (counts.mapInArrow(deal, "bucket long, " + COUNTS).groupBy("bucket")
            .applyInArrow(pack, "bucket long, data binary"))


class Bucket:
    """Documents of a bucket, their vectors by document and by term."""

    def __init__(self, raw: bytes, terms: int):
        self.ids, self.ptr, self.terms, self.impact, self.length = C.unblob(
            raw, np.int64, np.int64, np.int32, np.int64, np.float64)
        order = np.argsort(self.terms, kind="stable")
        self.rows = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.ptr))[order]
        self.values = self.impact[order].astype(np.float64)
        self.at = np.concatenate(([0], np.cumsum(np.bincount(self.terms, minlength=terms))))
        self.most = np.zeros(terms)
        some = np.flatnonzero(np.diff(self.at))
        if len(some):
            self.most[some] = np.maximum.reduceat(self.values, self.at[some])
        self.longest = float(self.length.max(initial=0))
        self.wanted = np.zeros(terms, dtype=bool)

    def exact(self, docs: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Integer scores of documents for an item."""
        size = np.diff(self.ptr)[docs]
        start = np.cumsum(size) - size
        entry = np.repeat(self.ptr[docs] - start, size) + np.arange(int(size.sum()))
        self.wanted[item] = True
        x = np.where(self.wanted[self.terms[entry]], self.impact[entry], 0)
        self.wanted[item] = False
        return np.add.reduceat(x, start) if len(docs) else np.zeros(0, np.int64)

    def best(self, item: np.ndarray, floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best documents that score ``floor`` or more, at least."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        item_here = item[self.most[item] > 0]
        slack = 1 + 1e-9
        if math.sqrt(len(item_here)) * self.longest * slack < floor:
            return none
        order = item_here[np.argsort(-self.most[item_here], kind="stable")]
        left = np.append(np.cumsum(self.most[order][::-1])[::-1], 0.0)       # greatest sum of the terms from here on
        if left[0] * slack < floor:
            return none
        lead = int(np.searchsorted(-left * slack, -float(floor), side="right"))
        lead = min(lead, len(order))                         # beyond these, the rest alone stays below the floor
        part, square = np.zeros(len(self.ids)), np.zeros(len(self.ids))
        for t in order[:lead].tolist():
            s = slice(self.at[t], self.at[t + 1])
            part[self.rows[s]] += self.values[s]
            square[self.rows[s]] += self.values[s] ** 2
        docs = np.flatnonzero(part)
        low = float(floor)
        if len(docs) > k:                                    # partial sums are reached already
            low = max(low, np.partition(part[docs], len(docs) - k)[len(docs) - k] / slack)
        residual = np.sqrt(np.maximum(self.length[docs] ** 2 * slack - square[docs], 0) * (len(order) - lead))
        docs = docs[(part[docs] + np.minimum(left[lead], residual)) * slack >= low]
        score = self.exact(docs, item)
        keep = score >= floor
        docs, score = docs[keep], score[keep]
        top = np.lexsort((self.ids[docs], -score))[:k]
        return docs[top], score[top]


HIT = "item_id long, doc_id long, score long"


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id",
                   text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score of each item's k best documents."""
    found = None
    for block in item_blocks(items, id_col, text_col):
        hits = _search(docs, block, k) if len(block.ids) else docs.sparkSession.createDataFrame([], HIT)
        found = hits if found is None else found.unionByName(hits)
    place = W.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def _search(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """HIT rows of a block of items: each bucket's k best at the floors reached."""
    counts = C.stage(term_counts(docs, items), "counts")
    many, total = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not many:
        return docs.sparkSession.createDataFrame([], HIT)
    df = np.zeros(len(items.hashes), dtype=np.int64)
    for r in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]                              # as many as the block has terms
    buckets = C.stage(_buckets(counts, Impacts(many, total, df)), "buckets")
    terms = len(df)

    def hits(floor: np.ndarray):
        def run(batches):
            for batch in batches:
                for raw in batch.column(0):
                    b = Bucket(raw.as_py(), terms)
                    out = [np.zeros((0, 3), np.int64)]
                    for q, item in enumerate(items.terms):
                        row, score = b.best(item, int(floor[q]), k)
                        if len(row):
                            out.append(np.stack([np.full(len(row), items.ids[q]), b.ids[row], score], axis=1))
                    got = np.concatenate(out)
                    yield pa.RecordBatch.from_pydict({"item_id": got[:, 0], "doc_id": got[:, 1], "score": got[:, 2]})
        return run

    low = np.ones(len(items.ids), dtype=np.int64)            # a score is above 0
    head = C.stage(buckets.where("bucket = 0").select("data").mapInArrow(hits(low), HIT), "head")
    place = W.partitionBy("item_id").orderBy(F.desc("score"))
    kth = head.withColumn("r", F.row_number().over(place)).where(F.col("r") == k).select("item_id", "score").collect()
    low[np.searchsorted(items.ids, [r["item_id"] for r in kth])] = [r["score"] for r in kth]
    rest = C.stage(buckets.where("bucket > 0").select("data").mapInArrow(hits(low), HIT), "hits")
    return head.unionByName(rest)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT count(*)::BIGINT AS big_n, sum(len(ts))::BIGINT AS big_l FROM d WHERE len(ts) > 0),
tf AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(ts)::BIGINT AS n, unnest(ts) AS term FROM d) GROUP BY r, doc_id, n, term),
q AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL)),
w AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
scores AS (
  SELECT item_id, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * big_n) // big_l)))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term), s GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
