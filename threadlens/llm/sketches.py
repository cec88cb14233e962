"""Operator 7, near-duplicate documents by bottom-k MinHash sketches.

A document's set holds the hashes of its distinct ``shingle``-word shingles
(A-Z lower-cased); with fewer words the whole sequence is its one shingle, and
no word means an empty set, linked with nothing. Documents whose sets have a
Jaccard coefficient of at least ``percent``/100 are linked; a component is
named by its smallest doc_id, and that document is the one kept.

One hash function gives every shingle a value; the sketch is the k least. Of
two linked documents at least 80 % of the sketch of their union lies in both,
so three values that are neighbours in the union's sketch lie in both for some
position: chance of none below 0.6955^k, 8e-11 for k = 64. Sets of up to about
a hundred shingles can't miss at all. (With at most five shingles, two
neighbours are needed; such sets list both.) Inverted lists therefore go by
triples of neighbouring retained values, which keeps common shingles apart.

Passes. 1: chunks of documents send their sets' fingerprints (equal sets meet,
the smallest document stands for them) and their triples. 2: representatives
with a repeated triple keep these and their set. Then, on representatives:
star rounds compare each component with one other of a shared list, which
joins large groups of copies without looking at all their pairs; at last all
pairs of a list across components are compared. A list longer than ``hot`` is
not paired: its documents are compared by prefix filter (the rarest fifth of
the shingles must meet, at ranks that leave room for the overlap), exact too. Pairs pass the size bound, the
Jaccard estimate of the union sketch, then the exact count on full sets.

Null doc_id: no part. Repeated rows of one doc_id stand for themselves and get
the same component. Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from threadlens.llm import common as C

MARK, SET = 1, 2
MEMBER = "doc_id long, n_shingles long, rep long, keys array<long>, members binary"


class _Sets:
    """Distinct shingle hashes of a chunk's documents, ascending in each."""

    def __init__(self, chunk: C.Chunk, shingle: int, k: int):
        _, _, h, ptr = C.words(chunk.data, chunk.offs, lower=True)
        count = np.diff(ptr)
        doc = np.repeat(np.arange(len(count)), count)
        left = count[doc] - (np.arange(len(h)) - ptr[:-1][doc])
        start = np.flatnonzero((left >= shingle) | ((left == count[doc]) & (left < shingle)))
        stop = np.minimum(start + shingle, ptr[1:][doc[start]])
        value = C.mix(C.Roll(h).span(start, stop) + (stop - start).astype(np.uint64))
        own = doc[start]
        order = np.lexsort((value, own))
        value, own = value[order], own[order]
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
        self.value, self.own = value[new], own[new]
        docs = len(count)
        self.ptr = np.searchsorted(self.own, np.arange(docs + 1))
        self.n = np.diff(self.ptr)
        self.rank = np.arange(len(self.value)) - self.ptr[self.own]
        self.ids = chunk.ids
        a, b = (np.concatenate(([np.uint64(0)], np.cumsum(x)))[self.ptr] for x in (
            C.mix(self.value), C.mix(self.value ^ np.uint64(C.BASE_B))))
        a, b = a[1:] - a[:-1], b[1:] - b[:-1]
        self.a, self.b = C.mix(a + self.n.astype(np.uint64)), b
        self.keys, self.key_doc = self._keys(k)

    def _keys(self, k):
        """Triples of neighbouring retained values; pairs too for tiny sets."""
        v, size = self.value, np.minimum(self.n, k)[self.own]
        t = np.flatnonzero(self.rank + 2 < size)
        three = C.mix(C.mix(v[t]) + np.uint64(3) * C.mix(v[t + 1] + np.uint64(1)) +
                      np.uint64(5) * C.mix(v[t + 2] + np.uint64(2))) if len(t) else v[:0]
        p = np.flatnonzero((self.rank + 1 < size) & (self.n[self.own] <= 5))
        two = C.mix(C.mix(v[p]) + np.uint64(7) * C.mix(v[p + 1] + np.uint64(4))) if len(p) else v[:0]
        keys, doc = np.concatenate([three, two]), np.concatenate([self.own[t], self.own[p]])
        order = np.argsort(doc, kind="stable")
        return keys[order], doc[order]


class _Equal:
    """Distinct set fingerprints of a chunk and the smallest document of each."""

    def __init__(self, s: _Sets, buckets: int):
        some = np.flatnonzero(s.n > 0)
        order = some[np.lexsort((s.ids[some], s.b[some], s.a[some]))]
        a, b, d = s.a[order], s.b[order], s.ids[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.docs, self.group = order, np.cumsum(new) - 1
        self.a, self.b, self.least = a[new], b[new], d[new]
        bucket = ((self.a >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.order]

    def questions(self):
        return [(SET, k, C.blob(self.a[self.order[s]], self.b[self.order[s]], self.least[self.order[s]]))
                for k, s in C.by_bucket(self.bucket)]

    def reps(self, answers, ids) -> np.ndarray:
        """Per document: the smallest document with its set."""
        least = self.least.copy()
        found = {x["bucket"]: x["payload"] for x in answers if x["kind"] == SET}
        for k, s in C.by_bucket(self.bucket):
            if k in found:
                least[self.order[s]] = np.frombuffer(found[k], np.int64)
        out = ids.copy()
        out[self.docs] = least[self.group]
        return out


def _answer(kind, chunks, payloads):
    if kind == MARK:
        return C.repeated_in_bucket(kind, chunks, payloads)
    parts = [C.unblob(p, np.uint64, np.uint64, np.int64) for p in payloads]
    a, b, d = (np.concatenate([p[k] for p in parts]) for k in range(3))
    order = np.lexsort((d, b, a))
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    least = np.empty(len(a), dtype=np.int64)
    least[order] = d[order][new][np.cumsum(new) - 1]
    rows, at = [], 0
    for chunk, p in zip(chunks, parts):
        got = least[at:at + len(p[0])]
        at += len(p[0])
        if (got != p[2]).any():
            rows.append((kind, chunk, -1, got.tobytes()))
    return rows


def _members(docs: DataFrame, shingle: int, k: int) -> DataFrame:
    """MEMBER rows: keys and sets only for representatives with a shared triple."""
    base = C.whole(docs)
    sizes = C.Sizes(C.text_bytes(base))
    buckets = sizes.buckets

    def first(chunk):
        s = _Sets(chunk, shingle, k)
        return C.Marks(s.keys, buckets).questions(MARK) + _Equal(s, buckets).questions()

    chunks = C.stage(C.chunked(base, sizes.chunk, first), "sketches")
    got = C.each_bucket(chunks.where(F.col("kind") != C.TEXT), _answer)

    def second(batches):
        for batch in batches:
            for _, chunk, answers in C.answer_lists(batch):
                s = _Sets(chunk, shingle, k)
                rep = _Equal(s, buckets).reps(answers, s.ids)
                again = C.Marks(s.keys, buckets).repeated(MARK, answers)
                keep = again & (rep == s.ids)[s.key_doc]
                keys, doc = s.keys[keep].view(np.int64), s.key_doc[keep]
                ptr = np.searchsorted(doc, np.arange(len(s.ids) + 1))
                lists, sets = [], []
                for i in range(len(s.ids)):
                    some = ptr[i + 1] > ptr[i]
                    lists.append(keys[ptr[i]:ptr[i + 1]] if some else None)
                    sets.append(s.value[s.ptr[i]:s.ptr[i + 1]].tobytes() if some else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.ids, pa.int64()), pa.array(s.n, pa.int64()), pa.array(rep, pa.int64()),
                     pa.array(lists, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
                    names=["doc_id", "n_shingles", "rep", "keys", "members"])

    return C.stage(C.with_answers(chunks, got).mapInArrow(C.lean(second), MEMBER), "members")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int, k: int) -> DataFrame:
    """Linked pairs (a, b) among candidates (a, b); ``sets``: rep, members."""
    sketch = sets.select("rep", F.expr(f"substring(members, 1, {8 * k})").alias("s"))

    def joined(p, t, col):
        return (p.join(t.select(F.col("rep").alias("a"), F.col(col).alias("x")), "a")
                .join(t.select(F.col("rep").alias("b"), F.col(col).alias("y")), "b")
                .select("a", "b", "x", "y"))

    slack = 6 * math.sqrt(percent / 100 * (1 - percent / 100) / k)

    def tested(test):
        def run(batches):
            for batch in batches:
                x, y = batch.column(2), batch.column(3)
                keep = [test(np.frombuffer(x[i].as_py(), np.uint64), np.frombuffer(y[i].as_py(), np.uint64))
                        for i in range(batch.num_rows)]
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        return run

    def estimate(x, y):
        union = np.union1d(x, y)[:k]
        both = np.intersect1d(x, y, assume_unique=True)
        return np.isin(union, both, assume_unique=True).sum() >= (percent / 100 - slack) * len(union)

    def exact(x, y):
        n = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * n >= percent * (len(x) + len(y) - n)

    likely = joined(pairs, sketch, "s").mapInArrow(C.lean(tested(estimate)), "a long, b long")
    return joined(likely, sets, "members").mapInArrow(C.lean(tested(exact)), "a long, b long")


def _fits(a, b, percent):
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def _labelled(lists: DataFrame, links: DataFrame | None) -> DataFrame:
    """lists with the component of each representative so far."""
    if links is None:
        return lists.withColumn("comp", F.col("rep"))
    comp = C.components(links).select(F.col("id").alias("rep"), F.col("component").alias("c"))
    return lists.join(comp, "rep", "left").withColumn("comp", F.coalesce("c", "rep")).drop("c")


def _star(lists: DataFrame, percent: int) -> DataFrame:
    """One candidate pair for each component that shares a list with a smaller one."""
    centre = (lists.groupBy("key").agg(F.min(F.struct("comp", "rep", "n")).alias("m"),
                                       F.max("comp").alias("top"))
              .where(F.col("m.comp") < F.col("top")))
    met = (lists.join(centre, "key").where(F.col("comp") != F.col("m.comp"))
           .where(_fits(F.col("n"), F.col("m.n"), percent))
           .groupBy("comp", F.col("m.rep").alias("a"), F.col("rep").alias("b"))
           .agg(F.count(F.lit(1)).alias("shared")))
    return (met.groupBy("comp").agg(F.max(F.struct("shared", "a", "b")).alias("p"))
            .select("p.a", "p.b"))


def _across(lists: DataFrame, percent: int, ranked: bool = False) -> DataFrame:
    """All pairs of a list whose components differ and sizes fit.

    With ``ranked`` lists the shared shingle's ranks bound the overlap as well:
    at the first shared one, what follows in either set must suffice."""
    cols = ["rep", "n", "comp"] + ["r"] * ranked
    x = lists.select("key", *[F.col(c).alias(f"{c}_a") for c in cols])
    y = lists.select("key", *[F.col(c).alias(f"{c}_b") for c in cols])
    na, nb = F.col("n_a"), F.col("n_b")
    meets = (F.col("rep_a") < F.col("rep_b")) & (F.col("comp_a") != F.col("comp_b")) & _fits(na, nb, percent)
    if ranked:
        most = 1 + F.least(na - F.col("r_a"), nb - F.col("r_b"))
        meets &= (100 + percent) * most >= percent * (na + nb)
    return x.join(y, "key").where(meets).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def _prefix_lists(docs: DataFrame, percent: int) -> DataFrame:
    """Lists by rare shingles for documents (rep, n, comp, members): of two
    linked sets the rarest ``n - ceil(percent n) + 1`` shingles must meet."""
    def explode(batches):
        for batch in batches:
            values = [np.frombuffer(x.as_py(), np.int64) for x in batch.column(3)]
            size = [len(v) for v in values]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.asarray(batch.column(i)), size), pa.int64()) for i in range(3)] +
                [pa.array(np.concatenate(values) if values else np.zeros(0, np.int64), pa.int64())],
                names=["rep", "n", "comp", "key"])

    tokens = docs.select("rep", "n", "comp", "members").mapInArrow(
        C.lean(explode), "rep long, n long, comp long, key long")
    freq = tokens.groupBy("key").agg(F.count(F.lit(1)).alias("df"), F.min("comp").alias("lo"),
                                     F.max("comp").alias("hi"))
    ranked = (tokens.join(freq, "key")
              .withColumn("r", F.row_number().over(W.partitionBy("rep").orderBy("df", "key"))))
    need = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) + 1
    return ranked.where((F.col("r") <= need) & (F.col("lo") < F.col("hi"))).select("key", "rep", "n", "comp", "r")


def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80, k: int = 64,
                    hot: int = 32, stars: int = 2) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    members = _members(docs, shingle, k)
    sets = (members.where(F.col("members").isNotNull())
            .groupBy("rep").agg(F.first("members").alias("members"), F.first("n_shingles").alias("n")))
    lists = C.stage(members.where(F.col("keys").isNotNull())
                    .select("rep", F.col("n_shingles").alias("n"), F.explode("keys").alias("key")).distinct(),
                    "lists")
    links = None

    def add(found):
        new = C.stage(found, "links")
        return new if links is None else links.unionByName(new)

    for _ in range(stars):
        links = add(_confirm(_star(_labelled(lists, links), percent), sets, percent, k))
    named = _labelled(lists, links)
    size = (named.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("lo"),
                                     F.max("comp").alias("hi")).where(F.col("lo") < F.col("hi")))
    open_lists = C.stage(named.join(size.select("key", "m"), "key"), "open-lists")
    cold = open_lists.where(F.col("m") <= hot).drop("m")
    warm = (open_lists.where(F.col("m") > hot).select("rep", "n", "comp").distinct()
            .join(sets.select("rep", "members"), "rep"))
    pairs = _across(cold, percent).unionByName(_across(_prefix_lists(warm, percent), percent, ranked=True)).distinct()
    links = add(_confirm(pairs, sets, percent, k))
    comp = C.components(links).select(F.col("id").alias("rep"), "component")
    return (members.join(comp, "rep", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))
