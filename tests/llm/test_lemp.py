import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.llm import brute, data
from threadlens.llm import common as C
from threadlens.llm import lemp
from threadlens.llm.lemp import lexical_search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("doc_id", T.LongType()), T.StructField("n", T.StringType())])


def plain(rows, items, k=10):
    """Every item against every document, in Python's integers."""
    docs = [(i, Counter(TERM.findall(brute.low(t)))) for i, t in rows if i is not None]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    many, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(TERM.findall(brute.low(t)))
    out = []
    for i, terms in asked.items():
        found = []
        for d, c, n in docs:
            m = 10 + 90 * n * many // total
            s = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) *
                    (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                found.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return sorted(out)


def items_of(rows, n=40):
    r = random.Random(5)
    out = []
    for i in range(n):
        w = (r.choice(rows)[1] or "").split()
        at = r.randrange(len(w) + 1)
        out.append((i * 3 - 20, " ".join(w[at:at + r.choice([1, 3, 30])]).upper() if r.random() < .5 else
                    "-".join(w[at:at + 8]) + ", nowhere"))
    return out + [(500, None), (501, ""), (502, "..."), (503, "same word"), (504, rows[-1][1]), (505, "nothing here"),
                  (503, "two"), (503, "two"), (None, "same")]


def frames(spark, rows, items):
    return (data.frame(spark, rows).repartition(3),
            spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEM))


@pytest.mark.parametrize("entries,text", [(1 << 20, 1 << 24), (200, 1 << 24), (2000, 30_000)])
def test_search_as_brute_force(spark, monkeypatch, entries, text):
    monkeypatch.setattr(lemp, "ENTRIES", entries)
    monkeypatch.setattr(lemp, "ITEM_BYTES", text)
    rows = data.rows(6, 150)
    items = items_of(rows)
    rows += [(9000 + i, rows[40][1]) for i in range(30)] + [(None, "same word"), (9000, rows[40][1])]   # ties, a repeated row
    d, q = frames(spark, rows, items)
    got = lexical_search(d, q)
    assert [f.dataType for f in got.schema] == [T.LongType(), T.IntegerType(), T.LongType(), T.LongType()]
    assert data.result(got, "item_id", "rank", "doc_id", "score") == plain(rows, items)


def test_empty_tables(spark):
    rows, items = [(1, "a b"), (2, "c")], [(7, "a")]
    for r, i in (([], items), (rows, []), ([], []), ([(1, None), (2, ".")], items), (rows, [(1, "zz")])):
        assert lexical_search(*frames(spark, r, i)).collect() == []
    assert data.result(lexical_search(*frames(spark, rows, items)), "item_id", "rank", "doc_id", "score") == plain(rows, items)


def test_bounds_leave_buckets_and_documents():
    """A bucket below the floor is left by length or by coordinates; inside, only survivors are scored."""
    r = np.random.default_rng(1)
    size = r.integers(1, 12, 400)
    terms = np.concatenate([np.sort(r.choice(60, s, replace=False)) for s in size]).astype(np.int32)
    x = r.integers(1, 1000, len(terms))
    ptr = np.concatenate(([0], np.cumsum(size)))
    length = np.sqrt(np.add.reduceat(x.astype(float) ** 2, ptr[:-1]))
    b = lemp.Bucket(C.blob(np.arange(400), ptr, terms, x, length), 60)
    scored = []
    exact = b.exact
    b.exact = lambda docs, item: (scored.append(len(docs)), exact(docs, item))[1]
    dense = np.zeros((400, 60), dtype=np.int64)
    for d in range(400):
        dense[d, terms[ptr[d]:ptr[d + 1]]] = x[ptr[d]:ptr[d + 1]]
    for _ in range(200):
        item = np.sort(r.choice(60, r.integers(1, 20), replace=False))
        full = dense[:, item].sum(1)
        floor = int(r.choice([1, np.sort(full)[-5], np.sort(full)[-30], 10 ** 6]))
        want = sorted((-s, d) for d, s in enumerate(full.tolist()) if s >= floor)[:7]
        row, score = b.best(item, floor, 7)
        assert [(-s, d) for d, s in zip(row.tolist(), score.tolist())] == want
    assert sum(scored) < 200 * 400 / 4
    scored.clear()
    assert not len(b.best(np.arange(5), int(math.sqrt(5) * b.longest * 1.01) + 1, 7)[0]) and not scored
