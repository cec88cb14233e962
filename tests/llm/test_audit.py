import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.llm import brute, data
from threadlens.llm import audit
from threadlens.llm.audit import AUDIT, filter_audit

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                       T.StructField("toxic", T.IntegerType()), T.StructField("key", T.StringType())])
COLUMNS = [c.split()[0] for c in AUDIT.split(", ")]


def plain(rows, labels):
    """Each order applied left to right to the documents themselves."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    docs, good, bad = [], {i for i, q, _, _ in labels if q == 1}, {i for i, _, x, _ in labels if x == 1}
    for i, t, source in rows:
        if i is None:
            continue
        t = t or ""
        w = brute.WORD.findall(t)
        fails = {f for f, x in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w),
                                             100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                                             bool(re.search("[#$%&*|]", t)), first[t] < i)) if x}
        docs.append((source or "", i, fails))
    out = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        rowsets, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order):
                gone = [d for d in left if f in d[2]]
                left = [d for d in left if f not in d[2]]
                shapley[f] += len(gone)
                rowsets.append((part, "".join(order), step + 1, len(left), len(gone),
                                sum(f in d[2] for d in mine) - len(gone), sum(d[2] == {f} for d in mine),
                                sum(d[1] in good for d in gone), sum(d[1] in bad for d in gone), f))
        out += [(*r[:-1], shapley[r[-1]]) for r in rowsets]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, None, None, None) for i, t, s in rows], data.SCHEMA)


def awkward(n=150):
    r = random.Random(8)
    rows = []
    for i, t in data.rows(4, n):
        k = r.random()
        t = (t or "").title() if k < .2 else (t or "") + " #1" if k < .3 else " ".join((t or "").split()[:3] * 90) if k < .4 else t
        rows.append((i, t, r.choice(["a", "a", "a", "b", "", None, "é"])))
    copy = rows[30][1]
    rows += [(10_000 + i, copy, "a") for i in range(60)] + [(9_000, copy, "b")]     # a large group of copies
    rows += [(7, None, "c"), (7, "", "c"), (8, None, None), (None, "x", "a"), (7, "other", "a"), (9_000, copy, "b")]
    return rows


def awkward_labels(rows):
    r = random.Random(2)
    out = [(i, r.choice([0, 1, None]), r.choice([0, 1, None]), "k") for i, _, _ in rows if r.random() < .6]
    return out + [(7, 0, 1, None), (7, 1, 0, None), (None, 1, 1, None), (-99_999, 1, 1, None)]


@pytest.mark.parametrize("size", [1 << 16, 7])
def test_audit_as_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(audit, "RANGE", size)
    monkeypatch.setattr(audit, "BLOCK", 3 if size == 7 else 1024)
    rows = awkward()
    labels = awkward_labels(rows)
    got = filter_audit(frame(spark, rows).repartition(3), spark.createDataFrame(labels, LABELS))
    assert data.result(got, *COLUMNS) == plain(rows, labels)


def test_empty_tables(spark):
    assert filter_audit(frame(spark, []), spark.createDataFrame([], LABELS)).collect() == []
    got = filter_audit(frame(spark, [(1, "A b", None)]), spark.createDataFrame([], LABELS))
    assert data.result(got, *COLUMNS) == plain([(1, "A b", None)], [])


def test_postings_hold_the_failing_ids(spark):
    rows = awkward()
    labels = awkward_labels(rows)
    failed = audit.failures(frame(spark, rows), spark.createDataFrame(labels, LABELS))
    want = {(r["part"], f): sorted(x["doc_id"] for x in failed.collect() if x["part"] == r["part"] and x[f])
            for r in failed.select("part").distinct().collect() for f in "ABCDE"}
    got = {}
    for r in audit.postings(failed).collect():
        for f in "ABCDE":
            assert r[f] == sorted(set(r[f])) and r["ids"] == sorted(r["ids"])
            got.setdefault((r["part"], f), []).extend(r["ids"][k] for k in r[f])
    assert {k: sorted(v) for k, v in got.items()} == want


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_merges_as_sets(monkeypatch, block):
    monkeypatch.setattr(audit, "BLOCK", block)
    r = np.random.default_rng(5)
    for _ in range(60):
        lists = [np.unique(r.integers(0, 50, r.integers(0, 30)) + r.choice([0, 40])).astype(np.int32)
                 for _ in range(r.integers(0, 6))]
        assert audit.union(lists).tolist() == sorted(set().union(*[a.tolist() for a in lists]))
        if len(lists) > 1:
            assert audit.held_by(lists[0], lists[1]).tolist() == [x in set(lists[1].tolist()) for x in lists[0].tolist()]
