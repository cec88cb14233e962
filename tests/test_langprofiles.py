"""Trigram profiles against plain Python, and their edge cases."""

import math
import random
import re
from collections import Counter

import pytest

from pyspark.sql import functions as F

from threadlens.operators import langprofiles as L



def grams(t):
    t = re.sub(r"[^\w]+|[\d_]+", " ", t or "")
    t = re.sub(" +", " ", t)
    return [t[k:k + 3] for k in range(len(t) - 2)]


def plain(train, texts):
    count, prior = {}, Counter(l for l, _ in train)
    for l, t in train:
        count.setdefault(l, Counter()).update(grams(t))
    vocabulary = set().union(*count.values()) if count else set()
    out = []
    for t in texts:
        g = [x for x in grams(t) if x in vocabulary]
        score = {l: math.log(prior[l] / len(train)) - len(g) * math.log(sum(count[l].values()) + len(vocabulary))
                 + sum(math.log(count[l][x] + 1) for x in g) for l in sorted(count)}
        out.append(max(score, key=score.get) if g else None)
    return out


def corpus():
    r = random.Random(4)
    letters = {"aa": "abcde", "bb": "cdefgh", "ру": "абвгде", "漢": "漢字語言文"}
    return [(l, "".join(r.choice(s + ("" if l == "漢" else "  .,7")) for _ in range(r.choice([4, 30, 400]))))
            for l, s in letters.items() for _ in range(12)]


TEXTS = [None, "", "ab", "abc", "c d e f", "漢字語言文漢字", "абв гд", "12345", "zzzzz", "a" * 20_000, "abc абв 漢字語"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "l string, t string").repartition(3).withColumn("g", L.gram_text("t"))


def test_predictions_as_plain(spark):
    train = corpus()
    profiles = L.train_profiles(frame(spark, [*train, (None, "abcabcabc"), ("aa", None)]), "g", "l")
    texts = TEXTS + [t for _, t in train]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").repartition(4)
    got = df.select("k", profiles.column(L.gram_text("t")).alias("p")).orderBy("k").collect()
    assert [r.p for r in got] == plain([*train, ("aa", None)], texts)
    right = sum(r.p == l for r, (l, _) in zip(got[len(TEXTS):], train))
    assert right >= .9 * len(train)


@pytest.mark.parametrize("size", [1, 50])
def test_blocks_and_early_counts_change_nothing(spark, monkeypatch, size):
    rows = frame(spark, corpus())
    want = L.train_profiles(rows, "g", "l")
    expected = want.predict(TEXTS)
    monkeypatch.setattr(L, "HELD", size)
    monkeypatch.setattr(L, "BLOCK", size)
    got = L.train_profiles(rows, "g", "l")
    assert got.predict(TEXTS) == expected
    assert got.labels == want.labels and got.totals == want.totals
    assert (got.keys == want.keys).all() and (got.weights == want.weights).all()


def test_nothing_to_learn(spark):
    profiles = L.train_profiles(frame(spark, [(None, "abc")]), "g", "l")
    assert profiles.labels == [] and profiles.predict(["abc", None]) == [None, None]
    profiles = L.train_profiles(frame(spark, [("x", "ab"), ("y", None)]), "g", "l")
    assert profiles.predict(["abc", None, ""]) == [None] * 3
    assert profiles.predict([]) == []


def test_size_is_checked_before_the_table_is_brought_together(spark):
    with pytest.raises(ValueError, match="bytes"):
        L.train_profiles(frame(spark, corpus()), "g", "l", max_bytes=1000)


def test_no_text_crosses_the_network(spark):
    rows = frame(spark, corpus())
    profiles = L.train_profiles(rows, "g", "l")
    df = spark.range(4).select(F.lit("abc").alias("g"))
    plan = df.select(profiles.column("g"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
