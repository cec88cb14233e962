"""BM25 label relevance against plain Python, its edge cases and its plan."""

import math
import re

import pytest

from pyspark.sql import functions as F

from threadlens.operators import relevance as R
from threadlens.operators.topk import relevance_top_k

TOPICS = {"one": {"cats": "cat Kitten cat", "dogs": "dog", "neither": ""},
          "two": {"naïve Ärzte": "ärzte ÄRZTE naïve", "7 cats": "7"}}
TEXTS = ["A cat, a kitten; the CAT!", "dog-dog dog", None, "", "...", "nothing of it", "Ärzte naïve 7", "cat dog",
         "cat " * 50 + "dog", "a cat", "a cat", "x" * 5000, "kitten_cat", "\tcat\n7"]


def plain(texts, topics, prior=R.PRIOR):
    docs = [re.findall(r"[^\W_]+", (t or "").lower()) for t in texts]
    some = [d for d in docs if d]
    n, mean = len(some), sum(map(len, some)) / max(1, len(some))
    out = []
    for d in docs:
        for topic, labels in topics.items():
            ev = []
            for q in labels.values():
                terms = set(re.findall(r"[^\W_]+", q.lower()))
                e = 0.0 if terms else prior
                for t in terms:
                    df = sum(t in x for x in docs)
                    tf = d.count(t)
                    e += math.log(1 + (n - df + .5) / (df + .5)) * tf * 2.2 / (tf + 1.2 * (.25 + .75 * len(d) / mean))
                ev.append(e)
            total = sum(map(math.exp, ev))
            out.append((topic, [math.exp(e) / total for e in ev]))
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)


def test_scores_as_plain(spark):
    got = R.relevance(frame(spark, TEXTS), "t", TOPICS).collect()
    got = sorted(got, key=lambda r: (r.id, list(TOPICS).index(r.topic)))
    assert [r.topic for r in got] == [t for t, _ in plain(TEXTS, TOPICS)]
    for r, (topic, want) in zip(got, plain(TEXTS, TOPICS)):
        assert r.labels == list(TOPICS[topic])
        assert r.scores == pytest.approx(want, abs=1e-12) and sum(r.scores) == pytest.approx(1)
    by = {(r.id, r.topic): r.scores for r in got}
    assert by[0, "one"][0] > .5 and by[1, "one"][1] > .5
    for wordless in (2, 3, 4, 5):                            # no evidence: the wordless label, or all alike
        assert max(by[wordless, "one"]) == by[wordless, "one"][2] > .5
        assert by[wordless, "two"] == [.5, .5]


def test_empty_table_and_other_statistics(spark):
    empty = frame(spark, [None]).where("false")
    assert R.relevance(empty, "t", TOPICS).collect() == []
    stats = R.term_stats(frame(spark, TEXTS), "t", TOPICS)
    got = R.relevance(frame(spark, ["a cat"]), "t", TOPICS, stats=stats).collect()
    assert {r.topic: r.scores for r in got}["one"] == pytest.approx(dict(plain(TEXTS, TOPICS)[18:20])["one"])


def test_too_many_words(spark):
    with pytest.raises(ValueError):
        R.term_stats(frame(spark, ["a"]), "t", {"x": {"y": " ".join(f"w{k}" for k in range(R.MAX_TERMS + 1))}})


def test_gate_takes_the_topics_label(spark):
    df = frame(spark, TEXTS).withColumn("votes", F.lit(1))
    r = R.relevance(df, "t", TOPICS)
    got = relevance_top_k(r, "topic", "votes", "id", F.element_at("labels", 1), k=2, candidates=9)
    scored = [(i // 2, t, s[0]) for i, (t, s) in enumerate(plain(TEXTS, TOPICS))]
    want = {t: [i for i, u, s in scored if u == t and i < 9 and s >= .5][:2] for t in TOPICS}
    assert {t: [x.id for x in got.where(F.col("topic") == t).orderBy("rank").collect()] for t in TOPICS} == want


def test_no_token_crosses_the_network(spark):
    stats = R.term_stats(frame(spark, TEXTS), "t", TOPICS)
    df = spark.range(10).select(F.lit("a cat").alias("t"))
    plan = R.relevance(df, "t", TOPICS, stats=stats)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
