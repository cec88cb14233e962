"""Learned abbreviations: counts and scores by plain Python, and the split that uses them."""

import collections
import math
import random
import re

import pytest

from threadlens.operators import abbreviations as ab
from threadlens.operators.sentences import split_sentences

WORDS = "we met the other people of this town when rain came over fields and hills near river".split()
ABBR = ["dr", "e.g", "vs", "etc", "z.b"]


def corpus(seed=5, n=300):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        text = []
        for _ in range(r.randint(1, 6)):
            s = [r.choice(WORDS) for _ in range(r.randint(3, 9))]
            if r.random() < .6:
                s.insert(r.randrange(1, len(s)), r.choice(ABBR).capitalize() + ".")
            text.append(" ".join(s).capitalize() + r.choice([".", "!", "?", '."']))
        out.append(r.choice([" ", " ", "  "]).join(text))
    return out


def brute_counts(texts):
    n = collections.defaultdict(lambda: [0, 0])
    for t in texts:
        for raw in (t or "").split():
            w = raw.lower() if len(raw) <= 40 else ""
            while w and not w[0].isalnum():
                w = w[1:]
            while w and not (w[-1].isalnum() or w[-1] == "."):
                w = w[:-1]
            final = len(w) > 1 and w[-1] == "." and w[-2] != "."
            kind = w.rstrip(".")
            if not any(c.isalpha() for c in kind) or any(c.isnumeric() for c in kind):
                kind = ""
            n[kind][0 if final else 1] += 1
    return n


def brute_learned(texts, min_count=5):
    n = brute_counts(texts)
    words, finals = sum(a + b for a, b in n.values()), sum(a for a, _ in n.values())
    p, out = finals / words, {}
    for w, (a, b) in n.items():
        if not w or a < min_count:
            continue
        null = a * math.log(p) + b * math.log(1 - p)
        alt = a * math.log(.99) + b * math.log(.01)
        dots = w.count(".")
        s = -2 * (null - alt) * (dots + 1) * math.exp(-(len(w) - dots)) * (len(w) - dots) ** -b
        if s >= .3:
            out[w] = (a, b, round(s, 6))
    return out


def brute_sentences(text, types):
    """Character by character: a mark, closing signs, then whitespace ends a sentence."""
    text, out, start, i = text.strip(), [], 0, 0
    while i < len(text):
        j = i
        while j < len(text) and text[j] in ".!?":
            j += 1
        if j == i:
            i += 1
            continue
        while j < len(text) and text[j] in "\"')]":
            j += 1
        if j < len(text) and text[j].isspace():
            last = text[start:j].split()[-1].lower()
            last = re.sub(r"^[^\w]+|^_+", "", last)
            if not (last.endswith(".") and last[:-1] in types):
                out.append(text[start:j])
                while text[j].isspace():
                    j += 1
                start = j
        i = j
    return [s for s in [*out, text[start:]] if s]


def test_learned_types_as_brute_force(spark):
    texts = [*corpus(), None, "", "   ", "x" * 50 + ". y", "3.14 12. (etc.) “Dr.” ... vs.. No."]
    df = spark.createDataFrame([(t, 1) for t in texts], "comment string, n_with int").repartition(3)
    got = {r.type: (r.n_with, r.n_without, round(r.score, 6)) for r in ab.learn_abbreviations(df).collect()}
    assert got == brute_learned(texts)
    assert set(got) >= {"dr", "e.g", "vs", "z.b"} and not set(got) & set(WORDS)
    counts = {r.type: [r.n_with, r.n_without] for r in ab.type_counts(df, "comment").collect()}
    assert counts == dict(brute_counts(texts))


def test_split_with_learned_types_as_brute_force(spark):
    texts = [*corpus(9, 120), "", "Only one", "Seen by Dr. Who", "(Dr. No) came. (etc.) Then?! \"Yes.\" End.", "vs. vs. A. B."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "id int, comment string")
    types = ab.collect_types(ab.learn_abbreviations(df))
    assert {"dr", "e.g"} <= set(types)
    got = collections.defaultdict(list)
    for r in split_sentences(df, abbreviations=types).orderBy("id", "sentence_idx").collect():
        assert r.previous_sentence == (got[r.id][-1] if got[r.id] else None)
        got[r.id].append(r.sentence)
    assert {i: got.get(i, []) for i in range(len(texts))} == {i: brute_sentences(t, types) for i, t in enumerate(texts)}
    assert len(texts) not in got
    plan = split_sentences(df, abbreviations=types)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_no_words_no_types(spark, monkeypatch):
    empty = spark.createDataFrame([], "comment string")
    assert ab.learn_abbreviations(empty).collect() == []
    assert ab.learn_abbreviations(spark.createDataFrame([(None,), ("",)], "comment string")).collect() == []
    df = spark.createDataFrame([("a. b. c.",)] * 9, "comment string")      # every word ends in a period
    assert all(math.isfinite(r.score) for r in ab.learn_abbreviations(df).collect())
    assert split_sentences(spark.createDataFrame([("One. Two.",)], "comment string"), abbreviations=[]).count() == 2
    monkeypatch.setattr(ab, "MAX_TYPES", 1)
    with pytest.raises(ValueError):
        ab.collect_types(spark.createDataFrame([("a",), ("b",)], "type string"))
