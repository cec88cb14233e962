"""Small awkward document tables."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()),
                       # names that operators use themselves
                       T.StructField("chunk", T.StringType()), T.StructField("id", T.LongType()),
                       T.StructField("score", T.DoubleType())])


def texts(seed=3, n=120):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéßñ") for _ in range(r.randint(1, 7))) for _ in range(400)]
    passage = [" ".join(r.choice(vocab) for _ in range(60)) for _ in range(5)]
    out = [None, "", " ", "\n\t ", "word", "Word", "two words", "two  WORDS\x0b", "x" * 5000, "é" * 300,
           " ".join(["same"] * 400), "a\x00b c\x1fd\xa0e f"]
    while len(out) < n:
        k = r.random()
        w = [r.choice(vocab) for _ in range(r.choice([3, 20, 80, 200]))]
        if k < .15 and len(out) > 20:
            t = out[r.randrange(12, len(out))]
        elif k < .4 and len(out) > 20:
            t = (out[r.randrange(12, len(out))] or "").split(" ")
            for _ in range(r.randint(1, 4)):
                t[r.randrange(len(t))] = r.choice(vocab)
            t = " ".join(t)
        elif k < .6:
            at = r.randrange(len(w))
            t = " ".join(w[:at] + [r.choice(passage)] + w[at:])
        else:
            t = r.choice([" ", "\n", "  "]).join(w)
        out.append(t)
    out.append(" ".join(r.choice(vocab) for _ in range(60000)) + passage[0])     # very long
    return out


def rows(seed=3, n=120):
    r = random.Random(seed)
    t = texts(seed, n)
    ids = r.sample(range(-50, 5000), len(t))
    return list(zip(ids, t))


def frame(spark, rs):
    return spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rs], SCHEMA)


def result(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())
