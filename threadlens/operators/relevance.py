"""Relevance of a text to the candidate labels of a topic (BM25, normalised).

A label is described by a few words. How rare these are, and how long texts are,
is counted over all texts in one aggregation (one partial row a task: no token
crosses the network). A label's evidence is the BM25 score of the text for its
words; a label without words stands for "none of the others" and has the
``prior`` as evidence: what another label must reach to win. The scores of a
topic's labels are the softmax of their evidence, so they add up to one.

Words are maximal runs of letters and digits of any script, lower-cased. A NULL
or wordless text has no evidence for any label: the wordless label wins, and
without one all labels are alike. Texts without words do not count in the
statistics. Labels are a parameter; all topics together have at most
``MAX_TERMS`` words, as each is an expression.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K1, B, PRIOR = 1.2, 0.75, 1.0
MAX_TERMS = 1000
WORD_GAP = r"[^\p{L}\p{N}]+"

Topics = Mapping[str, Mapping[str, str]]                     # topic: label: its words


def words(text) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), WORD_GAP), lambda w: w != "")


def label_words(query: str) -> list[str]:
    """The distinct words of a label's description, in order."""
    import re
    return list(dict.fromkeys(re.findall(r"[^\W_]+", query.lower())))


@dataclass
class TermStats:
    """Texts that hold a word, their mean length, and of each asked word the texts that hold it."""
    texts: int
    mean_length: float
    holding: dict[str, int]


def term_stats(df: DataFrame, text: str, topics: Topics) -> TermStats:
    """Counted over all rows of ``df`` in one aggregation."""
    asked = sorted({w for labels in topics.values() for q in labels.values() for w in label_words(q)})
    if len(asked) > MAX_TERMS:
        raise ValueError(f"{len(asked)} words in all labels; at most {MAX_TERMS}")
    held = df.select(words(text).alias("w"))
    row = held.agg(F.count_if(F.size("w") > 0), F.coalesce(F.sum(F.size("w")), F.lit(0)),
                   *[F.count_if(F.array_contains("w", w)) for w in asked]).first()
    return TermStats(row[0], row[1] / row[0] if row[0] else 0.0, dict(zip(asked, row[2:])))


def _times(w: Column, term: str) -> Column:
    return F.size(F.filter(w, lambda x: x == F.lit(term))).cast("double")


def _evidence(w: Column, query: str, stats: TermStats, prior: float) -> Column:
    import math
    terms = label_words(query)
    if not terms:
        return F.lit(float(prior))
    total = F.lit(0.0)
    share = F.lit(1 - B) + F.lit(B) * F.size(w) / F.lit(stats.mean_length or 1.0)
    for t in terms:
        n = stats.holding[t]
        rarity = math.log(1 + (stats.texts - n + 0.5) / (n + 0.5))
        tf = _times(w, t)
        total = total + F.lit(rarity * (K1 + 1)) * tf / (tf + F.lit(K1) * share)
    return total


def relevance(df: DataFrame, text: str, topics: Topics, prior: float = PRIOR,
              stats: TermStats | None = None) -> DataFrame:
    """A row for each row of ``df`` and topic, with ``topic``, ``labels`` and ``scores``
    (parallel arrays). ``stats``: of another, larger table (``term_stats``)."""
    stats = stats or term_stats(df, text, topics)
    w = F.col("_words")
    per_topic = []
    for topic, labels in topics.items():
        evidence = F.array(*[_evidence(w, q, stats, prior) for q in labels.values()])
        per_topic.append(F.struct(F.lit(topic).alias("topic"),
                                  F.array(*[F.lit(x) for x in labels]).alias("labels"),
                                  evidence.alias("evidence")))
    e = F.col("_r.evidence")
    top = F.array_max(e)
    raised = F.transform(e, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return (df.withColumn("_words", words(text)).withColumn("_r", F.explode(F.array(*per_topic)))
            .withColumns({"topic": F.col("_r.topic"), "labels": F.col("_r.labels"),
                          "scores": F.transform(raised, lambda x: x / total)})
            .drop("_words", "_r"))
