"""Language identification as Spark jobs: multinomial naive Bayes on words.

Training is one aggregation, token counts per (label, token), combined
map-side; the vocabulary is every token seen. Scoring joins the tokens of
each document to the model by token: the ``HOT_TOKENS`` most frequent ones (a
bounded table) meet their weights in a broadcast and are summed per document
where they are read; only the others are shuffled, once by token to their
weights and once by document.

score(doc, l) = ln prior_l - n_V(doc) * ln(T_l + |V|) + sum_t cnt * ln(c_l(t) + 1)
(add-one smoothing; tokens outside the vocabulary V are ignored).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.session import staged

MAX_LABELS = 256
HOT_TOKENS = 20_000


def word_tokens(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(col), "[^\\p{L}]+"), lambda t: t != F.lit(""))


@dataclass
class WordNB:
    labels: list[str]
    consts: list[tuple[float, float]]   # (ln prior, ln(T_l + |V|)) per label
    weights: DataFrame                  # token, w_<i> = ln(c_i(token) + 1)
    hot: DataFrame                      # the rows of ``weights`` of the most frequent tokens


def train_word_nb(docs: DataFrame, text_col: str, label_col: str) -> WordNB:
    labelled = docs.where(F.col(label_col).isNotNull())
    priors = (labelled.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
              .limit(MAX_LABELS + 1).collect())
    if len(priors) > MAX_LABELS:
        raise ValueError(f"{len(priors)} labels (> {MAX_LABELS})")
    labels = sorted(r[0] for r in priors)
    n_docs = sum(r["n"] for r in priors)
    prior = {r[0]: r["n"] / n_docs for r in priors}
    toks = labelled.select(F.col(label_col).alias("label"),
                           F.explode(word_tokens(text_col)).alias("token"))
    # Sufficient statistics: sized by vocabulary x labels, not by the corpus.
    counts = staged(toks.groupBy("label", "token").agg(F.count(F.lit(1)).alias("c")), "token-counts")
    wide = (counts.groupBy("token").pivot("label", labels).agg(F.first("c")))
    wide = staged(wide.select("token", *[
        F.coalesce(F.col(f"`{lab}`"), F.lit(0)).cast("long").alias(f"c_{i}")
        for i, lab in enumerate(labels)]), "vocabulary")
    # per-label totals and |V| from the small model table (one pass)
    agg = wide.agg(F.count(F.lit(1)).alias("v"),
                   *[F.sum(f"c_{i}").alias(f"t_{i}") for i in range(len(labels))]).first()
    v = agg["v"]
    consts = [(math.log(prior[lab]), math.log((agg[f"t_{i}"] or 0) + v))
              for i, lab in enumerate(labels)]
    weights = wide.select("token", *[F.log(F.col(f"c_{i}").cast("double") + 1.0).alias(f"w_{i}")
                                     for i in range(len(labels))])
    total = sum((F.col(f"c_{i}") for i in range(len(labels))), F.lit(0))
    top = wide.orderBy(total.desc(), "token").select("token").limit(HOT_TOKENS)
    hot = staged(weights.join(F.broadcast(top), "token", "left_semi"), "hot-tokens")
    return WordNB(labels, consts, weights, hot)


def predict_word_nb(model: WordNB, docs: DataFrame, text_col: str, key: str,
                    out_col: str = "lang_pred") -> DataFrame:
    """Adds ``out_col`` (argmax label; NULL when no vocabulary token)."""
    n = len(model.labels)
    toks = docs.select(key, F.explode(word_tokens(text_col)).alias("token"))
    hot = F.broadcast(model.hot)
    seldom = toks.join(F.broadcast(model.hot.select("token")), "token", "left_anti")

    def summed(hit, c, w):
        return hit.groupBy(key).agg(c.alias("_nv"), *[F.sum(w.format(i)).alias(f"_s{i}") for i in range(n)])

    parts = [summed(toks.join(hot, "token"), F.count(F.lit(1)), "w_{}"),
             summed(seldom.join(model.weights, "token"), F.count(F.lit(1)), "w_{}")]
    agg = summed(parts[0].unionByName(parts[1]), F.sum("_nv"), "_s{}")
    scores = [F.lit(lp) - F.col("_nv") * F.lit(lt) + F.col(f"_s{i}")
              for i, (lp, lt) in enumerate(model.consts)]
    arr = F.array(*scores)
    best = F.array_position(arr, F.array_max(arr))
    names = F.array(*[F.lit(x) for x in model.labels])
    agg = agg.select(key, F.try_element_at(names, best.cast("int")).alias(out_col))
    return docs.join(agg, key, "left")
