"""Entity -> aspect -> sentiment decision chain around pluggable scorers.

Everything here is native Column logic: thresholds, multi-hot decoding,
one-to-many expansion, the second-opinion cascade, label parsing and
arbitration. Scorers only add score columns (see ``scoring``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions import labels as lb
from threadlens.schemas import (
    ASPECT_LABELS, ASPECT_THRESHOLD, ENTITY_LABELS, ENTITY_THRESHOLD,
    FIRST_OPINION_MIN, SECOND_OPINION_MIN, SENTIMENT_LABELS,
)


def entity_multihot(df: DataFrame, probs_col: str = "entity_probs",
                    threshold: float = ENTITY_THRESHOLD) -> DataFrame:
    return df.withColumn("entity_ids", lb.threshold_strict(probs_col, threshold))


def expand_entities(df: DataFrame, ids_col: str = "entity_ids",
                    labels: Sequence[str] = ENTITY_LABELS, all_zero: str = "others",
                    drop_others: bool = False) -> DataFrame:
    """One row per positive entity, in slot order.

    ``all_zero='others'``: a row with no positive entity yields one row for
    the last slot (the packaged behaviour); ``'drop'``: it yields none.
    ``drop_others`` removes the last slot's rows entirely (notebook variant).
    """
    n = len(labels)
    ids = F.col(ids_col)
    last = n - 1

    def keep(i):
        hit = ids[i] == 1
        if all_zero == "others":
            hit = hit | ((i == last) & (lb.multihot_sum(ids) == 0))
        if drop_others:
            hit = hit & (i != last)
        return hit
    slots = F.filter(F.sequence(F.lit(0), F.lit(last)), keep)
    names = F.array(*[F.lit(x) for x in labels])
    out = df.withColumn("entity_id", F.explode(slots))
    return out.withColumn("entity_category", names[F.col("entity_id")])


def aspect_first_opinion(df: DataFrame, probs_col: str = "aspect_probs",
                         labels: Sequence[str] = ASPECT_LABELS,
                         threshold: float = ASPECT_THRESHOLD) -> DataFrame:
    first = list(labels[:-1])
    return (df.withColumn("distil_aspect_labels", lb.threshold_inclusive(probs_col, threshold))
              .withColumn("distil_aspect_categories",
                          lb.multihot_decode("distil_aspect_labels", first, all_zero=labels[-1])))


def needs_second_opinion(labels: Sequence[str] = ASPECT_LABELS):
    return F.col("distil_aspect_categories") == F.array(F.lit(labels[-1]))


def aspect_cascade(df: DataFrame, second_scorer, sentence_col: str = "sentence",
                   labels: Sequence[str] = ASPECT_LABELS,
                   text_col: str = "aspect_second_text") -> DataFrame:
    """Second opinion only for rows whose first opinion is 'others' only.

    The second scorer adds ``text_col`` ('a; b; c'); parsed to a full
    multi-hot (unknown labels ignored). Final labels/categories prefer the
    second opinion and fall back to the first (extended by the 'others' slot).
    """
    df = df.withColumn("sentence2", lb.entity_prompt("entity_category", sentence_col))
    df = second_scorer.score_where(df, needs_second_opinion(labels))
    bart = lb.parse_label_list(text_col, labels)
    df = df.withColumn("bart_aspect_labels", bart)
    df = df.withColumn("bart_aspect_categories",
                       F.when(F.col("bart_aspect_labels").isNotNull(),
                              lb.multihot_decode("bart_aspect_labels", labels,
                                                 all_zero=labels[-1])))
    return (df.withColumn("final_aspect_categories",
                          F.coalesce("bart_aspect_categories", "distil_aspect_categories"))
              .withColumn("final_aspect_labels",
                          F.coalesce("bart_aspect_labels",
                                     lb.extend_others_slot("distil_aspect_labels"))))


def explode_aspects(df: DataFrame, labels: Sequence[str] = ASPECT_LABELS) -> DataFrame:
    """One row per final aspect (explode_outer: an empty list keeps a NULL row)."""
    out = df.withColumn("final_aspect_category", F.explode_outer("final_aspect_categories"))
    return out.withColumn("final_aspect_ids", lb.label_index("final_aspect_category", labels))


def sentiment_first_opinion(df: DataFrame, logits_col: str = "sentiment_logits") -> DataFrame:
    return (df.withColumn("distil_sentiment_prediction", lb.argmax_code(logits_col))
              .withColumn("distil_sentiment_confidence_score", F.array_max(logits_col)))


def sentiment_second_opinion(df: DataFrame, text_col: str = "sentiment_second.text",
                             conf_col: str = "sentiment_second.confidence",
                             labels: Sequence[str] = SENTIMENT_LABELS) -> DataFrame:
    return (df.withColumn("seq2seq_sentiment_prediction", lb.parse_sentiment(text_col, labels))
              .withColumn("seq2seq_sentiment_confidence_score", F.col(conf_col)))


def arbitrate_sentiment(df: DataFrame, first_min: float = FIRST_OPINION_MIN,
                        second_min: float = SECOND_OPINION_MIN) -> DataFrame:
    return df.withColumn("final_sentiment_prediction", lb.arbitrate(
        "distil_sentiment_prediction", "distil_sentiment_confidence_score",
        "seq2seq_sentiment_prediction", "seq2seq_sentiment_confidence_score",
        first_min, second_min))


@dataclass
class Scorers:
    entity: object                 # -> entity_probs array<double>
    aspect: object                 # -> aspect_probs array<double> (sees entity_id)
    aspect_second: object          # -> aspect_second_text string
    sentiment: object              # -> sentiment_logits array<double>
    sentiment_second: object       # -> sentiment_second struct<text, confidence>
    extra: dict = field(default_factory=dict)


OUTPUT_COLUMNS = ["entity_ids", "final_aspect_labels", "entity_category",
                  "final_aspect_categories", "final_sentiment_prediction"]


def absa(df: DataFrame, scorers: Scorers, sentence_col: str = "sentence",
         entity_labels: Sequence[str] = ENTITY_LABELS,
         aspect_labels: Sequence[str] = ASPECT_LABELS,
         sentiment_labels: Sequence[str] = SENTIMENT_LABELS,
         entity_threshold: float = ENTITY_THRESHOLD,
         aspect_threshold: float = ASPECT_THRESHOLD,
         first_min: float = FIRST_OPINION_MIN, second_min: float = SECOND_OPINION_MIN,
         all_zero_entity: str = "others", drop_others: bool = False,
         keep_work_columns: bool = False) -> DataFrame:
    """Input columns + entity_ids, final_aspect_labels, entity_category,
    final_aspect_categories (one aspect per row), final_sentiment_prediction."""
    original = list(df.columns)
    x = entity_multihot(scorers.entity(df), "entity_probs", entity_threshold)
    x = expand_entities(x, "entity_ids", entity_labels, all_zero_entity, drop_others)
    x = aspect_first_opinion(scorers.aspect(x), "aspect_probs", aspect_labels, aspect_threshold)
    x = aspect_cascade(x, scorers.aspect_second, sentence_col, aspect_labels)
    x = explode_aspects(x, aspect_labels)
    x = x.withColumn("sentence3", lb.entity_aspect_prompt(
        "entity_category", "final_aspect_category", sentence_col))
    x = sentiment_first_opinion(scorers.sentiment(x))
    x = sentiment_second_opinion(scorers.sentiment_second(x), labels=sentiment_labels)
    x = arbitrate_sentiment(x, first_min, second_min)
    x = x.withColumn("final_aspect_categories", F.col("final_aspect_category"))
    if keep_work_columns:
        return x
    return x.select(*original, *OUTPUT_COLUMNS)


def observe_unknown_labels(df: DataFrame, text_col: str = "aspect_second_text",
                           labels: Sequence[str] = ASPECT_LABELS, name: str = "unknown_labels"):
    """Count second-opinion labels outside the catalog (reported, then ignored)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    n = F.sum(F.coalesce(lb.unknown_label_count(text_col, labels), F.lit(0)))
    return df.observe(obs, n.alias("n_unknown")), obs
