"""End to end on real text: comment table -> sentences -> subjectivity gate ->
entity / aspect / sentiment decisions, with native lexicon scorers."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens import jobs
from threadlens.operators import absa as ab
from threadlens.operators.scoring import ExprScorer, lexicon
from threadlens.plans import register
from threadlens.plans.q_models import SUBJECTIVE_BIAS, SUBJECTIVE_TERMS
from threadlens.plans.q_threads import comment_level
from threadlens.schemas import ASPECT_LABELS, ENTITY_LABELS, SENTIMENT_LABELS
from threadlens.sources.fixtures import (
    ASPECT_SENTIMENT, ENTITY_ASPECT, ENTITY_SENTIMENT, GAZETTEER_A, GAZETTEER_B, given_sql,
)

# Lexicons of the default sentence scorers (configuration of
# the non-neural stand-ins; real weights plug in through scoring.external).
ENTITY_LEXICON = {
    "kamala": {t: 4.0 for t in GAZETTEER_A},
    "trump": {t: 4.0 for t in GAZETTEER_B},
    "others": {},
}
ENTITY_BIAS = -2.0
ASPECT_TERMS = ["the ", " and ", "ing ", "tion", " for ", " was ", " with ", " this ",
                " are ", " from ", " that ", " on ", "!"]
ASPECT_BIAS = -1.2
ASPECT_SECOND_TERMS = ["er", "es", "en", "ou", "th", "re", "an", "ed", "ti", "or",
                       "nd", "ha", "on", "xx"]
SENTIMENT_LEXICON = {"negative": {"?": 1.0, " not ": 1.0},
                     "neutral": {".": 0.3},
                     "positive": {"!": 1.2, " good ": 1.0}}


def sentence_scorers() -> ab.Scorers:
    aspect_w = {lab: {term: 1.5} for lab, term in zip(ASPECT_LABELS[:-1], ASPECT_TERMS)}
    names = F.array(*[F.lit(x) for x in ASPECT_LABELS])
    second_terms = F.array(*[F.lit(t) for t in ASPECT_SECOND_TERMS])

    def aspect_second(df):
        low = F.lower(F.col("sentence2"))             # the entity prompt: a term counts from twice on
        twice = lambda t: F.length(low) - F.length(F.replace(low, t, F.lit(""))) >= 4
        hits = F.transform(F.sequence(F.lit(0), F.lit(len(ASPECT_LABELS) - 1)),
                           lambda i: F.when(twice(second_terms[i]), names[i]))
        return F.array_join(F.filter(hits, lambda x: x.isNotNull()), "; ")

    def sentiment_second(df):
        s = F.col("sentence")
        aspect = F.regexp_extract("sentence3", r"\[SEP\] aspect of interest: (.*?) \[SEP\] ", 1)
        cue = F.lower(s).contains(F.substring(aspect, 1, 3))   # the sentence speaks of the aspect
        label = (F.when(s.contains("!"), "positive").when(s.contains("?"), "negative")
                 .when(cue, "positive").otherwise("neutral"))
        conf = F.when(s.contains("!") | s.contains("?") | cue, F.lit(-0.2)).otherwise(F.lit(-0.5))
        return F.struct(F.concat(F.lit("sentiment: "), label).alias("text"),
                        conf.alias("confidence"))

    return ab.Scorers(
        entity=lexicon("sentence", "entity_probs", ENTITY_LEXICON, ENTITY_LABELS, ENTITY_BIAS),
        aspect=lexicon("sentence", "aspect_probs", aspect_w, ASPECT_LABELS[:-1], ASPECT_BIAS,
                       given={"entity_id": ENTITY_ASPECT}),
        aspect_second=ExprScorer("aspect_second_text", aspect_second),
        sentiment=lexicon("sentence", "sentiment_logits", SENTIMENT_LEXICON, SENTIMENT_LABELS,
                          link="identity",
                          given={"entity_id": ENTITY_SENTIMENT, "final_aspect_ids": ASPECT_SENTIMENT}),
        sentiment_second=ExprScorer("sentiment_second", sentiment_second),
    )


def sentence_opinions(spark, sf_dir):
    """Reference flow end to end: comments (unify, clean, levels, context,
    flags) -> sentences of the comment -> subjective sentences only ->
    entity -> aspect -> sentiment."""
    comments = comment_level(spark, sf_dir)
    scorer = lexicon("sentence", "subj_scores", {"subjective": SUBJECTIVE_TERMS}, ["subjective"],
                     bias=SUBJECTIVE_BIAS)
    subj = jobs.sentence_level(comments, scorer, "subjective_first")
    cols = ["comment_id", "post_id", "platform", "level", "comment_timestamp", "sentence_idx",
            "sentence", "previous_sentence"]
    return ab.absa(subj.select(*cols), sentence_scorers())


@register("sentence_opinions")
def sentence_opinions_q(spark, sf_dir):
    out = sentence_opinions(spark, sf_dir)
    return out.select("comment_id", "sentence_idx", "sentence", "entity_category",
                      "final_aspect_categories", "final_sentiment_prediction", "platform",
                      F.to_json("entity_ids").alias("entity_ids"),
                      F.to_json("final_aspect_labels").alias("final_aspect_labels"))


@register("opinion_daily")
def opinion_daily(spark, sf_dir):
    """Sentiment share by entity x aspect x day x platform with ROLLUP
    subtotals, over the end-to-end sentence opinions (an addition: the
    consumer of the decision table)."""
    from threadlens.operators.rollups import sentiment_shares
    x = sentence_opinions(spark, sf_dir).withColumn(
        "day", F.to_date(F.col("comment_timestamp")))
    return sentiment_shares(x, ["entity_category", "final_aspect_categories", "day", "platform"],
                            subtotals=True)


# ---------------------------------------------------------------------------
# The same decision chain on all documents' sentences, with an oracle.
# ---------------------------------------------------------------------------

def _sq(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _lexicon_sql(text: str, weights, labels, bias: float, link: str = "sigmoid", given=()) -> str:
    items = []
    for k, lab in enumerate(labels, 1):
        z = " + ".join([f"({bias})"] + [
            f"CASE WHEN contains(lower({text}), {_sq(t.lower())}) THEN {w} ELSE 0.0 END"
            for t, w in weights.get(lab, {}).items()])
        if given:
            z = f"({z}) + {given_sql(given, str(k))}"
        items.append(f"1.0 / (1.0 + exp(-({z})))" if link == "sigmoid" else f"({z})")
    return "[" + ", ".join(items) + "]"


def _decode_sql(v: str, labels, n: int) -> str:
    names = "[" + ", ".join(_sq(x) for x in labels) + "]"
    return (f"CASE WHEN list_sum({v}) = 0 THEN ['others'] ELSE list_filter(list_transform("
            f"range(0, {n}), lambda i: CASE WHEN {v}[i + 1] = 1 THEN ({names})[i + 1] END), "
            f"lambda x: x IS NOT NULL) END")


def _sentence_decisions_sql() -> str:
    from threadlens.plans.q_models import _subj_sql
    aspect_w = {lab: {term: 1.5} for lab, term in zip(ASPECT_LABELS[:-1], ASPECT_TERMS)}
    l3 = "[" + ", ".join(_sq(x) for x in ENTITY_LABELS) + "]"
    l14 = "[" + ", ".join(_sq(x) for x in ASPECT_LABELS) + "]"
    sec_terms = "[" + ", ".join(_sq(x) for x in ASPECT_SECOND_TERMS) + "]"
    parts = f"list_transform(string_split(second_text, ';'), lambda p: trim(lower(p)))"
    parse = f"list_transform({l14}, lambda lab: CAST(list_contains({parts}, lab) AS INTEGER))"
    prompt = ("('entity of interest: ' || replace(entity_category, 'others', 'neither trump nor kamala') "
              "|| ' [SEP] ' || sentence)")
    cue = "contains(lower(sentence), substr(final_aspect_category, 1, 3))"
    aspect_id = f"(list_position({l14}, final_aspect_category) - 1)"
    return f"""
WITH s AS ({_subj_sql()}),
sc AS (SELECT *, {_lexicon_sql('sentence', ENTITY_LEXICON, ENTITY_LABELS, ENTITY_BIAS)} AS ep FROM s),
ent AS (SELECT *, list_transform(ep, lambda p: CAST(p > 0.65 AS INTEGER)) AS entity_ids FROM sc),
ex AS (SELECT *, ({l3})[entity_id + 1] AS entity_category FROM (
       SELECT *, unnest(list_filter([0, 1, 2], lambda i: entity_ids[i + 1] = 1
                 OR (i = 2 AND list_sum(entity_ids) = 0))) AS entity_id FROM ent)),
a1 AS (SELECT *, {_decode_sql('dl', ASPECT_LABELS[:-1], 13)} AS distil_categories FROM (
       SELECT *, list_transform({_lexicon_sql('sentence', aspect_w, ASPECT_LABELS[:-1], ASPECT_BIAS,
           given=[('entity_id', ENTITY_ASPECT)])}, lambda p: CAST(p >= 0.35 AS INTEGER)) AS dl FROM ex)),
a2 AS (SELECT *, CASE WHEN distil_categories = ['others'] THEN array_to_string(list_filter(
         list_transform(range(0, 14), lambda i: CASE WHEN length(lower({prompt})) - length(replace(lower({prompt}), ({sec_terms})[i + 1], '')) >= 4
           THEN ({l14})[i + 1] END), lambda x: x IS NOT NULL), '; ') END AS second_text FROM a1),
a3 AS (SELECT *, CASE WHEN second_text IS NOT NULL THEN {parse} END AS bart_labels FROM a2),
a4 AS (SELECT *, coalesce(CASE WHEN bart_labels IS NOT NULL THEN {_decode_sql('bart_labels', ASPECT_LABELS, 14)} END,
                          distil_categories) AS final_categories,
              coalesce(bart_labels, dl || [CASE WHEN list_sum(dl) = 0 THEN 1 ELSE 0 END]) AS final_labels
       FROM a3),
a5 AS (SELECT *, unnest(final_categories) AS final_aspect_category FROM a4),
s1 AS (SELECT *, CAST(list_position(lg, list_max(lg)) - 2 AS INTEGER) AS p1, list_max(lg) AS c1,
              CASE WHEN contains(sentence, '!') THEN 1 WHEN contains(sentence, '?') THEN -1 WHEN {cue} THEN 1 ELSE 0 END AS p2,
              CASE WHEN contains(sentence, '!') OR contains(sentence, '?') OR {cue} THEN -0.2 ELSE -0.5 END AS c2
       FROM (SELECT *, {_lexicon_sql('sentence', SENTIMENT_LEXICON, SENTIMENT_LABELS, 0.0, 'identity',
                given=[('entity_id', ENTITY_SENTIMENT), (aspect_id, ASPECT_SENTIMENT)])} AS lg FROM a5))
SELECT doc_id, sentence_idx, entity_category, final_aspect_category AS final_aspect_categories,
       CASE WHEN coalesce(CASE WHEN isnan(c1) THEN NULL ELSE c1 END >= 0.85, false) THEN p1
            WHEN coalesce(CASE WHEN isnan(c2) THEN NULL ELSE c2 END >= -0.36, false) THEN p2
            ELSE p1 END AS final_sentiment_prediction,
       to_json(entity_ids) AS entity_ids, to_json(final_labels) AS final_aspect_labels
FROM s1"""


def sentence_decisions(spark, sf_dir):
    """Documents -> sentences -> subjectivity gate -> decisions
    (the chain of ``sentence_opinions`` without the HTML step, oracle-checked)."""
    from threadlens.sources.fixtures import v_sentence_docs
    scorer = lexicon("sentence", "subj_scores", {"subjective": SUBJECTIVE_TERMS}, ["subjective"],
                     bias=SUBJECTIVE_BIAS)
    subj = jobs.sentence_level(v_sentence_docs(spark, sf_dir), scorer, "subjective_first")
    out = ab.absa(subj.select("doc_id", "sentence_idx", "sentence"), sentence_scorers())
    return out.select("doc_id", "sentence_idx", "entity_category", "final_aspect_categories",
                      "final_sentiment_prediction", F.to_json("entity_ids").alias("entity_ids"),
                      F.to_json("final_aspect_labels").alias("final_aspect_labels"))


register("sentence_decisions", _sentence_decisions_sql())(sentence_decisions)
