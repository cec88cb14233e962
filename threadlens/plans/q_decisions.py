"""Decision-chain queries over linear-on-vector scores from ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions import labels as lb
from threadlens.operators import absa as ab
from threadlens.operators.scoring import ExprScorer, linear_slots
from threadlens.plans import register
from threadlens.schemas import ASPECT_LABELS, ENTITY_LABELS, SENTIMENT_LABELS
from threadlens.sources.fixtures import (
    ASPECT_SENTIMENT, ENTITY_ASPECT, ENTITY_SENTIMENT, SECOND_SENTIMENT_TEXTS, given_sql, v_scores, with_views,
)
from threadlens.sources.tables import table

ASPECT13 = ASPECT_LABELS[:-1]
_SQL_L3 = "[" + ", ".join(f"'{x}'" for x in ENTITY_LABELS) + "]"
_SQL_L13 = "[" + ", ".join(f"'{x}'" for x in ASPECT13) + "]"
_SQL_L14 = "[" + ", ".join(f"'{x}'" for x in ASPECT_LABELS) + "]"
_SQL_SENT_TEXTS = "[" + ", ".join(f"'{x}'" for x in SECOND_SENTIMENT_TEXTS) + "]"
SECOND_ASPECT_MIN = 0.1   # fixture rule for the second-opinion aspect text


def second_aspect_text():
    """Fixture second-opinion aspect text: labels whose e[20+i] > 0.1, joined
    by '; '; upper-cased when vec_id % 3 = 0; an unknown ' foo ' when % 5 = 0."""
    e = F.col("e")
    names = F.array(*[F.lit(x) for x in ASPECT_LABELS])
    parts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(13)),
                                 lambda i: F.when(e[i + 20] > F.lit(SECOND_ASPECT_MIN), names[i])),
                     lambda x: x.isNotNull())
    parts = F.when(F.col("vec_id") % 3 == 0, F.transform(parts, lambda x: F.upper(x))).otherwise(parts)
    parts = F.when(F.col("vec_id") % 5 == 0, F.concat(parts, F.array(F.lit(" foo ")))).otherwise(parts)
    return F.array_join(parts, "; ")


_SQL_SECOND_ASPECT = f"""array_to_string(
  CASE WHEN vec_id % 5 = 0 THEN list_append(a3, ' foo ') ELSE a3 END, '; ')"""
_SQL_SECOND_ASPECT_CTE = f"""SELECT *, {_SQL_SECOND_ASPECT} AS aspect_second_text FROM (
  SELECT *, CASE WHEN vec_id % 3 = 0 THEN list_transform(a2, lambda x: upper(x)) ELSE a2 END AS a3
  FROM (SELECT *, list_filter(list_transform(range(0, 14), lambda i: CASE WHEN e[21 + i] > {SECOND_ASPECT_MIN}
        THEN ({_SQL_L14})[i + 1] END), lambda x: x IS NOT NULL) AS a2 FROM v_scores))"""


def scorers() -> ab.Scorers:
    return ab.Scorers(
        entity=linear_slots("e", "entity_probs", [0, 1, 2], 12.0),
        aspect=linear_slots("e", "aspect_probs", list(range(3, 16)), 12.0, -3.0,
                            given={"entity_id": ENTITY_ASPECT}),
        aspect_second=ExprScorer("aspect_second_text", lambda df: second_aspect_text()),
        sentiment=linear_slots("e", "sentiment_logits", [16, 17, 18], 6.0, link="identity",
                               given={"entity_id": ENTITY_SENTIMENT, "final_aspect_ids": ASPECT_SENTIMENT}),
        sentiment_second=ExprScorer("sentiment_second", lambda df: F.struct(
            F.element_at(F.array(*[F.lit(t) for t in SECOND_SENTIMENT_TEXTS]),
                         (F.col("vec_id") % 4 + 1).cast("int")).alias("text"),
            (F.lit(-6.0) * F.abs(F.col("e")[19])).alias("confidence"))),
    )


def absa_input(spark, sf_dir):
    """Embedding rows with their document text as the sentence."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    d = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("vec_id"), F.col("text").alias("sentence"), "source")
    return e.join(d, "vec_id")


def _r(c):
    return F.round(c, 6)


def _j(c):
    return F.to_json(c)


# ---------------------------------------------------------------- entity

@register("entity_score", with_views("""
SELECT vec_id, to_json(list_transform(entity_probs, lambda p: CAST(p > 0.65 AS INTEGER))) AS entity_ids,
       round(entity_probs[1], 6) AS p_kamala, round(entity_probs[2], 6) AS p_trump,
       round(entity_probs[3], 6) AS p_others
FROM v_scores""", "v_scores"))
def entity_score(spark, sf_dir):
    s = v_scores(spark, sf_dir)
    return s.select("vec_id", _j(lb.threshold_strict("entity_probs")).alias("entity_ids"),
                    _r(F.col("entity_probs")[0]).alias("p_kamala"),
                    _r(F.col("entity_probs")[1]).alias("p_trump"),
                    _r(F.col("entity_probs")[2]).alias("p_others"))


_SQL_IDS = "list_transform(entity_probs, lambda p: CAST(p > 0.65 AS INTEGER))"


@register("entity_expand", with_views(f"""
SELECT vec_id, entity_id, ({_SQL_L3})[entity_id + 1] AS entity_category FROM (
  SELECT vec_id, unnest(list_filter([0, 1, 2], lambda i: ids[i + 1] = 1
                         OR (i = 2 AND list_sum(ids) = 0))) AS entity_id
  FROM (SELECT vec_id, {_SQL_IDS} AS ids FROM v_scores))""", "v_scores"))
def entity_expand(spark, sf_dir):
    s = ab.entity_multihot(v_scores(spark, sf_dir))
    return ab.expand_entities(s).select("vec_id", "entity_id", "entity_category")


@register("entity_expand_named", with_views(f"""
SELECT vec_id, entity_id, ({_SQL_L3})[entity_id + 1] AS entity_category FROM (
  SELECT vec_id, unnest(list_filter([0, 1], lambda i: ids[i + 1] = 1)) AS entity_id
  FROM (SELECT vec_id, {_SQL_IDS} AS ids FROM v_scores))""", "v_scores"))
def entity_expand_named(spark, sf_dir):
    """Named entities only: neither the last slot nor rows without an entity."""
    s = ab.entity_multihot(v_scores(spark, sf_dir))
    return ab.expand_entities(s, all_zero="drop", drop_others=True).select(
        "vec_id", "entity_id", "entity_category")


@register("first_label", with_views(f"""
SELECT vec_id, ({_SQL_L3})[nullif(list_position(ids, 1), 0)] AS first_entity
FROM (SELECT vec_id, {_SQL_IDS} AS ids FROM v_scores)""", "v_scores"))
def first_label(spark, sf_dir):
    s = ab.entity_multihot(v_scores(spark, sf_dir))
    return s.select("vec_id", lb.first_label("entity_ids", ENTITY_LABELS).alias("first_entity"))


# ---------------------------------------------------------------- aspects

_SQL_DL = "list_transform(aspect_probs, lambda p: CAST(p >= 0.35 AS INTEGER))"


def _sql_decode(v, labels_sql, n):
    return (f"CASE WHEN list_sum({v}) = 0 THEN ['others'] ELSE list_filter(list_transform("
            f"range(0, {n}), lambda i: CASE WHEN {v}[i + 1] = 1 THEN ({labels_sql})[i + 1] END), "
            f"lambda x: x IS NOT NULL) END")


@register("aspect_threshold", with_views(f"""
SELECT vec_id, to_json({_SQL_DL}) AS aspect_labels FROM v_scores""", "v_scores"))
def aspect_threshold(spark, sf_dir):
    s = v_scores(spark, sf_dir)
    return s.select("vec_id", _j(lb.threshold_inclusive("aspect_probs")).alias("aspect_labels"))


@register("multihot_decode", with_views(f"""
SELECT vec_id, to_json({_sql_decode('dl', _SQL_L13, 13)}) AS aspect_categories,
       to_json(dl || [CASE WHEN list_sum(dl) = 0 THEN 1 ELSE 0 END]) AS aspect_labels_14
FROM (SELECT vec_id, {_SQL_DL} AS dl FROM v_scores)""", "v_scores"))
def multihot_decode(spark, sf_dir):
    s = ab.aspect_first_opinion(v_scores(spark, sf_dir))
    return s.select("vec_id", _j("distil_aspect_categories").alias("aspect_categories"),
                    _j(lb.extend_others_slot("distil_aspect_labels")).alias("aspect_labels_14"))


_SQL_PARTS = "list_transform(string_split(aspect_second_text, ';'), lambda p: trim(lower(p)))"
_SQL_PARSE = (f"list_transform({_SQL_L14}, lambda lab: CAST(list_contains({_SQL_PARTS}, lab) "
              f"AS INTEGER))")


@register("label_parse", with_views(f"""
SELECT vec_id, aspect_second_text, to_json({_SQL_PARSE}) AS parsed,
       to_json({_sql_decode(_SQL_PARSE, _SQL_L14, 14)}) AS categories,
       CAST(len(list_filter({_SQL_PARTS}, lambda p: NOT list_contains({_SQL_L14}, p))) AS INTEGER)
         AS n_unknown
FROM second""", "v_scores", extra={"second": _SQL_SECOND_ASPECT_CTE}))
def label_parse(spark, sf_dir):
    s = v_scores(spark, sf_dir).withColumn("aspect_second_text", second_aspect_text())
    parsed = lb.parse_label_list("aspect_second_text")
    return s.select("vec_id", "aspect_second_text", _j(parsed).alias("parsed"),
                    _j(lb.multihot_decode(parsed, ASPECT_LABELS)).alias("categories"),
                    lb.unknown_label_count("aspect_second_text").alias("n_unknown"))


_SQL_DL_GIVEN = (f"list_transform(range(1, 14), lambda i: CAST(1.0 / (1.0 + exp(-((12.0 * e[i + 3] - 3.0) + "
                 f"{given_sql([('entity_id', ENTITY_ASPECT)], 'i')}))) >= 0.35 AS INTEGER))")
_SQL_ASPECT_ID = f"(list_position({_SQL_L14}, final_aspect_category) - 1)"
_SQL_GIVEN_SENTIMENT = given_sql([("entity_id", ENTITY_SENTIMENT), (_SQL_ASPECT_ID, ASPECT_SENTIMENT)], "k")


# The whole cascade in SQL (entity expand -> first opinion -> masked second
# opinion -> final labels), shared by the remaining oracles.
_CASCADE = {
    "second": _SQL_SECOND_ASPECT_CTE,
    "ent": f"""SELECT s.*, {_SQL_IDS} AS entity_ids, d.text AS sentence, d.source
        FROM second s JOIN documents d ON d.doc_id = s.vec_id""",
    "ex": f"""SELECT *, ({_SQL_L3})[entity_id + 1] AS entity_category FROM (
        SELECT *, unnest(list_filter([0, 1, 2], lambda i: entity_ids[i + 1] = 1
                  OR (i = 2 AND list_sum(entity_ids) = 0))) AS entity_id FROM ent)""",
    "a1": f"""SELECT *, {_sql_decode('dl', _SQL_L13, 13)} AS distil_categories FROM (
        SELECT *, {_SQL_DL_GIVEN} AS dl FROM ex)""",
    "a2": f"""SELECT *, CASE WHEN distil_categories = ['others'] THEN {_SQL_PARSE} END AS bart_labels
        FROM a1""",
    "a3": f"""SELECT *,
        coalesce(CASE WHEN bart_labels IS NOT NULL THEN {_sql_decode('bart_labels', _SQL_L14, 14)} END,
                 distil_categories) AS final_categories,
        coalesce(bart_labels, dl || [CASE WHEN list_sum(dl) = 0 THEN 1 ELSE 0 END]) AS final_labels,
        bart_labels IS NOT NULL AS used_second FROM a2""",
    "a4": f"""SELECT *, unnest(final_categories) AS final_aspect_category FROM a3""",
    "s1": f"""SELECT *,
        CAST(list_position(lg, list_max(lg)) - 2 AS INTEGER) AS p1,
        list_max(lg) AS c1,
        CAST(coalesce(CASE string_split(second_text, ': ')[2] WHEN 'negative' THEN -1
             WHEN 'neutral' THEN 0 WHEN 'positive' THEN 1 END, 0) AS INTEGER) AS p2,
        second_conf AS c2 FROM (SELECT *, list_transform(range(1, 4),
          lambda k: 6.0 * e[k + 16] + {_SQL_GIVEN_SENTIMENT}) AS lg FROM a4)""",
    "s2": """SELECT *, CASE WHEN coalesce(CASE WHEN isnan(c1) THEN NULL ELSE c1 END >= 0.85, false) THEN p1
                            WHEN coalesce(CASE WHEN isnan(c2) THEN NULL ELSE c2 END >= -0.36, false) THEN p2
                            ELSE p1 END AS final_sentiment_prediction FROM s1""",
}


def _cascade_sql(body):
    return with_views(body, "v_scores", extra=_CASCADE)


def _decided(spark, sf_dir, keep=True):
    return ab.absa(absa_input(spark, sf_dir), scorers(), keep_work_columns=keep)


@register("aspect_cascade", _cascade_sql("""
SELECT vec_id, entity_id, to_json(final_labels) AS final_aspect_labels,
       to_json(final_categories) AS final_aspect_category_list, used_second FROM a3"""))
def aspect_cascade(spark, sf_dir):
    x = ab.entity_multihot(scorers().entity(absa_input(spark, sf_dir)))
    x = ab.expand_entities(x)
    x = ab.aspect_first_opinion(scorers().aspect(x))
    x = ab.aspect_cascade(x, scorers().aspect_second)
    return x.select("vec_id", "entity_id", _j("final_aspect_labels").alias("final_aspect_labels"),
                    _j("final_aspect_categories").alias("final_aspect_category_list"),
                    F.col("bart_aspect_labels").isNotNull().alias("used_second"))


@register("aspect_explode", _cascade_sql("""
SELECT vec_id, entity_id, final_aspect_category FROM a4"""))
def aspect_explode(spark, sf_dir):
    return _decided(spark, sf_dir).select("vec_id", "entity_id", "final_aspect_category")


@register("label_codes", _cascade_sql(f"""
SELECT vec_id, entity_id, final_aspect_category,
       CAST(list_position({_SQL_L14}, final_aspect_category) - 1 AS INTEGER) AS final_aspect_ids,
       (['negative', 'neutral', 'positive'])[final_sentiment_prediction + 2] AS sentiment_name
FROM s2"""))
def label_codes(spark, sf_dir):
    x = _decided(spark, sf_dir)
    return x.select("vec_id", "entity_id", "final_aspect_category", "final_aspect_ids",
                    lb.code_to_sentiment("final_sentiment_prediction", SENTIMENT_LABELS)
                    .alias("sentiment_name"))


@register("prompts", _cascade_sql("""
SELECT vec_id, entity_id, final_aspect_category,
  'entity of interest: ' || replace(entity_category, 'others', 'neither trump nor kamala')
    || ' [SEP] ' || sentence AS sentence2,
  'entity of interest: ' || replace(entity_category, 'others', 'neither trump nor kamala')
    || ' [SEP] aspect of interest: ' || final_aspect_category || ' [SEP] ' || sentence AS sentence3
FROM a4"""))
def prompts(spark, sf_dir):
    return _decided(spark, sf_dir).select("vec_id", "entity_id", "final_aspect_category",
                                           "sentence2", "sentence3")


@register("argmax_sentiment", with_views("""
SELECT vec_id, CAST(list_position(first_logits, list_max(first_logits)) - 2 AS INTEGER) AS prediction,
       round(list_max(first_logits), 6) AS confidence FROM v_scores""", "v_scores"))
def argmax_sentiment(spark, sf_dir):
    s = v_scores(spark, sf_dir)
    return s.select("vec_id", lb.argmax_code("first_logits").alias("prediction"),
                    _r(F.array_max("first_logits")).alias("confidence"))


@register("sentiment_parse", with_views("""
SELECT vec_id, second_text, CAST(coalesce(CASE string_split(second_text, ': ')[2]
  WHEN 'negative' THEN -1 WHEN 'neutral' THEN 0 WHEN 'positive' THEN 1 END, 0) AS INTEGER) AS code
FROM v_scores""", "v_scores"))
def sentiment_parse(spark, sf_dir):
    s = v_scores(spark, sf_dir)
    return s.select("vec_id", "second_text", lb.parse_sentiment("second_text").alias("code"))


@register("arbitration", _cascade_sql("""
SELECT vec_id, entity_id, final_aspect_category, p1 AS distil_sentiment_prediction,
       round(c1, 6) AS distil_sentiment_confidence_score, p2 AS seq2seq_sentiment_prediction,
       round(c2, 6) AS seq2seq_sentiment_confidence_score, final_sentiment_prediction FROM s2"""))
def arbitration(spark, sf_dir):
    x = _decided(spark, sf_dir)
    return x.select("vec_id", "entity_id", "final_aspect_category",
                    "distil_sentiment_prediction",
                    _r("distil_sentiment_confidence_score").alias("distil_sentiment_confidence_score"),
                    "seq2seq_sentiment_prediction",
                    _r("seq2seq_sentiment_confidence_score").alias("seq2seq_sentiment_confidence_score"),
                    "final_sentiment_prediction")


@register("absa_predict", _cascade_sql("""
SELECT vec_id, to_json(entity_ids) AS entity_ids, to_json(final_labels) AS final_aspect_labels,
       entity_category, final_aspect_category AS final_aspect_categories,
       final_sentiment_prediction FROM s2"""))
def absa_predict(spark, sf_dir):
    x = ab.absa(absa_input(spark, sf_dir), scorers())
    return x.select("vec_id", _j("entity_ids").alias("entity_ids"),
                    _j("final_aspect_labels").alias("final_aspect_labels"),
                    "entity_category", "final_aspect_categories", "final_sentiment_prediction")


@register("sentiment_rollup", _cascade_sql("""
SELECT entity_category, final_aspect_category, source AS platform,
       CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE final_sentiment_prediction = 1) AS BIGINT) AS n_positive,
       CAST(count(*) FILTER (WHERE final_sentiment_prediction = 0) AS BIGINT) AS n_neutral,
       CAST(count(*) FILTER (WHERE final_sentiment_prediction = -1) AS BIGINT) AS n_negative,
       CAST(grouping(entity_category, final_aspect_category, source) AS BIGINT) AS grouping_level,
       round(count(*) FILTER (WHERE final_sentiment_prediction = 1) / count(*), 6) AS share_positive,
       round(count(*) FILTER (WHERE final_sentiment_prediction = -1) / count(*), 6) AS share_negative
FROM s2 GROUP BY ROLLUP (entity_category, final_aspect_category, source)"""))
def sentiment_rollup(spark, sf_dir):
    from threadlens.operators.rollups import sentiment_shares
    x = _decided(spark, sf_dir).withColumnRenamed("source", "platform")
    return sentiment_shares(x, ["entity_category", "final_aspect_category", "platform"],
                            subtotals=True)
