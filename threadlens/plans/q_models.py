"""Model-stage queries: language ID trained as a Spark job; subjectivity gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions.labels import subjective_flag
from threadlens.functions.text import lang_text
from threadlens.operators.langid import predict_word_nb, train_word_nb
from threadlens.operators.langprofiles import gram_text, train_profiles
from threadlens.operators.scoring import lexicon
from threadlens.operators.sentences import split_sentences
from threadlens.plans import register
from threadlens.plans.q_text import SENTENCES_SQL
from threadlens.schemas import SUBJECTIVE_MIN
from threadlens.sources.fixtures import v_sentence_docs
from threadlens.sources.tables import table

# Training rows: split by a property of the text (never doc_id), so exact
# copies of a text land on the same side.
def _is_train(text_col="text"):
    return F.length(F.col(text_col)) % 2 == 0


_NB_SQL = f"""
WITH tr AS (SELECT lang, text FROM documents WHERE length(text) % 2 = 0 AND lang IS NOT NULL),
pri AS (SELECT lang, ln(count(*) / (SELECT count(*) FROM tr)) AS lp FROM tr GROUP BY lang),
tk AS (SELECT lang, unnest(list_filter(regexp_split_to_array(lower(replace(text, chr(10), '')), '[^\\p{{L}}]+'),
                                       lambda t: t <> '')) AS token FROM tr),
cnt AS (SELECT lang, token, count(*) AS c FROM tk GROUP BY lang, token),
voc AS (SELECT DISTINCT token FROM cnt),
civ AS (SELECT * FROM cnt WHERE token IN (SELECT token FROM voc)),
tot AS (SELECT lang, sum(c) AS t FROM civ GROUP BY lang),
cons AS (SELECT p.lang, p.lp, ln(coalesce(t.t, 0) + (SELECT count(*) FROM voc)) AS lt
         FROM pri p LEFT JOIN tot t ON p.lang = t.lang),
dt AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(replace(text, chr(10), '')), '[^\\p{{L}}]+'),
                                         lambda t: t <> '')) AS token FROM documents),
dv AS (SELECT * FROM dt WHERE token IN (SELECT token FROM voc)),
nv AS (SELECT doc_id, count(*) AS nv FROM dv GROUP BY doc_id),
sp AS (SELECT dv.doc_id, civ.lang, sum(ln(civ.c + 1)) AS s FROM dv JOIN civ ON dv.token = civ.token
       GROUP BY dv.doc_id, civ.lang),
sc AS (SELECT nv.doc_id, cons.lang, cons.lp - nv.nv * cons.lt + coalesce(sp.s, 0) AS score
       FROM nv CROSS JOIN cons LEFT JOIN sp ON sp.doc_id = nv.doc_id AND sp.lang = cons.lang),
best AS (SELECT doc_id, min(lang) AS lang_pred FROM (
         SELECT doc_id, lang, score, max(score) OVER (PARTITION BY doc_id) AS m FROM sc)
         WHERE score = m GROUP BY doc_id)
"""
# (ties go to the alphabetically first label, as in Spark's sorted label array)


def _label_sql(label: str) -> str:
    """Held-out accuracy of the same model on a column of ``labels``, beside the majority class."""
    src = (f"WITH documents_l AS (SELECT d.doc_id, d.text, CAST(l.{label} AS VARCHAR) AS lang FROM documents d "
           f"JOIN (SELECT doc_id, max({label}) AS {label} FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id),")
    nb = _NB_SQL.replace("FROM documents", "FROM documents_l").strip().removeprefix("WITH")
    return f"""{src}{nb},
test AS (SELECT d.lang, b.lang_pred FROM documents_l d LEFT JOIN best b ON d.doc_id = b.doc_id
         WHERE length(d.text) % 2 = 1 AND d.lang IS NOT NULL),
maj AS (SELECT lang FROM tr GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)
SELECT '{label}' AS label, CAST(count(*) AS BIGINT) AS n_test,
       round(avg(CASE WHEN lang_pred = lang THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(CASE WHEN lang = (SELECT lang FROM maj) THEN 1.0 ELSE 0.0 END), 6) AS majority_accuracy
FROM test"""


@register("scorer_quality", " UNION ALL ".join(f"SELECT * FROM ({_label_sql(x)})" for x in ("quality", "toxic")))
def scorer_quality(spark, sf_dir):
    """Text scorers trained on ``documents`` with each column of ``labels``
    (word naive Bayes): held-out accuracy beside that of the majority class."""
    docs = table(spark, sf_dir, "documents").select("doc_id", lang_text("text").alias("lt"), _is_train().alias("tr"))
    out = None
    for label in ("quality", "toxic"):
        y = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(label).cast("string").alias("lang"))
        d = docs.join(y.where(F.col("lang").isNotNull()), "doc_id")
        train = d.where("tr")
        majority = (train.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
                    .orderBy(F.col("n").desc(), F.col("lang")).first()["lang"])  # one value
        pred = predict_word_nb(train_word_nb(train, "lt", "lang"), d.where(~F.col("tr")), "lt", "doc_id")
        share = lambda c: F.round(F.avg(F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))), 6)
        got = pred.agg(F.count(F.lit(1)).alias("n_test"),
                       share(F.col("lang_pred") == F.col("lang")).alias("accuracy"),
                       share(F.col("lang") == F.lit(majority)).alias("majority_accuracy")
                       ).select(F.lit(label).alias("label"), "*")
        out = got if out is None else out.unionByName(got)
    return out


_GRAMS = """unnest(list_transform(range(1, len(ch) - 1), lambda i: ch[i] || ch[i + 1] || ch[i + 2])) AS token
       FROM (SELECT {0}, string_split(regexp_replace(lower(replace(text, chr(10), '')), '[^\\p{{L}}]+', ' ', 'g'), '') AS ch
             FROM {1})"""
_PROFILE_SQL = _NB_SQL.replace(_NB_SQL[_NB_SQL.index("tk AS ("):_NB_SQL.index("cnt AS (")],
                               f"tk AS (SELECT lang, {_GRAMS.format('lang', 'tr')}),\n")
_PROFILE_SQL = _PROFILE_SQL.replace(_PROFILE_SQL[_PROFILE_SQL.index("dt AS ("):_PROFILE_SQL.index("dv AS (")],
                                    f"dt AS (SELECT doc_id, {_GRAMS.format('doc_id', 'documents')}),\n")


def _profiled(spark, sf_dir):
    """Documents with the language that profiles of the training half give them."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    d = d.withColumn("gt", gram_text(lang_text("text")))   # newlines removed, lower-cased
    profiles = train_profiles(d.where(_is_train()), "gt", "lang")
    return d.withColumn("lang_pred", profiles.column("gt"))


@register("lang_filter", _PROFILE_SQL + """
SELECT d.doc_id, d.lang, b.lang_pred FROM documents d JOIN best b ON d.doc_id = b.doc_id
WHERE b.lang_pred = 'en'""")
def lang_filter(spark, sf_dir):
    """Trigram profiles of half the documents (split by text), keep English."""
    return _profiled(spark, sf_dir).where(F.col("lang_pred") == "en").select("doc_id", "lang", "lang_pred")


@register("lang_profiles", _PROFILE_SQL + """,
test AS (SELECT d.lang, b.lang_pred FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id
         WHERE length(d.text) % 2 = 1 AND d.lang IS NOT NULL),
maj AS (SELECT lang FROM tr GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)
SELECT CAST(count(*) AS BIGINT) AS n_test,
       round(avg(CASE WHEN lang_pred = lang THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(CASE WHEN lang = (SELECT lang FROM maj) THEN 1.0 ELSE 0.0 END), 6) AS majority_accuracy
FROM test""")
def lang_profiles(spark, sf_dir):
    """Held-out accuracy of the trigram profiles beside the majority class (``lang_quality``: word counts)."""
    d = _profiled(spark, sf_dir).where(F.col("lang").isNotNull())
    majority = (d.where(_is_train()).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.col("n").desc(), F.col("lang")).select("lang").first())
    share = lambda c: F.round(F.avg(F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))), 6)
    return d.where(~_is_train()).agg(
        F.count(F.lit(1)).alias("n_test"), share(F.col("lang_pred") == F.col("lang")).alias("accuracy"),
        share(F.col("lang") == F.lit(majority["lang"] if majority else None)).alias("majority_accuracy"))


# Subjectivity lexicon of the default (non-neural) scorer.
SUBJECTIVE_TERMS = {"!": 2.0, "?": 1.0, "ing": 0.4, "tion": -0.3, ",": 0.2}
SUBJECTIVE_BIAS = -0.5
def _subj_sql():
    z = " + ".join([str(SUBJECTIVE_BIAS)] + [
        f"CASE WHEN contains(lower(sentence), '{t}') THEN {w} ELSE 0.0 END"
        for t, w in SUBJECTIVE_TERMS.items()])
    return (f"SELECT doc_id, sentence_idx, sentence FROM ({SENTENCES_SQL}) "
            f"WHERE 1.0 / (1.0 + exp(-({z}))) > {SUBJECTIVE_MIN}")


@register("subjective_filter", _subj_sql())
def subjective_filter(spark, sf_dir):
    """Sentences scored by the lexicon scorer; keep score > 0.5 (strict)."""
    s = split_sentences(v_sentence_docs(spark, sf_dir), "comment")
    sc = lexicon("sentence", "subj_scores", {"subjective": SUBJECTIVE_TERMS}, ["subjective"],
                 bias=SUBJECTIVE_BIAS)(s)
    sc = sc.withColumn("is_subjective", subjective_flag("subj_scores", "subjective_first"))
    return sc.where(F.col("is_subjective") == 1).select("doc_id", "sentence_idx", "sentence")



@register("lang_quality", _NB_SQL + """,
test AS (SELECT d.doc_id, d.lang, b.lang_pred FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id
         WHERE length(d.text) % 2 = 1 AND d.lang IS NOT NULL),
maj AS (SELECT lang FROM tr GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)
SELECT CAST(count(*) AS BIGINT) AS n_test,
       round(avg(CASE WHEN lang_pred = lang THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       (SELECT lang FROM maj) AS majority_label,
       round(avg(CASE WHEN lang = (SELECT lang FROM maj) THEN 1.0 ELSE 0.0 END), 6) AS majority_accuracy
FROM test""")
def lang_quality(spark, sf_dir):
    """Held-out accuracy of the language model vs the majority-class baseline.

    The split is a function of the text, so copies of a text never straddle it.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    d = d.where(F.col("lang").isNotNull()).withColumn("lt", lang_text("text"))
    train, test = d.where(_is_train()), d.where(~_is_train())
    model = train_word_nb(train, "lt", "lang")
    majority = (train.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.col("n").desc(), F.col("lang")).first()["lang"])  # one value
    pred = predict_word_nb(model, test, "lt", "doc_id").withColumn(
        "majority_label", F.lit(majority))
    hit = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
    return pred.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.round(F.avg(hit(F.col("lang_pred") == F.col("lang"))), 6).alias("accuracy"),
        F.first("majority_label").alias("majority_label"),
        F.round(F.avg(hit(F.col("lang") == F.col("majority_label"))), 6).alias("majority_accuracy"))
