"""Cleaning, sentence and mention queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions import text as tx
from threadlens.functions.hof import let
from threadlens.operators import abbreviations as ab
from threadlens.operators.mentions import contains_any, matched_terms
from threadlens.operators.sentences import (
    ABBREV_RE, BOUNDARY, BOUNDARY_KEPT, TRIM, WS, WS_CHARS, split_sentences,
)
from threadlens.plans import register
from threadlens.sources.fixtures import (
    GAZETTEER_A, GAZETTEER_B, v_comments, v_sentence_docs, with_views,
)
from threadlens.sources.tables import table

URL_SQL = (r"http[s]?://[^\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
           r"\x{202f}\x{205f}\x{3000}]+")
PUNCT_END_SQL = r"[!-/:-@\[-`{-~][\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*$"


def _per_comment(name, fn, sql_expr):
    sql = with_views(f"SELECT comment_id, {sql_expr} AS {name} FROM v_comments", "v_comments")

    @register(name, sql)
    def q(spark, sf_dir):
        c = v_comments(spark, sf_dir)
        return c.select("comment_id", fn(F.col("comment")).alias(name))
    return q


_per_comment("strip_cf", tx.strip_cf,
             r"regexp_replace(comment, '\p{Cf}', '', 'g')")
_per_comment("typographic", tx.typographic,
             "replace(translate(comment, '“”‘’–', '\"\"''''-'), '…', '...')")
_per_comment("strip_control", tx.strip_control,
             r"regexp_replace(comment, '[\x00-\x1f\x7f-\x9f]', '', 'g')")
_per_comment("mask_urls", lambda c: tx.mask_urls(tx.strip_control(c)),
             "regexp_replace(regexp_replace(comment, '[\\x00-\\x1f\\x7f-\\x9f]', '', 'g'), "
             f"'{URL_SQL}', '[URL]', 'g')")
_per_comment("end_punct", lambda c: tx.ends_with_punct(c).cast("int"),
             f"CAST(coalesce(regexp_matches(comment, '{PUNCT_END_SQL}'), false) AS INTEGER)")


def _q(x: str) -> str:
    return x.replace("'", "''")


SENT_SQL_ARR = (
    f"list_filter(list_transform(string_split(regexp_replace(regexp_replace(comment, "
    f"'{_q(ABBREV_RE)}', '\\1.' || chr(2) || '\\2', 'g'), '{_q(BOUNDARY)}', '\\1' || chr(1), 'g'), "
    f"chr(1)), lambda s: regexp_replace(replace(s, chr(2), ''), '{_q(TRIM)}', '', 'g')), "
    f"lambda s: s <> '')")
SENTENCES_SQL = with_views(f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS sentence_idx, arr[i] AS sentence,
       CASE WHEN i > 1 THEN arr[i - 1] END AS previous_sentence
FROM (SELECT doc_id, arr, generate_subscripts(arr, 1) AS i
      FROM (SELECT doc_id, {SENT_SQL_ARR} AS arr FROM v_sentence_docs))""", "v_sentence_docs")


@register("sentence_split", f"SELECT doc_id, sentence_idx, sentence FROM ({SENTENCES_SQL})")
def sentence_split(spark, sf_dir):
    s = split_sentences(v_sentence_docs(spark, sf_dir), "comment")
    return s.select("doc_id", "sentence_idx", "sentence")


@register("sentence_lag",
          f"SELECT doc_id, sentence_idx, previous_sentence FROM ({SENTENCES_SQL})")
def sentence_lag(spark, sf_dir):
    s = split_sentences(v_sentence_docs(spark, sf_dir), "comment")
    return s.select("doc_id", "sentence_idx", "previous_sentence")


def _bare_sql(x: str) -> str:
    return f"regexp_replace(lower({x}), '{ab.LEAD}', '')"


# Abbreviations learned from all documents.
_LEARNED = {
    "raws": f"SELECT unnest(regexp_split_to_array(comment, '{WS}+')) AS raw FROM v_sentence_docs",
    "word": f"""SELECT CASE WHEN length(raw) <= {ab.LONGEST}
       THEN regexp_replace({_bare_sql('raw')}, '{ab.TRAIL}', '') ELSE '' END AS w FROM raws WHERE raw <> ''""",
    "typed": f"""SELECT CAST(regexp_matches(w, '{ab.FINAL}') AS BIGINT) AS p,
       regexp_replace(w, '\\.+$', '') AS t FROM word""",
    "counts": f"""SELECT CASE WHEN regexp_matches(t, '{ab.IS_TYPE}') THEN t ELSE '' END AS type,
       CAST(sum(p) AS BIGINT) AS n_with, CAST(sum(1 - p) AS BIGINT) AS n_without FROM typed GROUP BY 1""",
    "total": "SELECT CAST(sum(n_with) AS DOUBLE) / sum(n_with + n_without) AS chance FROM counts",
    "sized": """SELECT counts.*, chance, length(type) - length(replace(type, '.', '')) AS periods,
       CAST(length(replace(type, '.', '')) AS DOUBLE) AS letters
       FROM counts, total WHERE type <> '' AND n_with >= 5""",
    "scored": """SELECT type, n_with, n_without,
       2 * (n_with * (ln(0.99) - ln(chance)) + n_without * (ln(0.01) - CASE WHEN chance < 1 THEN ln(1 - chance) ELSE 0 END))
       * (periods + 1) * exp(-letters - n_without * ln(letters)) AS score FROM sized""",
    "abbrev": f"SELECT * FROM scored WHERE score >= {ab.THRESHOLD}",
}


@register("abbreviation_types", with_views(
    "SELECT type, n_with, n_without, round(score, 4) AS score FROM abbrev", "v_sentence_docs", extra=_LEARNED))
def abbreviation_types(spark, sf_dir):
    """Abbreviations learned from all documents."""
    return ab.learn_abbreviations(v_sentence_docs(spark, sf_dir)).withColumn("score", F.round("score", 4))


_LAST = f"string_split(translate(p, '{WS_CHARS}', '{' ' * len(WS_CHARS)}'), ' ')[-1]"
_TRAINED = _LEARNED | {
    "known": "SELECT coalesce(list(type), []) AS types FROM abbrev",
    "pieces": f"""SELECT doc_id, types, string_split(regexp_replace(regexp_replace(comment, '{_q(TRIM)}', '', 'g'),
       '{_q(BOUNDARY_KEPT)}', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS parts
       FROM v_sentence_docs, known WHERE comment IS NOT NULL""",
    "joined": f"""SELECT doc_id, array_to_string(list_transform(parts, lambda p: p || CASE
       WHEN length({_LAST}) <= {ab.LONGEST} AND regexp_matches({_bare_sql(_LAST)}, '{ab.FINAL}')
            AND list_contains(types, regexp_replace({_bare_sql(_LAST)}, '\\.+$', ''))
       THEN '' ELSE chr(1) END), '') AS text FROM pieces""",
    "arrays": f"""SELECT doc_id, list_filter(list_transform(string_split(text, chr(1)),
       lambda s: regexp_replace(s, '^{WS}+', '')), lambda s: s <> '') AS arr FROM joined""",
}


@register("sentence_split_trained", with_views("""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS sentence_idx, arr[i] AS sentence
FROM (SELECT doc_id, arr, generate_subscripts(arr, 1) AS i FROM arrays)""", "v_sentence_docs", extra=_TRAINED))
def sentence_split_trained(spark, sf_dir):
    """Sentences of all documents; abbreviations learned from the same texts."""
    docs = v_sentence_docs(spark, sf_dir)
    types = ab.collect_types(ab.learn_abbreviations(docs))
    return split_sentences(docs, "comment", abbreviations=types).select("doc_id", "sentence_idx", "sentence")


def _sql_any(col, terms):
    ors = " OR ".join(f"contains(lower({col}), '{t.lower()}')" for t in terms)
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE CAST(({ors}) AS INTEGER) END"


# The oracle uses the full (unreduced) term lists: equal flags prove the reduction.
@register("mention_flags", f"""
SELECT doc_id, {_sql_any('text', GAZETTEER_A)} AS mentions_a,
       {_sql_any('text', GAZETTEER_B)} AS mentions_b
FROM documents""")
def mention_flags(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", contains_any("text", GAZETTEER_A).alias("mentions_a"),
                    contains_any("text", GAZETTEER_B).alias("mentions_b"))


def _terms_values(terms_by_topic):
    rows = ", ".join(f"('{topic}', '{t}')" for topic, ts in terms_by_topic.items() for t in ts)
    return f"SELECT * FROM (VALUES {rows}) AS g(topic, term)"


@register("mention_terms", f"""
SELECT d.doc_id, g.topic, lower(g.term) AS term
FROM documents d JOIN ({_terms_values({'A': GAZETTEER_A, 'B': GAZETTEER_B})}) g
  ON contains(lower(d.text), lower(g.term))""")
def mention_terms(spark, sf_dir):
    """Which gazetteer terms occur in each document (theta join, one row per hit)."""
    d = table(spark, sf_dir, "documents")
    hits = d.select("doc_id", F.array(
        F.struct(F.lit("A").alias("topic"), matched_terms("text", GAZETTEER_A).alias("t")),
        F.struct(F.lit("B").alias("topic"), matched_terms("text", GAZETTEER_B).alias("t")),
    ).alias("g"))
    hits = hits.select("doc_id", F.explode("g").alias("g"))
    return hits.select("doc_id", F.col("g.topic").alias("topic"),
                       F.explode("g.t").alias("term"))


@register("gazetteer_union", f"""
WITH u AS (SELECT DISTINCT term FROM ({_terms_values({'A': GAZETTEER_A, 'B': GAZETTEER_B})}))
SELECT u.term, CAST(count(d.doc_id) AS BIGINT) AS n_docs
FROM u LEFT JOIN documents d ON contains(lower(d.text), lower(u.term))
GROUP BY u.term""")
def gazetteer_union(spark, sf_dir):
    """Union-distinct of the two gazetteers; documents containing each term."""
    terms = sorted(set(GAZETTEER_A) | set(GAZETTEER_B))
    d = table(spark, sf_dir, "documents")
    per_doc = d.select(F.explode(let(F.lower(F.col("text")), lambda low: F.filter(
        F.array(*[F.lit(t) for t in terms]),
        lambda t: low.contains(F.lower(t))))).alias("term"))
    counts = per_doc.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))
    all_terms = d.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    return (all_terms.join(counts, "term", "left")
            .select("term", F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs")))

