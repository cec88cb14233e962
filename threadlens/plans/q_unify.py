"""Scan, unify, join, dedup and date queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions.dates import coerce_two_formats, epoch_to_day_text, parse_day_mon_year, parse_iso_day
from threadlens.functions.text import normalize_na
from threadlens.operators.dedup import keep_first
from threadlens.operators.unify import parent_fallback, parse_parent_id
from threadlens.plans import register
from threadlens.plans.common import ctes, na_sql, reddit_joined, unified
from threadlens.schemas import NA_LITERALS, UNIFIED_COLUMNS
from threadlens.sources.fixtures import v_comments, with_views
from threadlens.sources.tables import table

_VIEWS = ("v_reddit_comments_raw", "v_reddit_posts_raw", "v_youtube_comments_raw")
# Probe tokens for the NA rule: the NA set plus look-alikes that must survive.
_NA_PROBES = NA_LITERALS + ["none", "N.A.", "ok"]


@register("scan_na", f"""
SELECT doc_id, token, {na_sql('token')} AS normalized FROM (
  SELECT doc_id, ([{", ".join("'" + x + "'" for x in _NA_PROBES)}])[doc_id % {len(_NA_PROBES)} + 1] AS token
  FROM documents)""")
def scan_na(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    probes = F.array(*[F.lit(x) for x in _NA_PROBES])
    tok = F.element_at(probes, (F.col("doc_id") % len(_NA_PROBES) + 1).cast("int"))
    return d.select("doc_id", tok.alias("token")).withColumn("normalized", normalize_na("token"))


@register("join_posts", with_views("""
SELECT comment_id, post_id, number_of_post_votes, post_timestamp, post_num_comments, post_body
FROM rj""", *_VIEWS, extra=ctes("rj")))
def join_posts_q(spark, sf_dir):
    return reddit_joined(spark, sf_dir).select(
        "comment_id", "post_id", "number_of_post_votes", "post_timestamp",
        "post_num_comments", "post_body")


@register("join_parent", with_views("""
SELECT comment_id, parent_comment_id, parent_comment FROM rj2""", *_VIEWS, extra=ctes("rj2")))
def join_parent_q(spark, sf_dir):
    return reddit_joined(spark, sf_dir).select("comment_id", "parent_comment_id", "parent_comment")


_UNI_COLS = ", ".join(UNIFIED_COLUMNS + ["platform"])


@register("unify", with_views(f"SELECT {_UNI_COLS} FROM uni", *_VIEWS, extra=ctes("uni")))
def unify_q(spark, sf_dir):
    return unified(spark, sf_dir).select(*UNIFIED_COLUMNS, "platform")


@register("parent_fallback", with_views("""
SELECT comment_id, coalesce(parent_comment, post_title) AS parent_comment FROM uni""",
                                        *_VIEWS, extra=ctes("uni")))
def parent_fallback_q(spark, sf_dir):
    return parent_fallback(unified(spark, sf_dir)).select("comment_id", "parent_comment")


@register("parse_dates", with_views("""
SELECT comment_id,
  CASE WHEN platform = 'Reddit'
       THEN CAST(CAST(try_strptime(comment_timestamp, '%d-%b-%Y') AS DATE) AS TIMESTAMP)
       ELSE CAST(CAST(try_strptime(comment_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS TIMESTAMP)
  END AS comment_day,
  CAST(CAST(coalesce(try_strptime(comment_timestamp, '%d-%b-%Y'),
                     try_strptime(comment_timestamp, '%Y-%m-%dT%H:%M:%SZ')) AS DATE) AS TIMESTAMP)
    AS coerced_day
FROM v_comments""", "v_comments"))
def parse_dates(spark, sf_dir):
    c = v_comments(spark, sf_dir)
    day = F.when(F.col("platform") == "Reddit", parse_day_mon_year("comment_timestamp", strict=True)) \
           .otherwise(parse_iso_day("comment_timestamp", strict=True))
    return c.select("comment_id", day.alias("comment_day"),
                    coerce_two_formats("comment_timestamp", strict=True)
                    .cast("timestamp_ntz").alias("coerced_day"))


@register("epoch_text", """
SELECT event_id, strftime(to_timestamp(floor(epoch(ts))::BIGINT), '%d-%b-%Y') AS day_text
FROM events""")
def epoch_text(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), "ts")
    return e.select("event_id", epoch_to_day_text(epoch).alias("day_text"))


@register("parent_id_parse", with_views("""
SELECT comment_id, ref AS parent_ref,
       CASE WHEN contains(ref, 't1_') THEN string_split(ref, '_')[-1] END AS parent_comment_id
FROM (SELECT comment_id, CASE WHEN parent_comment_id IS NULL THEN 't3_' || post_id
                              ELSE 't1_' || parent_comment_id END AS ref FROM v_comments)""",
                                        "v_comments"))
def parent_id_parse(spark, sf_dir):
    c = v_comments(spark, sf_dir)
    ref = F.when(F.col("parent_comment_id").isNull(), F.concat(F.lit("t3_"), "post_id")) \
           .otherwise(F.concat(F.lit("t1_"), "parent_comment_id"))
    c = c.select("comment_id", ref.alias("parent_ref"))
    return c.withColumn("parent_comment_id", parse_parent_id("parent_ref"))


@register("dedup_first", """
SELECT doc_id, text, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 1""")
def dedup_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return keep_first(d, ["text"], ["doc_id"])

