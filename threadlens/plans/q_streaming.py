"""Streaming queries, run to completion with ``availableNow`` and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.plans import register
from threadlens.plans.q_ingest import APPEND_SQL
from threadlens.plans.q_text import URL_SQL
from threadlens.plans.q_threads import CONTEXT_SQL, context_input, placed
from threadlens.session import scratch_path
from threadlens.sources.fixtures import (
    GAZETTEER_A, GAZETTEER_B, v_comments, v_events_arriving, v_events_stored, with_views,
)
from threadlens.streaming.ingest import init_stored, stream_append, stream_clean
from threadlens.streaming.threads import ThreadTables, current, stream_threads


BUCKETS = 16  # layout of the stored table (a table property; thousands at scale)


@register("stream_append", APPEND_SQL)
def stream_append_q(spark, sf_dir):
    base = scratch_path(spark, "stream-append")
    stored_path, landing_dir = f"{base}/stored", f"{base}/landing"
    init_stored(v_events_stored(spark, sf_dir), stored_path, "event_id", n_buckets=BUCKETS)
    arriving = v_events_arriving(spark, sf_dir)
    arriving.write.parquet(landing_dir)
    q = stream_append(spark, landing_dir, arriving.schema, stored_path, "event_id",
                      ["ts", "user_id"], f"{base}/_checkpoint", n_buckets=BUCKETS)
    q.awaitTermination()
    return spark.read.parquet(stored_path).drop("_bucket")


def _clean_sql(c):
    t = f"replace(translate({c}, '“”‘’–', '\"\"''''-'), '…', '...')"
    return f"regexp_replace({t}, '[\\x00-\\x1f\\x7f-\\x9f]', '', 'g')"


def _flag_sql(col, terms):
    ors = " OR ".join(f"contains(lower({col}), '{t.lower()}')" for t in terms)
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE CAST(({ors}) AS INTEGER) END"


_CLEANED = f"regexp_replace({_clean_sql('comment')}, '{URL_SQL}', '[URL]', 'g')"


@register("stream_clean", with_views(f"""
SELECT comment_id, post_title, comment, {_flag_sql('comment', GAZETTEER_A)} AS mentions_a,
       {_flag_sql('comment', GAZETTEER_B)} AS mentions_b FROM (
  SELECT comment_id, {_clean_sql('post_title')} AS post_title, {_CLEANED} AS comment
  FROM v_comments)""", "v_comments"))
def stream_clean_q(spark, sf_dir):
    base = scratch_path(spark, "stream-clean")
    landing_dir, sink = f"{base}/landing", f"{base}/sink"
    src = v_comments(spark, sf_dir)
    src.write.parquet(landing_dir)
    q = stream_clean(spark, landing_dir, src.schema, sink, f"{base}/_checkpoint",
                     gazetteers={"mentions_a": GAZETTEER_A, "mentions_b": GAZETTEER_B})
    q.awaitTermination()
    return spark.read.parquet(sink).select("comment_id", "post_title", "comment",
                                           "mentions_a", "mentions_b")


ARRIVALS = 3  # runs of the stream; ids are dealt by hash, so many parents land after their replies


@register("stream_thread_context", CONTEXT_SQL)
def stream_thread_context_q(spark, sf_dir):
    """thread_context from arriving comments: only affected threads are computed anew."""
    base = scratch_path(spark, "stream-threads")
    src = context_input(spark, sf_dir)
    landed = f"{base}/arrivals"
    src.withColumn("_part", F.pmod(F.xxhash64("comment_id"), F.lit(ARRIVALS))).write.partitionBy("_part").parquet(landed)
    tables = ThreadTables(f"{base}/tables", src.schema, buckets=BUCKETS)
    for part in range(ARRIVALS):
        spark.read.schema(src.schema).parquet(f"{landed}/_part={part}").write.mode("append").parquet(f"{base}/landing")
        stream_threads(spark, f"{base}/landing", tables, f"{base}/_checkpoint", ["doc_id"]).awaitTermination()
    return current(spark, tables).select(*placed(
        "comment_id", "level", "parent_comment", "comment_after_coref"))
