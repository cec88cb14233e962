"""Landed CSV files -> unified table equals the Parquet-based flow."""

from collections import Counter

from pyspark.sql import functions as F

from threadlens import jobs
from threadlens.plans.common import unified
from threadlens.schemas import POSTS_RAW, THREAD_COMMENTS_RAW, UNIFIED_COLUMNS, VIDEO_COMMENTS_RAW
from threadlens.sources.fixtures import (
    v_reddit_comments_raw, v_reddit_posts_raw, v_youtube_comments_raw,
)
from threadlens.sources.landing import export_csv

SF = "/root/testdata/sf0.001"


def _land(df, schema, path):
    export_csv(df.select(*[f"`{f.name}`" for f in schema.fields]), path)


def test_comments_from_landing_equals_parquet_flow(spark, tmp_path):
    base = str(tmp_path)
    rc = v_reddit_comments_raw(spark, SF)
    parity = F.expr("cast(substring(`Post ID`, 2) as int) % 2")
    _land(rc.where(parity == 0), THREAD_COMMENTS_RAW, f"{base}/22102024_reddit_comment_data_trump")
    _land(rc.where(parity == 1), THREAD_COMMENTS_RAW, f"{base}/22102024_reddit_comment_data_kamala")
    rp = v_reddit_posts_raw(spark, SF)
    _land(rp.where(F.col("_order") % 2 == 0), POSTS_RAW, f"{base}/22102024_reddit_post_data_trump")
    _land(rp.where(F.col("_order") % 2 == 1), POSTS_RAW, f"{base}/22102024_reddit_post_data_kamala")
    _land(rp, POSTS_RAW, f"{base}/22102024_reddit_post_data_test_trump")   # must be ignored
    _land(v_youtube_comments_raw(spark, SF), VIDEO_COMMENTS_RAW, f"{base}/youtube_comments.csv")

    got = jobs.comments_from_landing(spark, base).select(*UNIFIED_COLUMNS, "platform")
    want = unified(spark, SF).select(*UNIFIED_COLUMNS, "platform")
    assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r) for r in want.collect())


def test_sentence_level_gate(spark):
    from threadlens.operators.scoring import lexicon
    df = spark.createDataFrame([(1, "Wow! Plain text here. Really?")], "id int, comment string")
    sc = lexicon("sentence", "subj", {"s": {"!": 2.0, "?": 1.0}}, ["s"], bias=-0.5)
    got = [r.sentence for r in jobs.sentence_level(df, sc).orderBy("sentence_idx").collect()]
    assert got == ["Wow!", "Really?"]
