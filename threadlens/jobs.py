"""End-to-end jobs over landed files: what a user of the reference runs.

``comments_from_landing`` turns the landed collector files (Reddit comment
and post CSVs per topic, the video-comment CSV) into the unified comment
table; ``comment_level`` cleans it and adds levels, context and mention
flags; ``sentence_level`` splits it into sentences and applies the
subjectivity gate. Each step is a DataFrame job; stage tables are written
under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.labels import subjective_flag
from threadlens.operators.clean import ModelGate, clean_comments
from threadlens.operators.dedup import keep_first
from threadlens.operators.joins import hot_keys
from threadlens.operators.mentions import mention_flags
from threadlens.operators.sentences import split_sentences
from threadlens.operators.threads import assign_levels, identity_rewrite, thread_context
from threadlens.operators.unify import join_parent, join_posts, rename_profile, unify_platforms
from threadlens.schemas import POSTS_RAW, THREAD_COMMENTS_RAW, VIDEO_COMMENTS_RAW
from threadlens.session import staged, staged_counted
from threadlens.sources import landing


def _landing_order(df: DataFrame) -> DataFrame:
    """Explicit keep-first order: file path, then position in the file
    (multi-line CSV files are read whole by one task, so ids increase)."""
    return df.withColumn("_order", F.struct(F.col("_metadata.file_path").alias("f"),
                                            F.monotonically_increasing_id().alias("i")))


def comments_from_landing(spark: SparkSession, landing_dir: str,
                          video_file: str = "youtube_comments.csv",
                          extra: Sequence[str] = ()) -> DataFrame:
    """Landed files -> unified comment table (+ ``_order`` and ``extra``)."""
    base = landing_dir.rstrip("/")
    comments = landing.consolidate(spark, base, "_comment_data_", THREAD_COMMENTS_RAW)
    posts = landing.consolidate(spark, base, "_post_data_", POSTS_RAW)
    comments = rename_profile(_landing_order(comments), "reddit_comments").drop("search_type")
    posts = rename_profile(_landing_order(posts), "reddit_posts").drop("search_type")
    comments, n = staged_counted(keep_first(comments, ["comment_id"], ["_order"]), "comments")
    posts = keep_first(posts, ["post_id"], ["_order"]).drop("_order")
    hot = hot_keys(comments, "post_id", n)                  # on the staged table
    reddit = join_posts(join_parent(comments, n_rows=n), posts, n_comments=n, hot_posts=hot)
    videos = landing.expand_glob(spark, f"{base}/{video_file}")
    if videos:
        yt = landing.read_landed_csv(spark, videos, VIDEO_COMMENTS_RAW)
    else:
        yt = spark.createDataFrame([], VIDEO_COMMENTS_RAW)
    yt = keep_first(rename_profile(_landing_order(yt), "youtube"), ["comment_id"], ["_order"])
    return unify_platforms(reddit, yt, extra=["_order", *extra])


def comment_level(unified: DataFrame, english: Callable[[DataFrame], Column] | ModelGate | None,
                  gazetteers: Mapping[str, Sequence[str]],
                  rewrite: Callable[[Column], Column] = identity_rewrite,
                  order_col: str = "_order") -> DataFrame:
    """clean -> stage table -> levels -> context (with ``rewrite``) -> flags."""
    u = clean_comments(unified, english)
    u = staged(u.withColumn("parent_comment", F.coalesce("parent_comment", F.lit(""))), "cleaned")
    ctx = thread_context(assign_levels(u), rewrite=rewrite, order_col=order_col)
    return mention_flags(ctx, "comment", {k: list(v) for k, v in gazetteers.items()})


def sentence_level(comments: DataFrame, subjectivity_scorer=None,
                   profile: str = "subjective_first", text_col: str = "comment") -> DataFrame:
    """Sentences of each comment with the previous sentence; with a scorer,
    only subjective sentences are kept (score column dropped)."""
    s = split_sentences(comments, text_col)
    if subjectivity_scorer is None:
        return s
    s = subjectivity_scorer(s)
    out = s.where(subjective_flag(subjectivity_scorer.out_col, profile) == 1)
    return out.drop(subjectivity_scorer.out_col)
