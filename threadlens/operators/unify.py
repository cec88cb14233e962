"""Landing -> unified comment schema: renames, joins, date parsing, union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.dates import parse_day_mon_year, parse_iso_day
from threadlens.operators.joins import lookup_join
from threadlens.schemas import RENAME_PROFILES, UNIFIED_COLUMNS


def rename_profile(df: DataFrame, profile: str) -> DataFrame:
    """Rename columns by source profile; missing columns are ignored."""
    if profile not in RENAME_PROFILES:
        raise ValueError("Invalid dataset name")
    mapping = {k: v for k, v in RENAME_PROFILES[profile].items() if k in df.columns}
    return df.withColumnsRenamed(mapping)


def parse_parent_id(c) -> F.Column:
    """'t1_abc' -> 'abc' (reply to a comment); anything else -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.contains("t1_"), F.element_at(F.split(col, "_"), -1))


def join_posts(comments: DataFrame, posts: DataFrame, split_hot: bool = True,
               n_comments: int | None = None, hot_posts: list | None = None) -> DataFrame:
    """Left join comments to posts on post_id; the post title stays the comment's.

    No broadcast hint: AQE broadcasts the posts side at runtime when it is
    small. A viral post's comments are joined against a broadcast of that
    post's row only (``lookup_join``) instead of landing in one shuffle task.
    """
    p = posts.drop("post_title").withColumnRenamed("post_id", "_post_id")
    if split_hot:
        out = lookup_join(comments, p, "post_id", "_post_id", "left", n_left=n_comments,
                          hot=hot_posts)
    else:
        out = comments.join(p, F.col("post_id") == F.col("_post_id"), "left")
    return out.drop("_post_id")


def join_parent(df: DataFrame, id_col: str = "comment_id", text_col: str = "comment",
                parent_col: str = "parent_comment_id", out_col: str = "parent_comment",
                null_safe: bool = False, split_hot: bool = True,
                n_rows: int | None = None) -> DataFrame:
    """Left self-join fetching the parent's text (NULL when the parent is absent).

    Replies to a viral comment share one key; ``split_hot`` joins such keys
    against a broadcast of their few parent rows instead of one shuffle task.
    Pass ``n_rows`` when known (e.g. observed while staging ``df``) to avoid a
    counting pass.
    """
    lookup = df.select(F.col(id_col).alias("_pid"), F.col(text_col).alias(out_col))
    if null_safe:
        cond = F.col(parent_col).eqNullSafe(F.col("_pid"))
        return df.join(lookup, cond, "left").drop("_pid")
    if split_hot:
        return lookup_join(df, lookup, parent_col, "_pid", "left", n_left=n_rows).drop("_pid")
    return df.join(lookup, F.col(parent_col) == F.col("_pid"), "left").drop("_pid")


def parent_fallback(df: DataFrame) -> DataFrame:
    """Parent text falls back to the post title (optional step)."""
    return df.withColumn("parent_comment",
                         F.coalesce(F.col("parent_comment"), F.col("post_title")))


def unify_platforms(reddit: DataFrame, youtube: DataFrame, extra=()) -> DataFrame:
    """Align the two platforms to the unified columns and union them.

    Reddit dates are 'd-Mon-yyyy', video dates ISO-8601 floored to the UTC
    day; 'N/A' parent sentinels become NULL. ``extra`` columns pass through.
    """
    extra = list(extra)
    r = reddit.select(
        "post_id", "post_title",
        parse_day_mon_year("post_timestamp").alias("post_timestamp"),
        "parent_comment_id", "parent_comment", "comment_id", "comment",
        parse_day_mon_year("comment_timestamp").alias("comment_timestamp"),
        "number_of_comment_votes", F.lit("Reddit").alias("platform"), *extra)
    y = youtube.select(
        "post_id", "post_title",
        parse_iso_day("post_timestamp").alias("post_timestamp"),
        F.nullif(F.col("parent_comment_id"), F.lit("N/A")).alias("parent_comment_id"),
        F.nullif(F.col("parent_comment"), F.lit("N/A")).alias("parent_comment"),
        "comment_id", "comment",
        parse_iso_day("comment_timestamp").alias("comment_timestamp"),
        "number_of_comment_votes", F.lit("Youtube").alias("platform"), *extra)
    return r.unionByName(y).select(*UNIFIED_COLUMNS, "platform", *extra)
