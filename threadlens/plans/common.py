"""Shared stages of the comment flow, as DataFrames and as SQL CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import normalize_na
from threadlens.operators.dedup import keep_first
from threadlens.operators.joins import hot_keys
from threadlens.operators.unify import (
    join_parent, join_posts, rename_profile, unify_platforms,
)
from threadlens.schemas import NA_LITERALS
from threadlens.session import staged_counted
from threadlens.sources.fixtures import (
    named_posts, v_comments, v_reddit_comments_raw, v_reddit_posts_raw, v_youtube_comments_raw,
)

NA_SQL = ", ".join("'" + x.replace("'", "''") + "'" for x in NA_LITERALS)


def na_sql(col: str) -> str:
    return f"CASE WHEN {col} IN ({NA_SQL}) THEN NULL ELSE {col} END"


def _scan_na(df: DataFrame, cols) -> DataFrame:
    """What a CSV scan of the landed files yields: NA literals are NULL."""
    return df.withColumns({c: normalize_na(c) for c in cols})


def reddit_comments(spark, sf_dir) -> tuple[DataFrame, int]:
    """Deduplicated comments as a stage table (both sides of the parent
    self-join read it: one dedup shuffle, not two) and its row count,
    observed while it is written."""
    raw = _scan_na(v_reddit_comments_raw(spark, sf_dir), ["Comment", "Parent Comment ID"])
    return staged_counted(
        keep_first(rename_profile(raw, "reddit_comments"), ["comment_id"], ["_order"]), "comments")


def reddit_posts(spark, sf_dir) -> DataFrame:
    p = rename_profile(v_reddit_posts_raw(spark, sf_dir), "reddit_posts")
    return keep_first(p, ["post_id"], ["_order"]).drop("_order")


def reddit_joined(spark, sf_dir) -> DataFrame:
    """Comments + parent text (D2) + post fields (D1).

    The parent lookup runs first: its lookup side is the keep-first output,
    already hash-partitioned by comment_id, so only the reply side shuffles.
    Posts are deduplicated, so the post join cannot multiply rows and the
    order of the two left joins does not change the result.
    """
    c, n = reddit_comments(spark, sf_dir)
    # keep-first made ids unique, so the parent join keeps rows 1:1: hot posts
    # are found on the staged comments, not by re-running the parent join
    hot = hot_keys(c, "post_id", n)
    posts = named_posts(reddit_posts(spark, sf_dir), c)
    c = join_parent(c, n_rows=n)
    return join_posts(c, posts, n_comments=n, hot_posts=hot)


def youtube_comments(spark, sf_dir) -> DataFrame:
    raw = _scan_na(v_youtube_comments_raw(spark, sf_dir),
                   ["comment", "parent_comment", "parent_comment_id"])
    return keep_first(rename_profile(raw, "youtube"), ["comment_id"], ["_order"])


def unified(spark, sf_dir) -> DataFrame:
    return unify_platforms(reddit_joined(spark, sf_dir), youtube_comments(spark, sf_dir),
                           extra=["lang", "_order"])


def present_comments(spark, sf_dir) -> DataFrame:
    """v_comments of all languages after the scan NA rule and NULL drop (no Python)."""
    c = v_comments(spark, sf_dir)
    c = c.withColumn("comment", normalize_na("comment"))
    return c.where(F.col("comment").isNotNull())


def gated_comments(spark, sf_dir) -> DataFrame:
    """v_comments after the scan NA rule, NULL drop and English gate (no Python)."""
    return present_comments(spark, sf_dir).where(F.col("lang") == "en")


def _dedup_sql(src: str, key: str, order: str = "_order") -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) AS _rn FROM {src}) WHERE _rn = 1")


UNIFY_CTES = {
    "rc": f"""SELECT "Post Title" AS post_title, "Post ID" AS post_id, "Comment ID" AS comment_id,
       "Timestamp" AS comment_timestamp, "Votes" AS number_of_comment_votes,
       {na_sql('"Comment"')} AS comment, {na_sql('"Parent Comment ID"')} AS parent_comment_id,
       _order, lang FROM v_reddit_comments_raw""",
    "rc1": _dedup_sql("rc", "comment_id"),
    "rp": """SELECT post_id, post_title, votes AS number_of_post_votes,
       created_utc AS post_timestamp, num_comments AS post_num_comments, post_body, _order
       FROM v_reddit_posts_raw""",
    "rp1": _dedup_sql("rp", "post_id"),
    "rj": """SELECT c.*, p.number_of_post_votes, p.post_timestamp, p.post_num_comments, p.post_body
       FROM rc1 c LEFT JOIN rp1 p ON c.post_id = p.post_id""",
    "rj2": """SELECT a.*, b.comment AS parent_comment FROM rj a
       LEFT JOIN rj b ON a.parent_comment_id = b.comment_id""",
    "yc": f"""SELECT video_title AS post_title, video_id AS post_id, {na_sql('comment')} AS comment,
       comment_id, number_of_likes AS number_of_comment_votes,
       {na_sql('parent_comment')} AS parent_comment, {na_sql('parent_comment_id')} AS parent_comment_id,
       comment_date AS comment_timestamp, video_post_date AS post_timestamp, _order, lang
       FROM v_youtube_comments_raw""",
    "yc1": _dedup_sql("yc", "comment_id"),
    "uni": """
SELECT post_id, post_title, CAST(CAST(try_strptime(post_timestamp, '%d-%b-%Y') AS DATE) AS TIMESTAMP) AS post_timestamp,
       parent_comment_id, parent_comment, comment_id, comment,
       CAST(CAST(try_strptime(comment_timestamp, '%d-%b-%Y') AS DATE) AS TIMESTAMP) AS comment_timestamp,
       number_of_comment_votes, 'Reddit' AS platform, lang, _order FROM rj2
UNION ALL
SELECT post_id, post_title,
       CAST(CAST(try_strptime(post_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS TIMESTAMP) AS post_timestamp,
       nullif(parent_comment_id, 'N/A'), nullif(parent_comment, 'N/A'), comment_id, comment,
       CAST(CAST(try_strptime(comment_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS TIMESTAMP) AS comment_timestamp,
       number_of_comment_votes, 'Youtube' AS platform, lang, _order FROM yc1""",
    "gated": f"""SELECT * REPLACE ({na_sql('comment')} AS comment) FROM v_comments
       WHERE {na_sql('comment')} IS NOT NULL AND lang = 'en'""",
}


def ctes(*names: str) -> dict[str, str]:
    """The named shared CTEs plus everything before them, in order."""
    keys = list(UNIFY_CTES)
    last = max(keys.index(n) for n in names)
    wanted = keys[: last + 1]
    return {k: UNIFY_CTES[k] for k in wanted}
