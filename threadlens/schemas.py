"""Schemas, label catalogs and the NA literal set.

Catalogs are defaults only; every operator takes them as parameters.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Entity labels, in slot order.
ENTITY_LABELS = ["kamala", "trump", "others"]
# Aspect labels, in slot order; "others" is the last (14th) slot.
ASPECT_LABELS = [
    "campaign", "communication", "competence", "controversies",
    "ethics and integrity", "leadership", "personality trait", "policies",
    "political ideology", "public image", "public service record",
    "relationships and alliances", "voter sentiment", "others",
]
# Sentiment labels, slot order; code = slot - 1 (-1/0/1).
SENTIMENT_LABELS = ["negative", "neutral", "positive"]
# Text that replaces "others" in the conditioning prompt.
OTHERS_PROMPT = "neither trump nor kamala"
# Literals that a CSV scan treats as missing (pandas read_csv default set).
NA_LITERALS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# Decision thresholds.
ENTITY_THRESHOLD = 0.65        # strict >
ASPECT_THRESHOLD = 0.35        # inclusive >=
FIRST_OPINION_MIN = 0.85       # arbitration: first model wins at >=
SECOND_OPINION_MIN = -0.36     # arbitration: else second model wins at >=
RELEVANCE_MIN = 0.5            # keep >=
SUBJECTIVE_MIN = 0.5           # strict >
CONTEXT_MARKER = "[NEXT_COMMENT]"
DELETED = "[deleted]"
# Column renames per source profile.
RENAME_PROFILES = {
    "reddit_comments": {
        "Post Title": "post_title", "Post ID": "post_id",
        "Comment ID": "comment_id", "Timestamp": "comment_timestamp",
        "Votes": "number_of_comment_votes", "Comment": "comment",
        "Parent Comment ID": "parent_comment_id",
    },
    "reddit_posts": {
        "votes": "number_of_post_votes", "created_utc": "post_timestamp",
        "num_comments": "post_num_comments",
    },
    "youtube": {
        "video_title": "post_title", "video_id": "post_id",
        "comment_date": "comment_timestamp",
        "number_of_likes": "number_of_comment_votes", "Comment": "comment",
        "video_post_date": "post_timestamp",
    },
}
# Unified comment columns, in order.
UNIFIED_COLUMNS = [
    "post_id", "post_title", "post_timestamp", "parent_comment_id",
    "parent_comment", "comment_id", "comment", "comment_timestamp",
    "number_of_comment_votes",
]
# ---------------------------------------------------------------------------

POSTS_RAW = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("post_title", T.StringType()),
    T.StructField("votes", T.LongType()),
    T.StructField("created_utc", T.StringType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("post_body", T.StringType()),
])

THREAD_COMMENTS_RAW = T.StructType([
    T.StructField("Post Title", T.StringType()),
    T.StructField("Post ID", T.StringType()),
    T.StructField("Comment ID", T.StringType()),
    T.StructField("Timestamp", T.StringType()),
    T.StructField("Votes", T.LongType()),
    T.StructField("Comment", T.StringType()),
    T.StructField("Parent Comment ID", T.StringType()),
])

VIDEO_COMMENTS_RAW = T.StructType([
    T.StructField("video_title", T.StringType()),
    T.StructField("video_id", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("comment_id", T.StringType()),
    T.StructField("number_of_likes", T.LongType()),
    T.StructField("parent_comment", T.StringType()),
    T.StructField("parent_comment_id", T.StringType()),
    T.StructField("comment_date", T.StringType()),
    T.StructField("video_post_date", T.StringType()),
])

UNIFIED = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("post_title", T.StringType()),
    T.StructField("post_timestamp", T.TimestampNTZType()),
    T.StructField("parent_comment_id", T.StringType()),
    T.StructField("parent_comment", T.StringType()),
    T.StructField("comment_id", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("comment_timestamp", T.TimestampNTZType()),
    T.StructField("number_of_comment_votes", T.LongType()),
    T.StructField("platform", T.StringType()),
])

# One token of a tokenised text: start offset, text, trailing whitespace.
TOKEN = T.StructType([
    T.StructField("idx", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("ws", T.StringType()),
])
# A mention: inclusive token range [tok_start, tok_end].
MENTION = T.StructType([
    T.StructField("tok_start", T.IntegerType()),
    T.StructField("tok_end", T.IntegerType()),
])
CLUSTERS = T.ArrayType(T.ArrayType(MENTION))
