"""Landed files: CSV consolidation with drift check, JSON payload scans and
thread flattening.

The collectors' HTTP clients are not part of this library; their payloads
land as files, and everything from there on is a Spark scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.dates import epoch_to_day_text
from threadlens.functions.text import normalize_na
from threadlens.schemas import NA_LITERALS
from threadlens.session import cut_lineage


def read_landed_csv(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType,
                    na_values=NA_LITERALS) -> DataFrame:
    """CSV with header, embedded newlines/quotes, a fixed schema and the NA rule.

    ``enforceSchema=False`` makes Spark check every file's header against the
    schema: a file whose columns drift (renamed, reordered) fails the scan.
    """
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
          .option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(paths))
    strings = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: normalize_na(c, na_values) for c in strings})


def expand_glob(spark: SparkSession, pattern: str) -> list[str]:
    """Concrete paths matching a glob (file-system listing only, no data)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jpath)
    return sorted(str(st.getPath().toString()) for st in found) if found else []


def consolidate(spark: SparkSession, base: str, kind: str, schema: T.StructType,
                tag: str = "trump", tag_value: str = "Trump", other_value: str = "Kamala",
                exclude: str = "test") -> DataFrame:
    """All landed files of ``kind`` (e.g. '_post_data_') except ``exclude``;
    ``search_type`` from the file path (case-sensitive ``tag`` test)."""
    paths = expand_glob(spark, f"{base.rstrip('/')}/*{kind}*")
    if not paths:
        return spark.createDataFrame(
            [], T.StructType(schema.fields + [T.StructField("search_type", T.StringType())]))
    df = read_landed_csv(spark, paths, schema)
    path = F.col("_metadata.file_path")
    # Selection looks at the landed name (the file, or the folder a Spark
    # writer produced); the topic tag looks at the whole path.
    fname = F.col("_metadata.file_name")
    landed = F.when(fname.startswith("part-"), F.element_at(F.split(path, "/"), -2)) \
              .otherwise(fname)
    df = df.where(~landed.contains(exclude))
    return df.withColumn("search_type",
                         F.when(path.contains(tag), F.lit(tag_value)).otherwise(F.lit(other_value)))


def optional_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A previous table if it exists, else an empty one with ``schema``."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(jpath):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


POST_PAYLOAD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("created", T.LongType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("is_self", T.BooleanType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("url", T.StringType()),
])


def post_records(payloads: DataFrame) -> DataFrame:
    """Post payloads -> 6 fields; body = selftext for self posts, else the URL."""
    return payloads.select(
        F.col("id").alias("post_id"), F.col("title").alias("post_title"),
        F.col("score").alias("votes"),
        epoch_to_day_text("created").alias("created_utc"),
        "num_comments",
        F.when(F.col("is_self"), F.col("selftext")).otherwise(F.col("url")).alias("post_body"))


_REPLY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("snippet", T.StructType([
        T.StructField("textDisplay", T.StringType()),
        T.StructField("likeCount", T.LongType()),
        T.StructField("publishedAt", T.StringType()),
    ])),
])
THREAD_ITEM = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("snippet", T.StructType([
        T.StructField("topLevelComment", _REPLY),
        T.StructField("totalReplyCount", T.LongType()),
    ])),
    T.StructField("replies", T.ArrayType(_REPLY)),
])


def flatten_replies(items: DataFrame) -> DataFrame:
    """Two-level thread items -> one row per comment.

    Top-level rows get 'N/A' parents; replies (only when totalReplyCount > 0)
    carry the parent's id *and text* from the enclosing struct: no join.
    """
    top = items.select(
        "video_id",
        F.col("snippet.topLevelComment.snippet.textDisplay").alias("comment"),
        F.col("snippet.topLevelComment.id").alias("comment_id"),
        F.col("snippet.topLevelComment.snippet.likeCount").alias("number_of_likes"),
        F.lit("N/A").alias("parent_comment"), F.lit("N/A").alias("parent_comment_id"),
        F.col("snippet.topLevelComment.snippet.publishedAt").alias("comment_date"))
    rep = items.where(F.col("snippet.totalReplyCount") > 0).select(
        "video_id",
        F.col("snippet.topLevelComment.snippet.textDisplay").alias("_ptext"),
        F.col("snippet.topLevelComment.id").alias("_pid"),
        F.explode("replies").alias("r"))
    rep = rep.select(
        "video_id", F.col("r.snippet.textDisplay").alias("comment"),
        F.col("r.id").alias("comment_id"),
        F.col("r.snippet.likeCount").alias("number_of_likes"),
        F.col("_ptext").alias("parent_comment"), F.col("_pid").alias("parent_comment_id"),
        F.col("r.snippet.publishedAt").alias("comment_date"))
    return top.unionByName(rep)


def flatten_threads(threads: DataFrame, payload_col: str = "payload",
                    post_col: str = "post_id") -> DataFrame:
    """Arbitrarily nested reply trees (JSON text) -> flat comment rows.

    Each node is ``{"id", "body", "created", "score", "replies": [...]}``.
    The tree is parsed to VARIANT and expanded one depth per round with
    ``variant_explode`` until no replies remain; the parent id of a node is
    that of the node it was exploded from (NULL for top-level comments).
    """
    level = threads.select(
        F.col(post_col).alias("post_id"), F.lit(None).cast("string").alias("parent_comment_id"),
        F.parse_json(F.col(payload_col)).alias("v"))
    level = level.selectExpr("post_id", "parent_comment_id",
                             "explode(variant_get(v, '$.comments', 'array<variant>')) AS node")
    out = None
    while True:
        rows = level.selectExpr(
            "post_id", "parent_comment_id",
            "variant_get(node, '$.id', 'string') AS comment_id",
            "variant_get(node, '$.body', 'string') AS comment",
            "variant_get(node, '$.created', 'bigint') AS created",
            "variant_get(node, '$.score', 'bigint') AS votes")
        out = rows if out is None else out.unionByName(rows)
        nxt = level.selectExpr(
            "post_id", "variant_get(node, '$.id', 'string') AS parent_comment_id",
            "explode(variant_get(node, '$.replies', 'array<variant>')) AS node")
        nxt = cut_lineage(nxt)  # one depth per round; keep plans flat
        if nxt.isEmpty():
            break
        level = nxt
    return out


def write_dated(df: DataFrame, base: str, ingest_date: str, topic: str,
                fmt: str = "parquet", mode: str = "append") -> None:
    """Land a collection run under ``ingest_date=.../topic=...`` (the date is an
    argument, never the wall clock), so reruns of a day are addressable."""
    out = df.withColumns({"ingest_date": F.lit(ingest_date), "topic": F.lit(topic)})
    out.write.mode(mode).partitionBy("ingest_date", "topic").format(fmt).save(base)


def load_gazetteer(spark: SparkSession, paths, col: str = "entity_names") -> list[str]:
    """One-column CSV gazetteer(s) -> distinct terms (size-checked, bounded)."""
    from threadlens.operators.mentions import collect_terms
    df = spark.read.option("header", True).csv(paths).select(F.col(col).alias("term"))
    df = df.where(F.col("term").isNotNull()).distinct()
    return sorted(collect_terms(spark, df, "term"))


SEARCH_PAYLOAD = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StructType([T.StructField("videoId", T.StringType())])),
        T.StructField("snippet", T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("publishedAt", T.StringType()),
        ])),
    ]))),
])


def video_records(search_pages: DataFrame) -> DataFrame:
    """Search result pages -> (query, video_id, title, published_date, relevance)
    where relevance is the position in the result order (page, then item)."""
    items = search_pages.select("query", "page", F.posexplode("items").alias("pos", "it"))
    return items.select(
        "query", F.col("it.id.videoId").alias("video_id"),
        F.col("it.snippet.title").alias("title"),
        F.col("it.snippet.publishedAt").alias("published_date"),
        F.struct("page", "pos").alias("relevance"))


def enrich_with_videos(comments: DataFrame, videos: DataFrame,
                       n_comments: int | None = None) -> DataFrame:
    """Attach video title and post date to flattened comments (inner join on
    video_id). A video found by several queries or pages counts once: its first
    record by relevance, then query."""
    from threadlens.operators.joins import lookup_join
    from threadlens.operators.dedup import keep_first
    order = [c for c in ("relevance", "query", "title", "published_date") if c in videos.columns]
    v = keep_first(videos, ["video_id"], order).select(F.col("video_id").alias("_vid"), F.col("title").alias("video_title"),
                      F.col("published_date").alias("video_post_date"))
    return lookup_join(comments, v, "video_id", "_vid", "inner", n_left=n_comments).drop("_vid")


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Export with a header, quoting embedded newlines/quotes, keeping spaces."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))
