"""Fixture views over the driver's tables, mapped onto the reference's
threaded-comment shapes. Each view is defined twice from the same rules: a
DataFrame builder (``v_*``) and a DuckDB CTE (``SQL_VIEWS``) used by the
oracles. Views derive structure from ids but never drop table rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.labels import sigmoid
from threadlens.session import staged
from threadlens.sources.tables import table

def _null_s():
    return F.lit(None).cast("string")
BASE_DAY = "2024-10-01"

# Fixture gazetteers (each holds redundant super-strings).
GAZETTEER_A = ["tionwh", "TionWhst", "andth"]
GAZETTEER_B = ["eding", "enthe", "Edings"]
# What entity and aspect add to the stand-in scorers' slots.
ENTITY_ASPECT = [[0.4 if i % 3 == e else -0.2 for i in range(13)] for e in range(3)]
ENTITY_SENTIMENT = [[0.31 if k == e else 0.0 for k in range(3)] for e in range(3)]
ASPECT_SENTIMENT = [[0.62 if k == a % 3 else 0.0 for k in range(3)] for a in range(14)]
# Second-opinion sentiment texts by vec_id % 4.
SECOND_SENTIMENT_TEXTS = ["sentiment: positive", "sentiment: neutral",
                          "sentiment: negative", "positive"]


# Candidate labels of two topics; the first of each is the one sought.
RELEVANCE_TOPICS = {
    "attion": {"about attion": "attion eriner and to", "about attion's kin": "thanea anea kin",
               "not about attion": ""},
    "heed": {"heed": "heed wher the of", "not heed": ""},
}


def _day_text(offset: Column, fmt: str) -> Column:
    return F.date_format(F.date_add(F.lit(BASE_DAY).cast("date"), offset.cast("int")), fmt)


def given_sql(given, k: str) -> str:
    """SQL of the weights that codes add to the 1-based slot ``k``; given: (code, rows) pairs."""
    return "(CAST(0 AS DOUBLE)" + "".join(
        f" + coalesce((CAST({rows} AS DOUBLE[][]))[{code} + 1][{k}], 0.0)" for code, rows in given) + ")"


def v_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    i = F.col("page_id")
    return p.select(
        F.concat(F.lit("p"), i.cast("string")).alias("post_id"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("post_title"),
        ((i * 37) % 101).cast("long").alias("votes"),
        _day_text(i % 28, "d-MMM-yyyy").alias("created_utc"),
        (i % 7).cast("long").alias("num_comments"),
        F.col("url").alias("post_body"),
        i.alias("page_id"),
    )


def _comment_text(i: Column, text: Column) -> Column:
    return (F.when(i % 7 == 0, F.concat(text, F.lit(" https://ex.org/"), i.cast("string"),
                                        F.lit(" tail")))
            .when(i % 7 == 1, F.concat(F.lit("“"), text, F.lit("” – it’s…")))
            .when(i % 7 == 2, F.concat(text, F.lit("\u00adx\u200by")))
            .when(i % 7 == 3, F.concat(text, F.lit("\u0085\tz")))
            .when(i % 7 == 4, F.concat(text, F.lit(" &amp; &lt;b&gt; &#39;q&#39;")))
            .otherwise(text))


# Ids of the comments without text that v_comments adds: NULL ones, 'N/A' ones.
NO_TEXT_IDS, NA_TEXT_IDS = 1_000_000_000_000, 2_000_000_000_000


def v_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment forest from ``documents`` (+ post titles from ``pages``): every document's
    text is a comment; replies without text (NULL, 'N/A') come on top, and some
    comments answer a NULL one."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    i = F.col("doc_id")
    up = F.expr("(doc_id div 8) * 2 + doc_id % 2")
    # replies stay on their parent's platform (parity of the id); 1 would be its own parent
    parent = (F.when((i % 5 == 0) | (i == 1), _null_s())
              .when(i % 17 == 3, F.concat(F.lit("gone"), i.cast("string")))
              .when((up % 13 == 0) & (i % 3 == 0), F.concat(F.lit("x"), up.cast("string")))
              .otherwise(F.concat(F.lit("c"), up.cast("string"))))
    iso = F.concat(_day_text(i % 28, "yyyy-MM-dd"), F.lit("T"),
                   F.lpad((i % 24).cast("string"), 2, "0"), F.lit(":"),
                   F.lpad((i % 60).cast("string"), 2, "0"), F.lit(":00Z"))
    c = d.select(
        i.alias("doc_id"),
        F.concat(F.lit("c"), i.cast("string")).alias("comment_id"),
        parent.alias("parent_comment_id"),
        F.concat(F.lit("p"), (i % 40).cast("string")).alias("post_id"),
        F.when(i % 2 == 0, "Reddit").otherwise("Youtube").alias("platform"),
        F.col("n_chars").alias("number_of_comment_votes"),
        _comment_text(i, F.col("text")).alias("comment"),
        F.col("lang"),
        F.when(i % 2 == 0, _day_text(i % 28, "d-MMM-yyyy")).otherwise(iso)
        .alias("comment_timestamp"),
    )

    def without_text(rows, ids, prefix, comment):
        return c.where(rows).withColumns({
            "doc_id": i + F.lit(ids), "parent_comment_id": F.col("comment_id"), "comment": comment,
            "comment_id": F.concat(F.lit(prefix), i.cast("string"))})

    c = (c.unionByName(without_text(i % 13 == 0, NO_TEXT_IDS, "x", _null_s()))
          .unionByName(without_text(i % 11 == 5, NA_TEXT_IDS, "y", F.lit("N/A"))))
    titles = v_posts(spark, sf_dir).select("post_id", "post_title", "created_utc")
    return c.join(named_posts(titles, c), "post_id", "left")


def named_posts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """The posts that comments name, as a stage table: when they are few, Spark
    broadcasts them, and the comments' texts are not shuffled by post."""
    return staged(posts.join(comments.select("post_id").distinct(), "post_id", "left_semi"), "posts")


def v_reddit_comments_raw(spark, sf_dir) -> DataFrame:
    c = v_comments(spark, sf_dir).where(F.col("platform") == "Reddit")
    return c.select(
        F.col("post_title").alias("Post Title"), F.col("post_id").alias("Post ID"),
        F.col("comment_id").alias("Comment ID"),
        F.col("comment_timestamp").alias("Timestamp"),
        F.col("number_of_comment_votes").alias("Votes"),
        F.col("comment").alias("Comment"),
        F.col("parent_comment_id").alias("Parent Comment ID"),
        F.col("doc_id").alias("_order"), F.col("lang"))


def v_reddit_posts_raw(spark, sf_dir) -> DataFrame:
    return v_posts(spark, sf_dir).select(
        "post_id", "post_title", "votes", "created_utc", "num_comments", "post_body",
        F.col("page_id").alias("_order"))


def v_youtube_comments_raw(spark, sf_dir) -> DataFrame:
    allc = v_comments(spark, sf_dir)
    y = allc.where(F.col("platform") == "Youtube")
    parents = allc.select(F.col("comment_id").alias("parent_comment_id"),
                          F.col("comment").alias("_ptext"))
    y = y.join(parents, "parent_comment_id", "left")
    post_iso = F.concat(
        F.date_format(F.try_to_date("created_utc", "d-MMM-yyyy"), "yyyy-MM-dd"),
        F.lit("T08:30:00Z"))
    return y.select(
        F.col("post_title").alias("video_title"), F.col("post_id").alias("video_id"),
        F.col("comment"), F.col("comment_id"),
        F.col("number_of_comment_votes").alias("number_of_likes"),
        F.when(F.col("parent_comment_id").isNull(), "N/A")
        .otherwise(F.coalesce(F.col("_ptext"), F.lit("N/A"))).alias("parent_comment"),
        F.coalesce(F.col("parent_comment_id"), F.lit("N/A")).alias("parent_comment_id"),
        F.col("comment_timestamp").alias("comment_date"),
        post_iso.alias("video_post_date"),
        F.col("doc_id").alias("_order"), F.col("lang"))


def v_turns(spark, sf_dir) -> DataFrame:
    """Conversation chains: each turn replies to the previous turn."""
    c = table(spark, sf_dir, "conversations")
    cid = F.col("conv_id").cast("string")
    return c.select(
        F.concat(cid, F.lit("-"), F.col("turn").cast("string")).alias("comment_id"),
        F.when(F.col("turn") > 0,
               F.concat(cid, F.lit("-"), (F.col("turn") - 1).cast("string")))
        .alias("parent_comment_id"),
        F.col("text").alias("comment"), "conv_id", "turn", "role")


def v_sentence_docs(spark, sf_dir) -> DataFrame:
    """Documents of all languages, control characters stripped (sentence input)."""
    from threadlens.functions.text import strip_control
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", strip_control("text").alias("comment"))


def v_scores(spark, sf_dir) -> DataFrame:
    """Linear-on-vector scores from ``embeddings`` (see scorer contract)."""
    e = table(spark, sf_dir, "embeddings")
    v = F.transform("embedding", lambda x: x.cast("double")).alias("e")
    e = e.select("vec_id", v)
    ev = F.col("e")
    return e.select(
        "vec_id", "e",
        F.transform(F.sequence(F.lit(0), F.lit(2)),
                    lambda i: sigmoid(F.lit(12.0) * ev[i])).alias("entity_probs"),
        F.transform(F.sequence(F.lit(3), F.lit(15)),
                    lambda i: sigmoid(F.lit(12.0) * ev[i] - F.lit(3.0))).alias("aspect_probs"),
        F.transform(F.sequence(F.lit(16), F.lit(18)),
                    lambda i: F.lit(6.0) * ev[i]).alias("first_logits"),
        (F.lit(-6.0) * F.abs(ev[19])).alias("second_conf"),
        F.element_at(F.array(*[F.lit(t) for t in SECOND_SENTIMENT_TEXTS]),
                     (F.col("vec_id") % 4 + 1).cast("int")).alias("second_text"),
    )


# Append fixture: events landed before STORED_BEFORE are stored; the arriving
# batch re-delivers everything from ARRIVING_FROM on (an overlap window with
# changed values) plus the new events. Together they cover every event.
STORED_BEFORE = "2024-01-20 00:00:00"
ARRIVING_FROM = "2024-01-15 00:00:00"


def v_events_stored(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.where(F.col("ts") < F.lit(STORED_BEFORE).cast("timestamp_ntz")).select(
        "user_id", "event_id", "ts", "event_type", "value")


def v_events_arriving(spark, sf_dir) -> DataFrame:
    """Arriving batch; overlaps stored rows with a changed ``value``."""
    e = table(spark, sf_dir, "events")
    return e.where(F.col("ts") >= F.lit(ARRIVING_FROM).cast("timestamp_ntz")).select(
        "user_id", "event_id", "ts", "event_type",
        (F.col("value") + F.lit(1.0)).alias("value"))


# --------------------------------------------------------------------------
# The same views as DuckDB CTEs (tables are pre-registered views).
# --------------------------------------------------------------------------

def _sql_day(offset_sql: str, fmt: str) -> str:
    return f"strftime(DATE '{BASE_DAY}' + CAST({offset_sql} AS INTEGER), '{fmt}')"


_COMMENT_SQL = """CASE WHEN d.doc_id % 7 = 0 THEN d.text || ' https://ex.org/' || CAST(d.doc_id AS VARCHAR) || ' tail'
       WHEN d.doc_id % 7 = 1 THEN '“' || d.text || '” – it’s…'
       WHEN d.doc_id % 7 = 2 THEN d.text || chr(173) || 'x' || chr(8203) || 'y'
       WHEN d.doc_id % 7 = 3 THEN d.text || chr(133) || chr(9) || 'z'
       WHEN d.doc_id % 7 = 4 THEN d.text || ' &amp; &lt;b&gt; &#39;q&#39;'
       ELSE d.text END"""

SQL_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_posts": ((), f"""
SELECT 'p' || CAST(page_id AS VARCHAR) AS post_id,
       regexp_extract(html, '<title>(.*?)</title>', 1) AS post_title,
       CAST(page_id * 37 % 101 AS BIGINT) AS votes,
       {_sql_day('page_id % 28', '%-d-%b-%Y')} AS created_utc,
       CAST(page_id % 7 AS BIGINT) AS num_comments,
       url AS post_body,
       page_id
FROM pages"""),
    "v_comments": (("v_posts",), f"""
SELECT c.*, t.post_title, t.created_utc FROM (
WITH own AS (
SELECT d.doc_id,
       'c' || CAST(d.doc_id AS VARCHAR) AS comment_id,
       CASE WHEN d.doc_id % 5 = 0 OR d.doc_id = 1 THEN NULL
            WHEN d.doc_id % 17 = 3 THEN 'gone' || CAST(d.doc_id AS VARCHAR)
            WHEN ((d.doc_id // 8) * 2 + d.doc_id % 2) % 13 = 0 AND d.doc_id % 3 = 0
            THEN 'x' || CAST((d.doc_id // 8) * 2 + d.doc_id % 2 AS VARCHAR)
            ELSE 'c' || CAST((d.doc_id // 8) * 2 + d.doc_id % 2 AS VARCHAR) END AS parent_comment_id,
       'p' || CAST(d.doc_id % 40 AS VARCHAR) AS post_id,
       CASE WHEN d.doc_id % 2 = 0 THEN 'Reddit' ELSE 'Youtube' END AS platform,
       d.n_chars AS number_of_comment_votes,
       {_COMMENT_SQL} AS comment,
       d.lang,
       CASE WHEN d.doc_id % 2 = 0 THEN {_sql_day('d.doc_id % 28', '%-d-%b-%Y')}
            ELSE {_sql_day('d.doc_id % 28', '%Y-%m-%d')} || 'T'
                 || lpad(CAST(d.doc_id % 24 AS VARCHAR), 2, '0') || ':'
                 || lpad(CAST(d.doc_id % 60 AS VARCHAR), 2, '0') || ':00Z' END
         AS comment_timestamp
FROM documents d)
SELECT * FROM own
UNION ALL SELECT * REPLACE (doc_id + {NO_TEXT_IDS} AS doc_id, comment_id AS parent_comment_id,
       CAST(NULL AS VARCHAR) AS comment, 'x' || CAST(doc_id AS VARCHAR) AS comment_id) FROM own WHERE doc_id % 13 = 0
UNION ALL SELECT * REPLACE (doc_id + {NA_TEXT_IDS} AS doc_id, comment_id AS parent_comment_id,
       'N/A' AS comment, 'y' || CAST(doc_id AS VARCHAR) AS comment_id) FROM own WHERE doc_id % 11 = 5
) c LEFT JOIN v_posts t ON c.post_id = t.post_id"""),
    "v_reddit_comments_raw": (("v_comments",), """
SELECT post_title AS "Post Title", post_id AS "Post ID", comment_id AS "Comment ID",
       comment_timestamp AS "Timestamp", number_of_comment_votes AS "Votes",
       comment AS "Comment", parent_comment_id AS "Parent Comment ID",
       doc_id AS _order, lang
FROM v_comments WHERE platform = 'Reddit'"""),
    "v_reddit_posts_raw": (("v_posts",), """
SELECT post_id, post_title, votes, created_utc, num_comments, post_body, page_id AS _order
FROM v_posts"""),
    "v_youtube_comments_raw": (("v_comments",), """
SELECT y.post_title AS video_title, y.post_id AS video_id, y.comment, y.comment_id,
       y.number_of_comment_votes AS number_of_likes,
       CASE WHEN y.parent_comment_id IS NULL THEN 'N/A' ELSE coalesce(p.comment, 'N/A') END
         AS parent_comment,
       coalesce(y.parent_comment_id, 'N/A') AS parent_comment_id,
       y.comment_timestamp AS comment_date,
       strftime(strptime(y.created_utc, '%d-%b-%Y'), '%Y-%m-%d') || 'T08:30:00Z' AS video_post_date,
       y.doc_id AS _order, y.lang
FROM v_comments y LEFT JOIN v_comments p ON y.parent_comment_id = p.comment_id
WHERE y.platform = 'Youtube'"""),
    "v_turns": ((), """
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS comment_id,
       CASE WHEN turn > 0 THEN CAST(conv_id AS VARCHAR) || '-' || CAST(turn - 1 AS VARCHAR) END
         AS parent_comment_id,
       text AS comment, conv_id, turn, role
FROM conversations"""),
    "v_sentence_docs": ((), r"""
SELECT doc_id, regexp_replace(text, '[\x00-\x1f\x7f-\x9f]', '', 'g') AS comment
FROM documents"""),
    "v_scores": ((), """
SELECT vec_id, e,
       list_transform([1, 2, 3], lambda i: 1.0 / (1.0 + exp(-(12.0 * e[i])))) AS entity_probs,
       list_transform(range(4, 17), lambda i: 1.0 / (1.0 + exp(-(12.0 * e[i] - 3.0)))) AS aspect_probs,
       list_transform([17, 18, 19], lambda i: 6.0 * e[i]) AS first_logits,
       -6.0 * abs(e[20]) AS second_conf,
       (['sentiment: positive', 'sentiment: neutral', 'sentiment: negative', 'positive'])[vec_id % 4 + 1]
         AS second_text
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"""),
    "v_events_stored": ((), f"""
SELECT user_id, event_id, ts, event_type, value FROM events
WHERE ts < TIMESTAMP '{STORED_BEFORE}'"""),
    "v_events_arriving": ((), f"""
SELECT user_id, event_id, ts, event_type, value + 1.0 AS value FROM events
WHERE ts >= TIMESTAMP '{ARRIVING_FROM}'"""),
}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None,
               recursive: bool = False) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in SQL_VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    ctes = [f"{n} AS ({SQL_VIEWS[n][1].strip()})" for n in order]
    for k, v in (extra or {}).items():
        ctes.append(f"{k} AS ({v.strip()})")
    if not ctes:
        return body.strip()
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(ctes) + "\n" + body.strip()


def v_thread_payloads(spark, sf_dir) -> DataFrame:
    """Conversation chains landed as nested reply trees, one JSON payload per
    conversation: ``{"comments": [{"id", "body", "created", "score",
    "replies": [...]}]}``. Built bottom-up with one join per depth (each turn
    has at most one reply, so no grouping is needed)."""
    from threadlens.session import cut_lineage
    t = v_turns(spark, sf_dir)
    max_turn = t.agg(F.max("turn")).first()[0]           # one value
    nodes = None
    for depth in range(int(max_turn), -1, -1):
        level = t.where(F.col("turn") == depth).select("conv_id", "comment_id", "comment", "turn")
        if nodes is not None:
            level = level.join(nodes.withColumnRenamed("node", "_child"), "conv_id", "left")
            replies = F.when(F.col("_child").isNull(), F.array().cast("array<variant>")) \
                       .otherwise(F.array(F.col("_child")))
        else:
            replies = F.array().cast("array<variant>")
        node = F.to_variant_object(F.struct(
            F.col("comment_id").alias("id"), F.col("comment").alias("body"),
            F.col("turn").alias("created"), F.length("comment").cast("long").alias("score"),
            replies.alias("replies")))
        nodes = cut_lineage(level.select("conv_id", node.alias("node")))
    payload = F.to_json(F.to_variant_object(F.struct(F.array(F.col("node")).alias("comments"))))
    return nodes.select(F.col("conv_id").cast("string").alias("post_id"), payload.alias("payload"))


def v_reply_items(spark, sf_dir) -> DataFrame:
    """Conversations landed as two-level thread items (turn 0 is the top-level
    comment, later turns its replies), in the shape of ``landing.THREAD_ITEM``.
    Replies are appended one turn per round by a join on the conversation, so
    no group is collected."""
    from threadlens.session import cut_lineage
    t = v_turns(spark, sf_dir)

    def snippet(prefix=""):
        return F.struct(F.col("comment").alias("textDisplay"),
                        F.length("comment").cast("long").alias("likeCount"),
                        F.concat(F.lit("2024-10-01T00:00:"),
                                 F.lpad(F.col("turn").cast("string"), 2, "0"),
                                 F.lit("Z")).alias("publishedAt"))
    top = t.where(F.col("turn") == 0).select(
        "conv_id", F.struct(F.col("comment_id").alias("id"), snippet().alias("snippet")).alias("top"),
        F.array().cast("array<struct<id:string,snippet:struct<textDisplay:string,"
                       "likeCount:bigint,publishedAt:string>>>").alias("replies"))
    max_turn = t.agg(F.max("turn")).first()[0]           # one value
    items = cut_lineage(top)
    for turn in range(1, int(max_turn or 0) + 1):
        reply = t.where(F.col("turn") == turn).select(
            "conv_id", F.struct(F.col("comment_id").alias("id"), snippet().alias("snippet")).alias("_r"))
        items = cut_lineage(items.join(reply, "conv_id", "left").select(
            "conv_id", "top", F.when(F.col("_r").isNull(), F.col("replies"))
            .otherwise(F.concat("replies", F.array("_r"))).alias("replies")))
    return items.select(
        F.col("conv_id").cast("string").alias("video_id"),
        F.struct(F.col("top").alias("topLevelComment"),
                 F.size("replies").cast("long").alias("totalReplyCount")).alias("snippet"),
        "replies")
