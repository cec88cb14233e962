"""Ingest queries: incremental append, gated top-k, recency, landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.operators.dedup import incremental_append
from threadlens.operators.relevance import B, K1, PRIOR, label_words, relevance
from threadlens.operators.topk import recent, recent_quota, relevance_top_k, sample_n
from threadlens.plans import register
from threadlens.schemas import POSTS_RAW
from threadlens.session import scratch_path
from threadlens.sources import landing
from threadlens.sources.fixtures import (
    RELEVANCE_TOPICS, v_comments, v_events_arriving, v_events_stored, v_posts, with_views,
)
from threadlens.sources.tables import table

APPEND_SQL = with_views("""
SELECT user_id, event_id, ts, event_type, value FROM v_events_stored
UNION ALL
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT a.*, row_number() OVER (PARTITION BY a.event_id ORDER BY a.ts, a.user_id) AS rn
  FROM v_events_arriving a
  WHERE NOT EXISTS (SELECT 1 FROM v_events_stored s WHERE s.event_id = a.event_id))
WHERE rn = 1""", "v_events_stored", "v_events_arriving")


@register("incremental_append", APPEND_SQL)
def incremental_append_q(spark, sf_dir):
    stored = v_events_stored(spark, sf_dir)
    arriving = v_events_arriving(spark, sf_dir)
    _, table_ = incremental_append(stored, arriving, "event_id", ["ts", "user_id"])
    return table_


def _relevance_ctes(source: str) -> dict[str, str]:
    """BM25 of (id, txt) rows for every label of RELEVANCE_TOPICS, then the softmax."""
    labels = [(t, k + 1, name, label_words(q)) for t, ls in RELEVANCE_TOPICS.items() for k, (name, q) in enumerate(ls.items())]

    def text(x):
        return "'" + x.replace("'", "''") + "'"

    label_rows = ", ".join(f"({text(t)}, {k}, {text(n)}, {0.0 if ws else PRIOR}::DOUBLE)" for t, k, n, ws in labels)
    term_rows = ", ".join(f"({text(t)}, {k}, {text(w)})" for t, k, _, ws in labels for w in ws)
    return {
        "src(id, txt)": source,
        "toks": r"SELECT id, regexp_extract_all(lower(coalesce(txt, '')), '[\p{L}\p{N}]+') AS ws FROM src",
        "label_rows(topic, pos, label, prior)": f"VALUES {label_rows}",
        "term_rows(topic, pos, term)": f"VALUES {term_rows}",
        "corpus": """SELECT count(*) FILTER (len(ws) > 0) AS n, sum(len(ws)) / count(*) FILTER (len(ws) > 0) AS mean FROM toks""",
        "rare": """SELECT term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf
       FROM (SELECT term, (SELECT count(*) FROM toks WHERE list_contains(ws, term)) AS df
             FROM (SELECT DISTINCT term FROM term_rows)), corpus""",
        "bm": f"""SELECT id, topic, pos, sum(idf * {K1 + 1} * tf / (tf + {K1} * ({1 - B} + {B} * len / mean))) AS bm
       FROM (SELECT id, topic, pos, idf, len(ws) AS len, len(list_filter(ws, lambda x: x = term))::DOUBLE AS tf
             FROM toks, term_rows JOIN rare USING (term)), corpus GROUP BY id, topic, pos""",
        "ev": """SELECT t.id, l.topic, l.pos, l.label, l.prior + coalesce(bm.bm, 0) AS e
       FROM toks t CROSS JOIN label_rows l LEFT JOIN bm ON bm.id = t.id AND bm.topic = l.topic AND bm.pos = l.pos""",
        "rel": """SELECT id, topic, pos, label, exp(e - top) / sum(exp(e - top)) OVER (PARTITION BY id, topic) AS score
       FROM (SELECT *, max(e) OVER (PARTITION BY id, topic) AS top FROM ev)""",
    }


def _by_label(df, id_col):
    """A row for each id, topic and label."""
    pairs = df.select(id_col, "topic", F.explode(F.arrays_zip("labels", "scores")).alias("x"))
    return pairs.select(id_col, "topic", F.col("x.labels").alias("label"), F.col("x.scores").alias("score"))


@register("relevance_scores", with_views("SELECT id AS post_id, topic, label, score FROM rel", "v_posts",
                                         extra=_relevance_ctes("SELECT post_id, post_title FROM v_posts")))
def relevance_scores(spark, sf_dir):
    """Every post title against every label of every topic."""
    posts = v_posts(spark, sf_dir).select("post_id", "post_title")
    return _by_label(relevance(posts, "post_title", RELEVANCE_TOPICS), "post_id")


@register("relevance_texts", with_views("SELECT id AS doc_id, topic, label, score FROM rel",
                                        extra=_relevance_ctes("SELECT doc_id, text FROM documents")))
def relevance_texts(spark, sf_dir):
    """Every whole text against every label of every topic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _by_label(relevance(docs, "text", RELEVANCE_TOPICS), "doc_id")


K_POSTS = 3                                                  # posts collected a topic, k + 10 examined


@register("relevance_topk", with_views(f"""
SELECT topic, post_id, CAST(rank AS INTEGER) AS rank, score FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY cand) AS rank FROM (
    SELECT r.topic, p.post_id, r.score,
           row_number() OVER (PARTITION BY r.topic ORDER BY p.votes DESC, p.post_id) AS cand
    FROM v_posts p JOIN rel r ON r.id = p.post_id WHERE r.pos = 1)
  WHERE cand <= {K_POSTS + 10} AND score >= 0.5)
WHERE rank <= {K_POSTS}""", "v_posts", extra=_relevance_ctes("SELECT post_id, post_title FROM v_posts")))
def relevance_topk(spark, sf_dir):
    """Per topic, the first posts by votes whose title is about the label sought."""
    posts = relevance(v_posts(spark, sf_dir).select("post_id", "post_title", "votes"), "post_title", RELEVANCE_TOPICS)
    sought = F.element_at("labels", 1)
    out = relevance_top_k(posts, "topic", "votes", "post_id", sought, k=K_POSTS, candidates=K_POSTS + 10)
    return out.select("topic", "post_id", "rank", F.element_at("scores", 1).alias("score"))


AS_OF_EVENTS = "2024-01-31 00:00:00"


@register("recent_filter", f"""
SELECT event_id, user_id, ts FROM events
WHERE ts >= TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 7 DAY""")
def recent_filter(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return recent(e, "ts", AS_OF_EVENTS, days=7)


AS_OF_VIDEOS = "2024-10-28 00:00:00"


def _videos(spark, sf_dir):
    p = v_posts(spark, sf_dir)
    return p.select(
        "post_id", "page_id",
        F.when(F.col("page_id") % 2 == 0, "Trump").otherwise("Kamala").alias("query"),
        F.to_date("created_utc", "d-MMM-yyyy").cast("timestamp_ntz").alias("published"))


@register("recent_quota", with_views(f"""
SELECT query, post_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY page_id) AS rank FROM (
    SELECT post_id, page_id, CASE WHEN page_id % 2 = 0 THEN 'Trump' ELSE 'Kamala' END AS query,
           CAST(CAST(strptime(created_utc, '%d-%b-%Y') AS DATE) AS TIMESTAMP) AS published
    FROM v_posts) v
  WHERE published >= TIMESTAMP '{AS_OF_VIDEOS}' - INTERVAL 7 DAY
    AND post_id IN (SELECT post_id FROM v_comments))
WHERE rank <= 5""", "v_comments"))
def recent_quota_q(spark, sf_dir):
    v = _videos(spark, sf_dir)
    c = v_comments(spark, sf_dir)
    out = recent_quota(v, c, "query", "post_id", "published", [F.col("page_id")],
                       AS_OF_VIDEOS, n=5)
    return out.select("query", "post_id", "rank")


@register("sample_n")
def sample_n_q(spark, sf_dir):
    """Seeded reproducible sample of 5 documents (hash differs from DuckDB's)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return sample_n(d, "doc_id", 5, seed=666)


_POST_COLS = "post_id, post_title, votes, created_utc, num_comments, post_body"


@register("consolidate", with_views(f"""
SELECT {_POST_COLS}, CASE WHEN page_id % 2 = 0 THEN 'Trump' ELSE 'Kamala' END AS search_type
FROM v_posts""", "v_posts"))
def consolidate_q(spark, sf_dir):
    """Land posts as per-topic CSV files (plus a 'test' file that must be
    skipped), then consolidate them with the header-drift check."""
    base = scratch_path(spark, "landing-csv")
    p = v_posts(spark, sf_dir)
    cols = [f.name for f in POSTS_RAW.fields]
    for name, cond in (("22102024_reddit_post_data_trump", F.col("page_id") % 2 == 0),
                       ("22102024_reddit_post_data_kamala", F.col("page_id") % 2 == 1),
                       ("22102024_reddit_post_data_test_trump", F.col("page_id") % 2 == 0)):
        (p.where(cond).select(*cols).write.option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{base}/{name}"))
    return landing.consolidate(spark, base, "_post_data_", POSTS_RAW).select(*cols, "search_type")


_EPOCH0 = 1727740800  # 2024-10-01T00:00:00Z


@register("post_records", f"""
SELECT 'p' || CAST(page_id AS VARCHAR) AS post_id,
       regexp_extract(html, '<title>(.*?)</title>', 1) AS post_title,
       CAST(page_id * 37 % 101 AS BIGINT) AS votes,
       strftime(DATE '1970-01-01' + CAST(({_EPOCH0} + page_id * 40000) // 86400 AS INTEGER), '%d-%b-%Y')
         AS created_utc,
       CAST(page_id % 7 AS BIGINT) AS num_comments,
       CASE WHEN page_id % 3 = 0 THEN regexp_extract(html, '<title>(.*?)</title>', 1) ELSE url END
         AS post_body
FROM pages""")
def post_records_q(spark, sf_dir):
    """Post payloads landed as JSON lines, scanned with a fixed schema."""
    pg = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    payload = pg.select(F.to_json(F.struct(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        title.alias("title"), ((F.col("page_id") * 37) % 101).cast("long").alias("score"),
        (F.lit(_EPOCH0) + F.col("page_id") * 40000).cast("long").alias("created"),
        (F.col("page_id") % 7).cast("long").alias("num_comments"),
        (F.col("page_id") % 3 == 0).alias("is_self"), title.alias("selftext"),
        F.col("url"))).alias("value"))
    path = scratch_path(spark, "landing-json")
    payload.write.text(path)
    landed = spark.read.schema(landing.POST_PAYLOAD).json(path)
    return landing.post_records(landed)


@register("flatten_threads", with_views("""
SELECT comment_id, parent_comment_id, comment, CAST(conv_id AS VARCHAR) AS post_id FROM v_turns""",
                                        "v_turns"))
def flatten_threads_q(spark, sf_dir):
    """Nested reply trees (VARIANT, one depth per round) back to flat rows."""
    from threadlens.sources.fixtures import v_thread_payloads
    flat = landing.flatten_threads(v_thread_payloads(spark, sf_dir))
    return flat.select("comment_id", "parent_comment_id", "comment", "post_id")


@register("flatten_replies", with_views("""
SELECT CAST(t.conv_id AS VARCHAR) AS video_id, t.comment_id, t.comment,
       CAST(length(t.comment) AS BIGINT) AS number_of_likes,
       CASE WHEN t.turn = 0 THEN 'N/A' ELSE p.comment END AS parent_comment,
       CASE WHEN t.turn = 0 THEN 'N/A' ELSE p.comment_id END AS parent_comment_id,
       '2024-10-01T00:00:' || lpad(CAST(t.turn AS VARCHAR), 2, '0') || 'Z' AS comment_date
FROM v_turns t JOIN v_turns p ON p.conv_id = t.conv_id AND p.turn = 0""", "v_turns"))
def flatten_replies_q(spark, sf_dir):
    """Two-level thread items -> flat rows; replies carry the top-level
    comment's id and text from the enclosing struct (no join)."""
    from threadlens.sources.fixtures import v_reply_items
    return landing.flatten_replies(v_reply_items(spark, sf_dir))
