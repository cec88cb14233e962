"""Thread structure queries: orphans, levels, context propagation, full clean."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.operators.clean import clean_comments, stored_label_gate
from threadlens.operators.threads import assign_levels, orphan_roots, thread_context
from threadlens.plans import register
from threadlens.plans.common import ctes, gated_comments, present_comments, unified
from threadlens.plans.q_text import PUNCT_END_SQL
from threadlens.schemas import UNIFIED_COLUMNS
from threadlens.sources.fixtures import GAZETTEER_A, GAZETTEER_B, v_comments, v_turns, with_views

def _lv(src: str) -> dict[str, str]:
    """Recursive CTE: level 1 for roots/orphans, parent level + 1 below."""
    return {"lv(comment_id, level)": f"""
  SELECT comment_id, 1 FROM {src}
  WHERE parent_comment_id IS NULL OR parent_comment_id NOT IN (SELECT comment_id FROM {src})
  UNION ALL
  SELECT c.comment_id, lv.level + 1 FROM {src} c JOIN lv ON c.parent_comment_id = lv.comment_id"""}


@register("orphan_roots", with_views("""
SELECT comment_id, parent_comment_id FROM gated
WHERE parent_comment_id IS NOT NULL AND parent_comment_id NOT IN (SELECT comment_id FROM gated)""",
                                     "v_comments", extra=ctes("gated")))
def orphan_roots_q(spark, sf_dir):
    return orphan_roots(gated_comments(spark, sf_dir)).select("comment_id", "parent_comment_id")


@register("thread_levels", with_views("""
SELECT g.comment_id, lv.level, lv.level IS NULL AS unreachable
FROM gated g LEFT JOIN lv ON g.comment_id = lv.comment_id""",
                                      "v_comments", extra={**ctes("gated"), **_lv("gated")},
                                      recursive=True))
def thread_levels(spark, sf_dir):
    return assign_levels(gated_comments(spark, sf_dir)).select("comment_id", "level", "unreachable")


@register("chain_levels", with_views("""
SELECT t.comment_id, t.turn, lv.level, lv.level IS NULL AS unreachable
FROM v_turns t LEFT JOIN lv ON t.comment_id = lv.comment_id""",
    "v_turns", extra=_lv("v_turns"), recursive=True))
def chain_levels(spark, sf_dir):
    """Conversation chains (up to 8 deep): level must equal turn + 1."""
    t = v_turns(spark, sf_dir)
    return assign_levels(t).select("comment_id", "turn", "level", "unreachable")


def context_input(spark, sf_dir):
    g = gated_comments(spark, sf_dir)
    parents = v_comments(spark, sf_dir).select(F.col("comment_id").alias("_pid"),
                                               F.col("comment").alias("_ptext"))
    g = g.join(parents, F.col("parent_comment_id") == F.col("_pid"), "left")
    return g.withColumn("parent_comment", F.coalesce("_ptext", F.lit(""))).drop("_pid", "_ptext")


def placed(*names):
    """Rows on a cycle have no level: they stay, without context."""
    return [F.when(F.col("level").isNotNull(), F.col(c)).alias(c) if c == "parent_comment" else F.col(c)
            for c in names]


def _recover(x):
    return f"coalesce(string_split({x}, '[NEXT_COMMENT] ')[2], {x})"


def _concat(p, c):
    return (f"{p} || CASE WHEN regexp_matches({p}, '{PUNCT_END_SQL}') THEN '' ELSE '.' END "
            f"|| ' [NEXT_COMMENT] ' || {c}")


_CTX_CTES = {
    **ctes("gated"),
    "ci": """SELECT g.comment_id, g.parent_comment_id, g.comment, g.doc_id,
       coalesce(p.comment, '') AS parent_comment
       FROM gated g LEFT JOIN v_comments p ON g.parent_comment_id = p.comment_id""",
    **_lv("ci"),
    "cl": "SELECT ci.*, lv.level FROM ci JOIN lv ON ci.comment_id = lv.comment_id",
    "ctx(comment_id, level, parent_comment, resolved)": f"""
  SELECT comment_id, level, parent_comment, {_recover(_concat('parent_comment', 'comment'))}
  FROM cl WHERE level = 1
  UNION ALL
  SELECT comment_id, level, pc, {_recover(_concat('pc', 'comment'))} FROM (
    SELECT c.comment_id, c.level, c.comment,
           CASE WHEN coalesce(c.parent_comment <> '[deleted]', true)
                THEN coalesce(p.resolved, '') ELSE c.parent_comment END AS pc
    FROM cl c JOIN ctx p ON c.parent_comment_id = p.comment_id AND c.level = p.level + 1)""",
}


CONTEXT_SQL = with_views("""
SELECT comment_id, level, parent_comment, resolved AS comment_after_coref FROM ctx
UNION ALL SELECT comment_id, NULL, NULL, NULL FROM ci WHERE comment_id NOT IN (SELECT comment_id FROM lv)""",
                         "v_comments", extra=_CTX_CTES, recursive=True)


@register("thread_context", CONTEXT_SQL)
def thread_context_q(spark, sf_dir):
    c = assign_levels(context_input(spark, sf_dir))
    out = thread_context(c, order_col="doc_id")
    return out.select(*placed(
        "comment_id", "level", "parent_comment", "comment_after_coref"))


@register("clean")
def clean_q(spark, sf_dir):
    """Full cleaning chain (HTML unescape + NFC in one Arrow UDF); rows-only check."""
    u = unified(spark, sf_dir)
    return clean_comments(u, stored_label_gate()).select(*UNIFIED_COLUMNS, "platform")


def comment_level(spark, sf_dir):
    """Flagship comment table: unify -> clean -> levels -> context -> flags."""
    from threadlens import jobs
    out = jobs.comment_level(unified(spark, sf_dir), stored_label_gate(),
                             {"contains_a_mentions": GAZETTEER_A,
                              "contains_b_mentions": GAZETTEER_B})
    return out.drop("lang", "_order", "unreachable")


register("comment_level")(comment_level)


@register("mention_rewrite")
def mention_rewrite_q(spark, sf_dir):
    """Rule clusters + exact rewrite on every comment, whatever its language (rows-only check)."""
    from threadlens.operators.rewrite import rule_rewrite
    g = present_comments(spark, sf_dir)
    rw = rule_rewrite(GAZETTEER_A + GAZETTEER_B)
    return g.select("comment_id", rw(F.col("comment")).alias("comment_rewritten"))


@register("thread_context_rewrite")
def thread_context_rewrite_q(spark, sf_dir):
    """Level-ordered context with the mention rewrite inside the loop."""
    from threadlens.operators.rewrite import rule_rewrite
    c = assign_levels(context_input(spark, sf_dir))
    out = thread_context(c, rewrite=rule_rewrite(GAZETTEER_A + GAZETTEER_B), order_col="doc_id")
    return out.select(*placed(
        "comment_id", "level", "parent_comment", "comment_after_coref"))


@register("clean_langid")
def clean_langid_q(spark, sf_dir):
    """Cleaning chain gated by the language model trained as a Spark job
    (word naive Bayes on ``documents.lang``) instead of a stored label."""
    from threadlens.functions.text import lang_text
    from threadlens.operators.clean import ModelGate
    from threadlens.operators.langid import train_word_nb
    from threadlens.sources.tables import table
    d = table(spark, sf_dir, "documents").select("text", "lang")
    model = train_word_nb(d.withColumn("lt", lang_text("text")), "lt", "lang")
    u = unified(spark, sf_dir)
    return clean_comments(u, ModelGate(model)).select(*UNIFIED_COLUMNS, "platform")
