"""A third of all rows on one key: results equal with and without the hot split."""

from pyspark.sql import functions as F

import threadlens.operators.joins as jn
from threadlens.operators.threads import assign_levels, orphan_roots, thread_context
from threadlens.operators.unify import join_parent
from threadlens.sources.tables import table

SF = "/root/testdata/sf0.01"


def _skewed_forest(spark):
    """documents -> comments; every third comment replies to c1 (a viral
    comment), the rest form a normal forest."""
    d = table(spark, SF, "documents").select("doc_id", "text")
    i = F.col("doc_id")
    parent = (F.when(i == 0, F.lit(None).cast("string"))
              .when(i % 3 == 0, F.lit("c1"))
              .otherwise(F.concat(F.lit("c"), F.expr("doc_id div 2").cast("string"))))
    return d.select(F.concat(F.lit("c"), i.cast("string")).alias("comment_id"),
                    parent.alias("parent_comment_id"),
                    F.substring("text", 1, 0).alias("parent_comment"),   # '' (raw parent text)
                    F.col("text").alias("comment"), i.alias("doc_id"))


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_hot_parent_split_equals_plain(spark, monkeypatch):
    forest = _skewed_forest(spark)
    n = forest.count()
    hot = forest.where(F.col("parent_comment_id") == "c1").count()
    assert hot * 3 >= n - 3

    monkeypatch.setattr(jn, "MIN_HOT_ROWS", 10**12)           # never split
    plain_levels = _rows(assign_levels(forest), ["comment_id", "level", "unreachable"])
    plain_ctx = _rows(thread_context(assign_levels(forest).drop("unreachable"), order_col="doc_id"),
                      ["comment_id", "parent_comment", "comment_after_coref"])
    plain_par = _rows(join_parent(forest.drop("parent_comment")), ["comment_id", "parent_comment"])
    plain_orph = orphan_roots(forest).count()

    monkeypatch.setattr(jn, "MIN_HOT_ROWS", 10)               # split the viral parent
    jn.SPLITS.clear()
    assert _rows(assign_levels(forest), ["comment_id", "level", "unreachable"]) == plain_levels
    assert _rows(thread_context(assign_levels(forest).drop("unreachable"), order_col="doc_id"),
                 ["comment_id", "parent_comment", "comment_after_coref"]) == plain_ctx
    assert _rows(join_parent(forest.drop("parent_comment")), ["comment_id", "parent_comment"]) == plain_par
    assert orphan_roots(forest).count() == plain_orph
    assert any(k > 0 for k in jn.SPLITS)
