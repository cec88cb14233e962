"""Plan-shape guards for the scale properties claimed in the README."""

from pyspark.sql import functions as F

from threadlens.operators.dedup import keep_first
from threadlens.operators.mentions import contains_any
from threadlens.operators.sentences import split_sentences
from threadlens.sources.fixtures import GAZETTEER_A
from threadlens.sources.tables import table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_combines_map_side(spark):
    d = table(spark, SF, "documents").select("doc_id", "text", "lang")
    p = plan(keep_first(d, ["text"], ["doc_id"]))
    assert "partial_min_by" in p and "Window" not in p


def test_topk_limits_before_shuffle(spark):
    from threadlens.plans import QUERIES, load_all
    load_all()
    p = plan(QUERIES["relevance_topk"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_language_filter_shuffles_nothing(spark):
    from threadlens.plans import QUERIES, load_all
    load_all()
    p = plan(QUERIES["lang_filter"](spark, SF))
    assert "ArrowEvalPython" in p and "Exchange" not in p and "Join" not in p


def test_sentences_and_mentions_stay_native_without_shuffle(spark):
    d = table(spark, SF, "documents").select("doc_id", F.col("text").alias("comment"))
    for df in (split_sentences(d), d.select(contains_any("comment", GAZETTEER_A))):
        p = plan(df)
        assert "Exchange" not in p and "EvalPython" not in p


def test_language_filter_below_python_udf(spark):
    from threadlens.operators.clean import clean_comments, stored_label_gate
    from threadlens.plans.common import unified
    p = plan(clean_comments(unified(spark, SF), stored_label_gate()))
    # every Python evaluation sits above a filter on the stored language label
    head, _, tail = p.partition("ArrowEvalPython")
    assert "ArrowEvalPython" in p and "(lang" in tail and "= en)" in tail
