"""Decisions depend on entity and aspect, not on the sentence alone."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_sentiment_differs_between_aspects(spark):
    from threadlens.plans.q_opinions import sentence_decisions
    d = sentence_decisions(spark, SF)
    two = (d.groupBy("doc_id", "sentence_idx", "entity_category")
           .agg(F.count_distinct("final_sentiment_prediction").alias("n")).where("n > 1"))
    assert two.count() > 0


def test_given_weights_and_unknown_codes(spark):
    from threadlens.operators.scoring import lexicon
    df = spark.createDataFrame([("a!", 0), ("a!", 1), ("", 7), (None, None)], "t string, code int")
    s = lexicon("t", "z", {"x": {"!": 1.0}}, ["x", "y"], link="identity",
                given={"code": [[0.5, 0.0], [0.0, 2.0]]})
    assert [r.z for r in s(df).collect()] == [[1.5, 0.0], [1.0, 2.0], [0.0, 0.0], [0.0, 0.0]]
