"""Scoring stages, observations, dated landing, BOM CSV."""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.operators import absa as ab
from threadlens.operators.clean import observe_parent_na
from threadlens.operators.scoring import external, lexicon, linear_slots


def test_external_scorer_batches(spark):
    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            assert len(x) <= 32
            return x * 2.0
        return predict
    sc = external("y", make, ["x"], T.DoubleType(), batch_size=32)
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    out = sc(df)
    assert out.agg(F.sum("y")).first()[0] == 2.0 * sum(range(100))


def test_linear_and_lexicon_scorers(spark):
    df = spark.createDataFrame([([0.0, 1.0], "Great job!")], "e array<float>, s string")
    r = linear_slots("e", "p", [0, 1], 2.0, link="identity")(df).first()
    assert r.p == [0.0, 2.0]
    lx = lexicon("s", "q", {"pos": {"great": 1.0, "bad": -1.0}}, ["pos"], link="identity")(df).first()
    assert lx.q == [1.0]


def test_observe_parent_na(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("c", None)],
                               "comment_id string, parent_comment string")
    df2, obs = observe_parent_na(df)
    df2.write.format("noop").mode("overwrite").save()
    assert obs.get["num_na"] == 2


def test_observe_unknown(spark):
    df = spark.createDataFrame([("policies; foo",), ("bar",), (None,)], "aspect_second_text string")
    df2, obs = ab.observe_unknown_labels(df)
    df2.collect()
    assert obs.get["n_unknown"] == 2


def test_write_dated(spark, tmp_path):
    from threadlens.sources.landing import write_dated
    df = spark.createDataFrame([("p1",)], "post_id string")
    write_dated(df, str(tmp_path), "22102024", "trump")
    back = spark.read.parquet(str(tmp_path))
    r = back.first()
    assert (r.post_id, str(r.ingest_date), r.topic) == ("p1", "22102024", "trump")


def test_bom_csv(spark, tmp_path):
    from threadlens.schemas import POSTS_RAW
    from threadlens.sources.landing import read_landed_csv
    body = "post_id,post_title,votes,created_utc,num_comments,post_body\np1,\"a, \"\"q\"\"\nline\",1,4-Oct-2024,2,NA\n"
    (tmp_path / "f.csv").write_bytes(b"\xef\xbb\xbf" + body.encode("utf-8"))
    r = read_landed_csv(spark, str(tmp_path / "f.csv"), POSTS_RAW).first()
    assert r.post_id == "p1" and r.post_title == 'a, "q"\nline' and r.post_body is None


def test_bucketed_append_prunes_and_is_idempotent(spark, tmp_path):
    from threadlens.operators.dedup import incremental_append, key_bucket
    path = str(tmp_path / "stored")
    stored = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    stored.withColumn("_b", key_bucket("k", 16)).write.partitionBy("_b").parquet(path)
    table = spark.read.parquet(path)
    arriving = spark.createDataFrame([(5, "new"), (2000, "x")], "k long, v string") \
        .withColumn("_b", key_bucket("k", 16))
    fresh, _ = incremental_append(table, arriving.select(*table.columns), "k", ["v"], bucket_col="_b")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_b" in plan or "_b IN" in plan or "PartitionFilters: [_b" in plan
    assert [r.k for r in fresh.collect()] == [2000]
    fresh.write.mode("append").partitionBy("_b").parquet(path)
    again, _ = incremental_append(spark.read.parquet(path), arriving.select(*table.columns), "k",
                                  ["v"], bucket_col="_b")
    assert again.count() == 0
