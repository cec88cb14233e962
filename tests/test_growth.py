"""What a query writes and holds must grow no faster than its input."""

import os
import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from threadlens import jobs
from threadlens.operators.clean import ModelGate, clean_comments
from threadlens.operators.langid import predict_word_nb, train_word_nb
from threadlens.operators.langprofiles import _counts, train_profiles
from threadlens.session import ensure_checkpoint_dir, scratch_path
from threadlens.streaming.threads import ThreadTables, stream_threads

UNIFIED = ("post_id string, post_title string, post_timestamp timestamp, parent_comment_id string, parent_comment string, "
           "comment_id string, comment string, comment_timestamp timestamp, number_of_comment_votes long, platform string, "
           "lang string, _order long")


def _bytes(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(base) for f in files)


def _comments(spark, n=60, words=4000):
    """Comments of about 24 kB, each an answer to the one of half its number."""
    text = F.concat(F.repeat(F.concat(F.lit("alpha beta "), F.col("id").cast("string"), F.lit(" the ")), words // 3))
    up = F.when(F.col("id") > 1, F.concat(F.lit("c"), F.floor(F.col("id") / 2).cast("string")))
    return (spark.range(1, n + 1, 1, 2)
            .select(F.lit("p").alias("post_id"), F.lit("t").alias("post_title"), F.lit(None).cast("timestamp").alias("post_timestamp"),
                    up.alias("parent_comment_id"), text.alias("parent_comment"),
                    F.concat(F.lit("c"), F.col("id").cast("string")).alias("comment_id"), text.alias("comment"),
                    F.lit(None).cast("timestamp").alias("comment_timestamp"), F.lit(1).cast("long").alias("number_of_comment_votes"),
                    F.lit("Reddit").alias("platform"), F.lit("en").alias("lang"), F.col("id").alias("_order")))


def _model(spark):
    return train_word_nb(spark.createDataFrame([("alpha beta the", "en"), ("uno due", "it")], "text string, lang string"),
                         "text", "lang")


def test_stream_tables_have_no_file_for_each_task_and_bucket(spark):
    base = scratch_path(spark, "growth")
    c = _comments(spark, 400, 30).repartition(16).cache()
    c.write.parquet(f"{base}/landing")
    tables = ThreadTables(f"{base}/tables", c.schema, buckets=8)
    before = _bytes(spark)
    stream_threads(spark, f"{base}/landing", tables, f"{base}/ck", ["_order"]).awaitTermination()
    assert _bytes(spark) > before
    for name in ("edges", "rows"):
        root = f"{base}/tables/{name}/epoch=0".removeprefix("file:")
        files = [f for _, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]
        assert 0 < len(files) <= 8
    assert tables.read(spark, "rows", 1).where("level is not null").count() == 400


def test_model_gate_writes_less_than_its_texts(spark):
    c, model = _comments(spark), _model(spark)
    size = c.agg(F.sum(F.octet_length("comment"))).first()[0]
    before = _bytes(spark)
    assert clean_comments(c, ModelGate(model)).count() == 60
    assert _bytes(spark) - before < size


def test_seldom_tokens_and_repeated_keys_are_scored(spark, monkeypatch):
    from threadlens.operators import langid
    docs = spark.createDataFrame([(1, "due due alpha"), (2, "alpha"), (2, "uno due due"), (3, "zzz"), (None, "the the")],
                                 "k int, t string")
    want = {(1, "it"), (2, "it"), (3, None), (None, None)}
    for hot in (20_000, 1, 0):
        monkeypatch.setattr(langid, "HOT_TOKENS", hot)
        got = predict_word_nb(_model(spark), docs, "t", "k")
        assert {(r.k, r.lang_pred) for r in got.collect()} == want
        assert got.count() == 5


def test_trigram_workers_hold_little(spark):
    texts = [f"some words of text {i} " * 400 for i in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 400), pa.array(texts)], names=["label", "t"])
    list(_counts(iter([batch.slice(0, 1)])))                  # imports are done
    tracemalloc.start()
    rows = sum(b.num_rows for b in _counts(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 0
    assert peak < 40 << 20
    train_profiles(spark.createDataFrame([("abcd", "en")], "t string, lang string"), "t", "lang")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000


def test_comment_level_writes_less_than_its_texts(spark):
    c = _comments(spark)
    size = c.agg(F.sum(F.octet_length("comment"))).first()[0]
    before = _bytes(spark)
    got = jobs.comment_level(c, None, {"m": ["alpha"]})
    assert got.agg(F.max("level")).first()[0] == 6
    assert _bytes(spark) - before < size
