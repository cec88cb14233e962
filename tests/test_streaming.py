"""Streaming append across restarts: each key stored once, stored rows win."""

from pyspark.sql import functions as F

from threadlens.streaming.ingest import init_stored, stream_append


def test_stream_append_restarts_are_exactly_once(spark, tmp_path):
    base = str(tmp_path)
    schema = "event_id long, user_id long, ts timestamp_ntz, v string"
    stored = spark.createDataFrame([(1, 1, None, "old1"), (2, 1, None, "old2")], schema) \
        .withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    init_stored(stored, f"{base}/stored", "event_id", n_buckets=4)

    def land(rows, name):
        df = spark.createDataFrame(rows, schema).withColumn(
            "ts", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
        df.write.parquet(f"{base}/landing/{name}")
        return df.schema

    def run(sch):
        q = stream_append(spark, f"{base}/landing/*", sch, f"{base}/stored", "event_id",
                          ["ts", "user_id"], f"{base}/_ckpt", n_buckets=4)
        q.awaitTermination()
        return {r.event_id: r.v for r in spark.read.parquet(f"{base}/stored").collect()}

    sch = land([(2, 1, None, "new2"), (3, 1, None, "new3"), (3, 1, None, "new3")], "b1")
    assert run(sch) == {1: "old1", 2: "old2", 3: "new3"}
    land([(3, 1, None, "again3"), (4, 1, None, "new4")], "b2")
    assert run(sch) == {1: "old1", 2: "old2", 3: "new3", 4: "new4"}
    got = run(sch)                                   # nothing new: no change
    assert got == {1: "old1", 2: "old2", 3: "new3", 4: "new4"}
    assert spark.read.parquet(f"{base}/stored").count() == 4
