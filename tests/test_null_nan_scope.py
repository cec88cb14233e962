"""Rows without keys, NaN scores, late rows, ids shared by two platforms."""

from pyspark.sql import functions as F

from threadlens.functions import labels as lb
from threadlens.operators import joins
from threadlens.operators.dedup import incremental_append
from threadlens.operators.joins import lookup_join
from threadlens.operators.threads import assign_levels, orphan_roots
from threadlens.sources.landing import enrich_with_videos
from threadlens.streaming.ingest import init_stored, stream_append


def test_nan_never_passes_a_threshold(spark):
    df = spark.createDataFrame([([float("nan"), 0.9, None, 0.1],)], "p array<double>")
    r = df.select(lb.threshold_strict("p").alias("s"), lb.threshold_inclusive("p").alias("i"),
                  lb.subjective_flag("p", "subjective_first").alias("f")).first()
    assert r.s == [0, 1, 0, 0] and r.i == [0, 1, 0, 0]
    nan = spark.createDataFrame([([float("nan"), float("nan")],)], "p array<double>")
    assert nan.select(lb.subjective_flag("p", "subjective_first").alias("f")).first().f == 0


def test_labels_are_stripped_as_python_does(spark):
    text = "policies;\nLeadership ; \x1d leadership \x85"
    df = spark.createDataFrame([(text,)], "t string")
    known = [p.strip().lower() for p in text.split(";")]
    labels = sorted(set(known))
    r = df.select(lb.parse_label_list("t", labels).alias("v"), lb.unknown_label_count("t", labels).alias("u")).first()
    assert r.v == [1] * len(labels) and r.u == 0


def test_null_key_is_appended_once(spark):
    stored = spark.createDataFrame([("a", 1)], "k string, o int")
    batch = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "k string, o int")
    fresh, table = incremental_append(stored, batch, "k", ["o"])
    assert sorted(fresh.collect(), key=str) == sorted([(None, 1), ("b", 4)], key=str)
    again, _ = incremental_append(table, batch, "k", ["o"])
    assert again.count() == 0


def test_late_unseen_rows_are_stored(spark, tmp_path):
    base, schema = str(tmp_path), "event_id long, ts timestamp_ntz"

    def frame(rows):
        return spark.createDataFrame([(i, None) for i, _ in rows], schema).drop("ts").join(
            spark.createDataFrame(rows, "event_id long, t string"), "event_id").select(
            "event_id", F.col("t").cast("timestamp_ntz").alias("ts"))

    init_stored(frame([(1, "2024-01-01 00:00:00")]), f"{base}/stored", "event_id", n_buckets=4)
    for n, rows in enumerate([[(2, "2024-10-20 00:00:00")], [(3, "2019-10-10 00:00:00")]]):
        frame(rows).write.parquet(f"{base}/landing/b{n}")
        stream_append(spark, f"{base}/landing/*", frame(rows).schema, f"{base}/stored", "event_id", ["ts"],
                      f"{base}/_ckpt", n_buckets=4).awaitTermination()
    assert {r.event_id for r in spark.read.parquet(f"{base}/stored").collect()} == {1, 2, 3}


def test_levels_within_a_platform(spark):
    rows = [("Reddit", "k", None), ("Reddit", "c", "k"), ("Youtube", "p", None), ("Youtube", "k", "p")]
    df = spark.createDataFrame(rows, "platform string, comment_id string, parent_comment_id string")
    got = {(r.platform, r.comment_id): r.level for r in assign_levels(df).collect()}
    assert got == {("Reddit", "k"): 1, ("Reddit", "c"): 2, ("Youtube", "p"): 1, ("Youtube", "k"): 2}
    lost = df.unionByName(spark.createDataFrame([("Youtube", "x", "c")], df.schema))
    assert [r.comment_id for r in orphan_roots(lost).collect()] == ["x"]


def test_rows_without_key_are_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "MIN_HOT_ROWS", 10**9)
    left = spark.range(40_000).select(F.col("id"), F.when(F.col("id") % 10 >= 7, F.col("id").cast("string")).alias("k"))
    right = spark.range(40_000).select(F.col("id").cast("string").alias("rk"), F.lit(1).alias("one"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = lookup_join(left, right, "k", "rk", "left", n_left=40_000)
        sizes = [r.n for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert out.count() == 40_000 and out.where("one = 1").count() == 12_000
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_repeated_videos_do_not_multiply_comments(spark):
    c = spark.createDataFrame([("v1", "x"), ("v2", "y")], "video_id string, comment string")
    v = spark.createDataFrame([("q1", "v1", "t", "d"), ("q2", "v1", "u", "d"), ("q1", "v2", "w", "d")],
                              "query string, video_id string, title string, published_date string")
    got = sorted((r.comment, r.video_title) for r in enrich_with_videos(c, v).collect())
    assert got == [("x", "t"), ("y", "w")]
