"""Edge cases of the smaller helpers."""

from pyspark.sql import functions as F

from threadlens.functions import labels as lb
from threadlens.functions import text as tx
from threadlens.functions.dates import epoch_to_day_text
from threadlens.operators import absa as ab
from threadlens.operators.dedup import keep_first
from threadlens.operators.topk import recent
from threadlens.schemas import ASPECT_LABELS


def test_label_helpers(spark):
    df = spark.createDataFrame([("policies", 1, ["about", "not"], [0.7, 0.3], [0, 0, 0]),
                                ("nope", -1, ["x"], [0.1], [1, 0, 1])],
                               "a string, c int, labs array<string>, sc array<double>, v array<int>")
    r = df.select(lb.label_index("a").alias("i"), lb.code_to_sentiment("c").alias("s"),
                  lb.score_of_label("labs", "sc", "about").alias("p"),
                  lb.multihot_decode("v", ["x", "y", "z"], all_zero=None).alias("d")).collect()
    assert (r[0].i, r[0].s, r[0].p, r[0].d) == (ASPECT_LABELS.index("policies"), "positive", 0.7, [])
    assert (r[1].i, r[1].s, r[1].p, r[1].d) == (None, "negative", None, ["x", "z"])


def test_epoch_before_1970(spark):
    df = spark.createDataFrame([(-1,), (0,), (86399,), (86400,)], "e long")
    assert [r[0] for r in df.select(epoch_to_day_text("e")).collect()] == \
        ["31-Dec-1969", "01-Jan-1970", "01-Jan-1970", "02-Jan-1970"]


def test_custom_na_set(spark):
    df = spark.createDataFrame([("-",), ("N/A",)], "x string")
    assert [r[0] for r in df.select(tx.normalize_na("x", ["-"])).collect()] == [None, "N/A"]


def test_recent_with_column_as_of(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-09 00:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("ts"))
    out = recent(df, "ts", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), days=7)
    assert out.count() == 1


def test_keep_first_all_key_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert keep_first(df, ["k", "v"], ["k"]).count() == 2


def test_expand_drop_others_and_explode_outer(spark):
    df = spark.createDataFrame([(1, [0, 0, 1]), (2, [1, 0, 0])], "id int, entity_ids array<int>")
    rows = ab.expand_entities(df, drop_others=True).collect()
    assert [(r.id, r.entity_category) for r in rows] == [(2, "kamala")]
    e = spark.createDataFrame([(1, []), (2, ["policies"])], "id int, final_aspect_categories array<string>")
    got = sorted((r.id, r.final_aspect_category) for r in ab.explode_aspects(e).collect())
    assert got == [(1, None), (2, "policies")]
