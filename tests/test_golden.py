"""Golden micro-fixtures: one per reference quirk (see FIXTURES.md part C)."""

import math

import pytest
from pyspark.sql import functions as F

from threadlens.functions import labels as lb
from threadlens.functions import text as tx
from threadlens.functions.dates import coerce_two_formats, parse_day_mon_year, parse_iso_day
from threadlens.operators import absa as ab
from threadlens.operators.dedup import incremental_append, keep_first
from threadlens.operators.mentions import contains_any, reduce_antichain
from threadlens.operators.sentences import split_sentences
from threadlens.operators.threads import assign_levels, thread_context
from threadlens.operators.unify import join_parent, parse_parent_id, rename_profile
from threadlens.schemas import ASPECT_LABELS


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col.alias("y")).first()["y"]


def test_01_na_set(spark):
    df = spark.createDataFrame([(v,) for v in ["N/A", "None", "null", "", "none", "N.A."]], "x string")
    out = [r[0] for r in df.select(tx.normalize_na("x")).collect()]
    assert out == [None, None, None, None, "none", "N.A."]


def test_02_control_strip_then_url(spark):
    s = "see https://a.b\nnext word"
    assert one(spark, tx.mask_urls(tx.strip_control(F.col("x"))), s) == "see [URL] word"


def test_03_url_nbsp(spark):
    assert one(spark, tx.mask_urls(F.col("x")), "https://a.b tail") == "[URL] tail"


def test_04_typographic_every_column(spark):
    df = spark.createDataFrame([("“a” ‘b’ – c…", "…", 1)],
                               "a string, b string, n int")
    r = tx.every_string(df, tx.typographic).first()
    assert r["a"] == "\"a\" 'b' - c..." and r["b"] == "..." and r["n"] == 1


def test_05_cf_and_nfc(spark):
    assert one(spark, tx.strip_cf(F.col("x")), "a­b​c") == "abc"
    assert one(spark, tx.nfc(F.col("x")), "é") == "é"


def test_06_end_punct(spark):
    df = spark.createDataFrame([("ok! ",), ("",), ("  ",), ("ok”",), (None,)], "x string")
    assert [r[0] for r in df.select(tx.ends_with_punct("x")).collect()] == [True, False, False, False, False]


def test_07_parent_id_parse(spark):
    df = spark.createDataFrame([("t1_abc",), ("t3_abc",)], "x string")
    assert [r[0] for r in df.select(parse_parent_id("x")).collect()] == ["abc", None]


def test_08_self_join(spark):
    df = spark.createDataFrame([("a", None, "root"), ("b", "a", "reply"), ("c", "zz", "orphan")],
                               "comment_id string, parent_comment_id string, comment string")
    got = {r.comment_id: r.parent_comment for r in join_parent(df).collect()}
    assert got == {"a": None, "b": "root", "c": None}


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_09_keep_first_any_partitioning(spark, parts):
    rows = [("k", 5, "late"), ("k", 1, "early"), ("j", 2, "only"), (None, 3, "n1"), (None, 4, "n2")]
    df = spark.createDataFrame(rows, "key string, ord int, v string").repartition(parts)
    got = {r.key: r.v for r in keep_first(df, ["key"], ["ord"]).collect()}
    assert got == {"k": "early", "j": "only", None: "n1"}


def test_10_levels_cycles_and_orphans(spark):
    rows = [("r", None), ("c1", "r"), ("c2", "c1"), ("o", "gone"),
            ("a", "b"), ("b", "a"), ("h", "a")]
    df = spark.createDataFrame(rows, "comment_id string, parent_comment_id string")
    got = {r.comment_id: (r.level, r.unreachable) for r in assign_levels(df).collect()}
    assert got["r"] == (1, False) and got["c1"] == (2, False) and got["c2"] == (3, False)
    assert got["o"] == (1, False)
    assert got["a"] == (None, True) and got["b"] == (None, True) and got["h"] == (None, True)


def test_10b_deep_chain(spark):
    rows = [(f"n{i}", f"n{i-1}" if i else None) for i in range(40)]
    df = spark.createDataFrame(rows, "comment_id string, parent_comment_id string")
    got = {r.comment_id: r.level for r in assign_levels(df).collect()}
    assert all(got[f"n{i}"] == i + 1 for i in range(40))


def test_11_context_concat(spark):
    df = spark.createDataFrame([("Hi", "x"), ("Hi!", "x"), ("", "x"), ("[deleted]", "x")],
                               "p string, c string")
    got = [r[0] for r in df.select(tx.context_concat("p", "c")).collect()]
    assert got == ["Hi. [NEXT_COMMENT] x", "Hi! [NEXT_COMMENT] x", ". [NEXT_COMMENT] x",
                   "[deleted] [NEXT_COMMENT] x"]


def test_12_marker_recovery(spark):
    df = spark.createDataFrame([("no marker here",), ("p. [NEXT_COMMENT] a [NEXT_COMMENT] b",)],
                               "x string")
    assert [r[0] for r in df.select(tx.recover_child("x")).collect()] == ["no marker here", "a "]


def test_12b_context_levels(spark):
    rows = [("a", None, "Root", ""), ("b", "a", "Mid!", "ignored"), ("c", "b", "Leaf", "stale"),
            ("d", "a", "Gone", "[deleted]")]
    df = spark.createDataFrame(rows, "comment_id string, parent_comment_id string, "
                                     "comment string, parent_comment string")
    out = thread_context(assign_levels(df).drop("unreachable"))
    got = {r.comment_id: (r.parent_comment, r.comment_after_coref) for r in out.collect()}
    assert got["a"] == ("", "Root")
    assert got["b"] == ("Root", "Mid!")
    assert got["c"] == ("Mid!", "Leaf")
    assert got["d"] == ("[deleted]", "Gone")


def test_14_contains_any(spark):
    terms = ["donal", "Donald", "key"]
    assert reduce_antichain(terms) == ["donal", "key"]
    df = spark.createDataFrame([("McDonalds",), ("nothing",), (None,)], "x string")
    got = [r[0] for r in df.select(contains_any("x", terms)).collect()]
    assert got == [1, 0, None]


def test_14b_large_term_list_uses_automaton(spark):
    terms = [f"zz{i:04d}" for i in range(300)] + ["hit"]
    df = spark.createDataFrame([("a HIT b",), ("miss",)], "x string")
    assert [r[0] for r in df.select(contains_any("x", terms)).collect()] == [1, 0]


def test_15_sentences(spark):
    df = spark.createDataFrame([(1, "A b. C 3.5 d! E?"), (2, "")], "id int, comment string")
    rows = split_sentences(df).orderBy("id", "sentence_idx").collect()
    assert [(r.sentence, r.previous_sentence) for r in rows] == [
        ("A b.", None), ("C 3.5 d!", "A b."), ("E?", "C 3.5 d!")]


def test_16_thresholds(spark):
    df = spark.createDataFrame([([0.65, 0.35],)], "p array<double>")
    r = df.select(lb.threshold_strict("p").alias("s"), lb.threshold_inclusive("p").alias("i")).first()
    assert r.s == [0, 0] and r.i == [1, 1]


def test_17_entity_expand(spark):
    df = spark.createDataFrame([(1, [1, 1, 0]), (2, [0, 0, 0])], "id int, entity_ids array<int>")
    rows = ab.expand_entities(df).orderBy("id", "entity_id").collect()
    assert [(r.id, r.entity_category) for r in rows] == [(1, "kamala"), (1, "trump"), (2, "others")]
    rows = ab.expand_entities(df, all_zero="drop").collect()
    assert sorted((r.id, r.entity_category) for r in rows) == [(1, "kamala"), (1, "trump")]


def test_18_label_parse(spark):
    df = spark.createDataFrame([("Policies; foo ;leadership",)], "t string")
    r = df.select(lb.parse_label_list("t").alias("v"), lb.unknown_label_count("t").alias("u")).first()
    assert sum(r.v) == 2 and r.v[ASPECT_LABELS.index("policies")] == 1 and r.u == 1


def test_19_all_unknown_parse(spark):
    df = spark.createDataFrame([("foo; bar", [0] * 13)], "t string, d array<int>")
    r = df.select(lb.multihot_decode(lb.parse_label_list("t"), ASPECT_LABELS).alias("c"),
                  lb.parse_label_list("t").alias("v"),
                  lb.extend_others_slot("d").alias("e")).first()
    assert r.c == ["others"] and sum(r.v) == 0 and r.e[13] == 1 and sum(r.e) == 1


def test_20_sentiment_parse(spark):
    df = spark.createDataFrame([("sentiment: positive",), ("positive",), ("sentiment: Positive",),
                                ("a: negative: x",)], "t string")
    assert [r[0] for r in df.select(lb.parse_sentiment("t")).collect()] == [1, 0, 0, -1]


def test_21_arbitration(spark):
    rows = [(0.85, -9.0), (0.84, -0.36), (0.84, -0.37), (math.nan, math.nan), (None, None)]
    df = spark.createDataFrame(rows, "c1 double, c2 double").withColumns(
        {"p1": F.lit(1), "p2": F.lit(-1)})
    got = [r[0] for r in df.select(lb.arbitrate("p1", "c1", "p2", "c2")).collect()]
    assert got == [1, -1, 1, 1, 1]


def test_22_append_idempotent(spark):
    stored = spark.createDataFrame([(1, "v", 10, "old")], "comment_id int, video string, ord int, t string")
    arriving = spark.createDataFrame([(1, "v", 20, "new"), (2, "v", 30, "x"), (2, "v", 31, "y")],
                                     "comment_id int, video string, ord int, t string")
    fresh, table1 = incremental_append(stored, arriving, "comment_id", ["ord"])
    got = {r.comment_id: r.t for r in table1.collect()}
    assert got == {1: "old", 2: "x"}
    fresh2, table2 = incremental_append(table1, arriving, "comment_id", ["ord"])
    assert fresh2.count() == 0 and table2.count() == 2


def test_23_dates(spark):
    df = spark.createDataFrame([("4-Oct-2024",), ("14-Oct-2024",)], "x string")
    got = [str(r[0]) for r in df.select(parse_day_mon_year("x")).collect()]
    assert got == ["2024-10-04 00:00:00", "2024-10-14 00:00:00"]
    iso = spark.createDataFrame([("2024-10-04T23:59:59Z",)], "x string")
    assert str(iso.select(parse_iso_day("x")).first()[0]) == "2024-10-04 00:00:00"
    bad = spark.createDataFrame([("garbage",)], "x string")
    assert bad.select(parse_day_mon_year("x")).first()[0] is None
    with pytest.raises(Exception):
        bad.select(parse_day_mon_year("x", strict=True)).collect()
    with pytest.raises(Exception):
        bad.select(coerce_two_formats("x", strict=True)).collect()


def test_24_drift(spark, tmp_path):
    from threadlens.schemas import POSTS_RAW
    from threadlens.sources.landing import consolidate
    good = "post_id,post_title,votes,created_utc,num_comments,post_body\np1,T,1,4-Oct-2024,2,b\n"
    drift = "post_title,post_id,votes,created_utc,num_comments,post_body\nT,p2,1,4-Oct-2024,2,b\n"
    (tmp_path / "x_post_data_trump.csv").write_text(good)
    (tmp_path / "x_post_data_kamala.csv").write_text(good.replace("p1", "p3"))
    df = consolidate(spark, str(tmp_path), "_post_data_", POSTS_RAW)
    assert sorted((r.post_id, r.search_type) for r in df.collect()) == [("p1", "Trump"), ("p3", "Kamala")]
    (tmp_path / "y_post_data_kamala.csv").write_text(drift)
    with pytest.raises(Exception):
        consolidate(spark, str(tmp_path), "_post_data_", POSTS_RAW).collect()


def test_25_cascade_scores_masked_rows_only(spark):
    from pyspark.sql import types as T
    from threadlens.operators.scoring import FrameScorer
    seen = spark.sparkContext.accumulator(0)

    @F.udf(T.StringType())
    def second(s):
        seen.add(1)
        return "policies"

    scorer = FrameScorer("aspect_second_text",
                         lambda df: df.withColumn("aspect_second_text", second("sentence")),
                         T.StringType())
    rows = [(i, "s", "kamala", [1 if i % 4 else 0] + [0] * 12) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, sentence string, entity_category string, "
                                     "distil_aspect_labels array<int>")
    df = df.withColumn("distil_aspect_categories",
                       lb.multihot_decode("distil_aspect_labels", ASPECT_LABELS[:-1]))
    out = ab.aspect_cascade(df, scorer).collect()
    assert seen.value == 5
    masked = [r for r in out if r.id % 4 == 0]
    assert all(r.final_aspect_categories == ["policies"] for r in masked)


def test_rename_profile(spark):
    df = spark.createDataFrame([("t", "x")], "`Post Title` string, other string")
    assert rename_profile(df, "reddit_comments").columns == ["post_title", "other"]
    with pytest.raises(ValueError):
        rename_profile(df, "nope")


def _sp(a, b):
    return F.struct(F.lit(a).alias("tok_start"), F.lit(b).alias("tok_end"))


def test_13_mention_rewrite(spark):
    from threadlens.operators.rewrite import rewrite_mentions, tokenize
    df = spark.createDataFrame([("he met Al Key. his dog saw X Y.",)], "t string")
    tk = df.select(tokenize("t").alias("tk"))
    cl = F.array(F.array(_sp(0, 0), _sp(2, 3), _sp(5, 5)), F.array(_sp(8, 9)))
    assert tk.select(rewrite_mentions("tk", cl, ["key"])).first()[0] == \
        "Al Key met Al Key . Al Key dog saw X Y."
    overlap = F.array(F.array(_sp(0, 0), _sp(2, 3)), F.array(_sp(2, 2), _sp(8, 9)))
    assert tk.select(rewrite_mentions("tk", overlap, ["key", "x"])).first()[0] == \
        "Al Key met X Y . his dog saw X Y ."
    none = F.array(F.array(_sp(0, 0), _sp(5, 5)))
    assert tk.select(rewrite_mentions("tk", none, ["key"])).first()[0] == \
        "he met Al Key. his dog saw X Y."


def test_13b_rule_clusters(spark):
    from threadlens.operators.rewrite import rule_rewrite
    df = spark.createDataFrame([("  The Keyman came. He said it was fine.",)], "t string")
    assert df.select(rule_rewrite(["key"])(F.col("t"))).first()[0] == \
        "  The Keyman came. Keyman said Keyman was fine."


def test_subjective_profiles(spark):
    df = spark.createDataFrame([([0.7, 0.2],), ([0.5, 0.9],)], "s array<double>")
    got = [tuple(r) for r in df.select(lb.subjective_flag("s", "subjective_first"),
                                       lb.subjective_flag("s", "subjective_second"),
                                       lb.subjective_flag("s", "nope")).collect()]
    assert got == [(1, 0, None), (0, 1, None)]


def test_lookup_join_hot_split(spark):
    from threadlens.operators.joins import lookup_join
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 7}") for i in range(300)] + [(999, None)]
    left = spark.createDataFrame(rows, "id int, k string")
    right = spark.createDataFrame([("hot", "H")] + [(f"k{j}", f"V{j}") for j in range(5)],
                                  "rk string, v string")
    plain = sorted(tuple(r) for r in left.join(right, left.k == right.rk, "left").collect())
    split = lookup_join(left, right, "k", "rk", "left", max_hot=10, min_rows=10)
    assert sorted(tuple(r) for r in split.collect()) == plain
    inner = lookup_join(left, right, "k", "rk", "inner", max_hot=10, min_rows=10)
    assert inner.count() == left.join(right, left.k == right.rk).count()


def test_levels_with_hot_parent(spark, monkeypatch):
    import threadlens.operators.joins as jn
    monkeypatch.setattr(jn, "MIN_HOT_ROWS", 5)
    rows = [("root", None)] + [(f"c{i}", "root") for i in range(200)] + \
           [(f"g{i}", "c0") for i in range(50)]
    df = spark.createDataFrame(rows, "comment_id string, parent_comment_id string")
    from threadlens.operators.threads import assign_levels
    jn.SPLITS.clear()
    got = {r.comment_id: r.level for r in assign_levels(df).collect()}
    assert got["root"] == 1 and got["c5"] == 2 and got["g7"] == 3
    assert any(n > 0 for n in jn.SPLITS)


def test_15b_sentences_quotes_and_abbreviations(spark):
    df = spark.createDataFrame([(1, 'He said "go." Then Mr. Key left, e.g. early. Why?! Done')],
                               "id int, comment string")
    got = [r.sentence for r in split_sentences(df).orderBy("sentence_idx").collect()]
    assert got == ['He said "go."', "Then Mr. Key left, e.g. early.", "Why?!", "Done"]


def test_orphans_and_levels_with_hot_split(spark, monkeypatch):
    import threadlens.operators.joins as jn
    from threadlens.operators.threads import orphan_roots
    monkeypatch.setattr(jn, "MIN_HOT_ROWS", 5)
    rows = [("r", None)] + [(f"c{i}", "r") for i in range(100)] + \
           [(f"o{i}", "gone") for i in range(60)]
    df = spark.createDataFrame(rows, "comment_id string, parent_comment_id string")
    jn.SPLITS.clear()
    assert orphan_roots(df).count() == 60
    got = {r.comment_id: r.level for r in assign_levels(df).collect()}
    assert got["o3"] == 1 and got["c9"] == 2 and got["r"] == 1
    assert any(n > 0 for n in jn.SPLITS)


def test_14c_word_boundary_option(spark):
    df = spark.createDataFrame([("McDonalds",), ("Donald spoke",), ("nothing",)], "x string")
    sub = [r[0] for r in df.select(contains_any("x", ["donal", "donald"])).collect()]
    wb = [r[0] for r in df.select(contains_any("x", ["donal", "donald"], word_boundary=True)).collect()]
    assert sub == [1, 1, 0] and wb == [0, 1, 0]


def test_lookup_join_with_given_hot_keys(spark):
    from threadlens.operators.joins import lookup_join
    left = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 5}") for i in range(50)],
                                 "id int, k string")
    right = spark.createDataFrame([("hot", "H"), ("k0", "A"), ("k2", "B")], "rk string, v string")
    plain = sorted(tuple(r) for r in left.join(right, left.k == right.rk, "left").collect())
    given = lookup_join(left, right, "k", "rk", "left", hot=["hot"])
    assert sorted(tuple(r) for r in given.collect()) == plain


def test_12c_context_duplicate_ids_last_wins(spark):
    # two rows share id "a" at level 1: the child sees the later one's resolved text
    rows = [("a", None, "First", "", 1, 0), ("a", None, "Second", "", 1, 1),
            ("b", "a", "Kid", "", 2, 2)]
    df = spark.createDataFrame(rows, "comment_id string, parent_comment_id string, comment string, "
                                     "parent_comment string, level int, o int")
    out = {(r.comment_id, r.comment): r.parent_comment
           for r in thread_context(df, order_col="o").collect()}
    assert out[("b", "Kid")] == "Second"
