"""Landed payload scans: JSON thread flattening, post records, optional tables."""

import json

from pyspark.sql import functions as F

from threadlens.sources import landing


def test_flatten_replies(spark):
    items = [
        {"video_id": "v1", "snippet": {"topLevelComment": {"id": "t1", "snippet": {
            "textDisplay": "top", "likeCount": 3, "publishedAt": "2024-10-04T10:00:00Z"}},
            "totalReplyCount": 2},
         "replies": [{"id": "r1", "snippet": {"textDisplay": "a", "likeCount": 1,
                                              "publishedAt": "2024-10-04T11:00:00Z"}},
                     {"id": "r2", "snippet": {"textDisplay": "b", "likeCount": 0,
                                              "publishedAt": "2024-10-04T12:00:00Z"}}]},
        {"video_id": "v1", "snippet": {"topLevelComment": {"id": "t2", "snippet": {
            "textDisplay": "lonely", "likeCount": 0, "publishedAt": "2024-10-05T10:00:00Z"}},
            "totalReplyCount": 0}, "replies": None},
    ]
    df = spark.createDataFrame([(json.dumps(i),) for i in items], "value string")
    df = df.select(F.from_json("value", landing.THREAD_ITEM).alias("j")).select("j.*")
    rows = {r.comment_id: (r.parent_comment_id, r.parent_comment) for r in
            landing.flatten_replies(df).collect()}
    assert rows == {"t1": ("N/A", "N/A"), "t2": ("N/A", "N/A"),
                    "r1": ("t1", "top"), "r2": ("t1", "top")}


def test_flatten_threads_variant(spark):
    tree = {"comments": [
        {"id": "a", "body": "A", "created": 1, "score": 5, "replies": [
            {"id": "b", "body": "B", "created": 2, "score": 1, "replies": [
                {"id": "c", "body": "C", "created": 3, "score": 0, "replies": []}]}]},
        {"id": "d", "body": "D", "created": 4, "score": 2, "replies": []}]}
    df = spark.createDataFrame([("p1", json.dumps(tree))], "post_id string, payload string")
    rows = {r.comment_id: r.parent_comment_id for r in landing.flatten_threads(df).collect()}
    assert rows == {"a": None, "b": "a", "c": "b", "d": None}


def test_post_records(spark):
    rows = [("x", "T", 5, 1728000000, 2, True, "body", "http://u"),
            ("y", "U", 1, 1728086400, 0, False, "", "http://v")]
    df = spark.createDataFrame(rows, landing.POST_PAYLOAD)
    got = {r.post_id: (r.created_utc, r.post_body) for r in landing.post_records(df).collect()}
    assert got == {"x": ("04-Oct-2024", "body"), "y": ("05-Oct-2024", "http://v")}


def test_optional_table(spark, tmp_path):
    from threadlens.schemas import VIDEO_COMMENTS_RAW
    missing = landing.optional_table(spark, str(tmp_path / "nope"), VIDEO_COMMENTS_RAW)
    assert missing.count() == 0 and missing.schema == VIDEO_COMMENTS_RAW


def test_load_gazetteer(spark, tmp_path):
    (tmp_path / "a.csv").write_text("entity_names\nDonald\nrump\nDonald\n")
    (tmp_path / "b.csv").write_text("entity_names\nKamala\n")
    assert landing.load_gazetteer(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]) == \
        ["Donald", "Kamala", "rump"]


def test_video_records_and_enrich(spark):
    page = {"query": "Trump", "page": 0, "items": [
        {"id": {"videoId": "v1"}, "snippet": {"title": "T1", "publishedAt": "2024-10-20T00:00:00Z"}},
        {"id": {"videoId": "v2"}, "snippet": {"title": "T2", "publishedAt": "2024-10-01T00:00:00Z"}}]}
    df = spark.createDataFrame([(json.dumps(page),)], "value string").select(
        F.from_json("value", landing.SEARCH_PAYLOAD).alias("j")).select("j.*")
    vids = landing.video_records(df)
    assert [r.video_id for r in vids.orderBy("relevance").collect()] == ["v1", "v2"]
    comments = spark.createDataFrame([("v1", "c1"), ("v3", "c2")], "video_id string, comment_id string")
    got = landing.enrich_with_videos(comments, vids).collect()
    assert [(r.comment_id, r.video_title) for r in got] == [("c1", "T1")]


def test_export_csv_round_trip(spark, tmp_path):
    from threadlens.schemas import POSTS_RAW
    rows = [("p1", ' a, "b"\nc ', 1, "4-Oct-2024", 2, "x")]
    df = spark.createDataFrame(rows, POSTS_RAW)
    landing.export_csv(df, str(tmp_path / "out"))
    back = landing.read_landed_csv(spark, str(tmp_path / "out"), POSTS_RAW).first()
    assert back.post_title == ' a, "b"\nc '


def test_consolidate_empty_folder(spark, tmp_path):
    from threadlens.schemas import POSTS_RAW
    n_fields = len(POSTS_RAW.fields)
    df = landing.consolidate(spark, str(tmp_path), "_post_data_", POSTS_RAW)
    assert df.count() == 0 and "search_type" in df.columns
    assert len(POSTS_RAW.fields) == n_fields
