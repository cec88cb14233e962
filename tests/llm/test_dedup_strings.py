import pytest
from pyspark.sql import functions as F

from tests.llm import brute, data
from threadlens.llm.anchors import substring_dedup
from threadlens.llm.parsing import suffix_dedup


@pytest.mark.parametrize("seed", [3, 4])
def test_substrings_as_brute_force(spark, seed):
    rs = data.rows(seed)
    df = data.frame(spark, [*rs, (None, "nobody")]).repartition(5)
    assert data.result(substring_dedup(df), "doc_id", "n_words", "n_removed", "kept_sha256") == \
        brute.substring_dedup(rs)


@pytest.mark.parametrize("seed", [3, 4])
def test_suffixes_as_brute_force(spark, seed, monkeypatch):
    from threadlens.llm import parsing
    if seed == 4:                                            # the hot path too
        monkeypatch.setattr(parsing, "HOT_IN_CHUNK", 1)
    rs = data.rows(seed)
    df = data.frame(spark, [*rs, (None, "nobody")]).repartition(5)
    assert data.result(suffix_dedup(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == \
        brute.suffix_dedup(rs)


def test_empty_table_and_repeated_rows(spark):
    none = data.frame(spark, [])
    assert substring_dedup(none).collect() == [] and suffix_dedup(none).collect() == []
    text = " ".join(f"w{k}" for k in range(50))
    twice = data.frame(spark, [(7, text), (7, text)])
    assert data.result(substring_dedup(twice), "n_removed") == [(50,), (50,)]
    assert data.result(suffix_dedup(twice), "n_removed") == [(0,), (0,)]


def test_kept_text_is_whole_characters(spark):
    text = "é" * 40
    df = data.frame(spark, [(1, "é" * 26 + "x"), (2, "a" + text + "b")])
    got = suffix_dedup(df, with_text=True).orderBy("doc_id").collect()
    assert got[1].n_removed > 0 and set(got[1].text) <= set("aéb")
    assert suffix_dedup(df, with_text=True).where(F.col("text").isNull()).count() == 0
