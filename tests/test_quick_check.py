"""Texts that neither HTML unescape nor NFC can change do not go to Python."""

import html
import unicodedata

from pyspark.sql import functions as F

from threadlens.functions import text as tx
from threadlens.operators import clean
from threadlens.plans.common import unified
from threadlens.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_stable_ranges_hold_no_code_point_that_nfc_moves():
    second = set()
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(int(parts[1], 16))
    second |= set(range(0x1160, 0x1200))                     # vowels and finals of Hangul syllables
    for a, b in tx.NFC_STABLE:
        for c in range(a, b + 1):
            assert c not in second and not unicodedata.combining(chr(c)), hex(c)
            assert unicodedata.is_normalized("NFC", chr(c)), hex(c)


def test_unneeded_texts_are_the_same_and_most(spark):
    odd = ["e\u0301", "&amp;", "a & b", "\u212b", "\u1100\u1161", "\uac00\u11a8", "caf\u00e9", "", None, "\U0001f600 ok",
           "\u65e5\u672c\u8a9e", "\u304b\u3099", "\u2001", "\u0915\u093c", "it\u2019s \u2026"]
    docs = table(spark, SF, "documents").select("text").union(spark.createDataFrame([(x,) for x in odd], "text string"))
    rows = docs.select("text", tx.needs_fix("text").alias("n")).collect()
    for r in rows:
        if r.text is not None and not r.n:
            assert html.unescape(r.text) == r.text and unicodedata.normalize("NFC", r.text) == r.text
    need = {r.text for r in rows if r.n}
    assert {"e\u0301", "&amp;", "a & b", "\u212b", "\u1100\u1161", "\uac00\u11a8", "\u304b\u3099", "\u2001"} <= need
    assert not need & {"caf\u00e9", "\U0001f600 ok", "\u65e5\u672c\u8a9e", "it\u2019s \u2026"}
    assert sum(bool(r.n) for r in rows) < len(rows) / 2      # rows whose text is sent


def test_clean_is_the_same_as_with_every_text_sent(spark, monkeypatch):
    odd = [(f"x{i}", "T &lt; u", p, c) for i, (p, c) in enumerate([
        (None, "e\u0301 &eacute;"), ("&quot;", "plain"), ("plain", "&amp;amp; \u200b\ufeff"), ("p", "\u212b"), (None, None)])]
    df = unified(spark, SF).select("comment_id", "post_title", "parent_comment", "comment").union(
        spark.createDataFrame(odd, "comment_id string, post_title string, parent_comment string, comment string"))
    got = {r.comment_id: tuple(r) for r in clean.clean_comments(df).collect()}
    monkeypatch.setattr(clean, "has_entity", lambda c: F.col(c).isNotNull())
    monkeypatch.setattr(clean, "needs_fix", lambda c: F.col(c).isNotNull())
    want = {r.comment_id: tuple(r) for r in clean.clean_comments(df).collect()}
    assert got == want and len(got) > 100
    assert got["x0"][1:] == ("T < u", "", "\u00e9 \u00e9") and "x4" not in got
