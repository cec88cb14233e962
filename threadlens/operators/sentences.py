"""Sentence explode with the previous sentence, no shuffle.

Boundaries: ``. ! ?`` (possibly repeated, possibly followed by closing
quotes or brackets) followed by whitespace, except a period ending a common
abbreviation (``Mr.``, ``e.g.``...). The split keeps the punctuation; the
U+0001/U+0002 sentinels are safe because control characters were removed
upstream. Each sentence is paired with its predecessor inside the row's
array before ``posexplode``: the same result as ``lag(1) over (partition by
comment order by position)`` without a window or a shuffle.

With ``abbreviations`` (types learned by ``abbreviations.learn_abbreviations``)
these take the place of the fixed list; their number is bounded there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.hof import let

SENTINEL = "\u0001"
KEEP = "\u0002"  # marks a period that ends an abbreviation, not a sentence
# Abbreviations after which a period does not end a sentence.
ABBREVIATIONS = ["mr", "mrs", "ms", "dr", "prof", "sr", "jr", "st", "vs", "etc", "e.g", "i.e",
                 "inc", "ltd", "jan", "feb", "aug", "sept", "oct", "nov", "dec", "gov", "sen",
                 "rep", "gen", "u.s"]
# Unicode whitespace (as Python's splitter sees it), spelled out so that the
# Java and RE2 engines agree: their bare \s is ASCII-only.
WS = ("[\\s\\x{0b}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
      "\\x{202f}\\x{205f}\\x{3000}]")
_ALTS = "|".join(a.replace(".", "\\.") for a in ABBREVIATIONS)
# Abbreviation followed by a period and whitespace, not preceded by an ASCII
# word character. Portable form (RE2 oracle; its \b is ASCII):
ABBREV_RE = "(?i)\\b(" + _ALTS + ")\\.(" + WS + ")"
# The same matches for Java, with a cheap lookahead guard so most positions
# fail fast (abbreviations are at most 4 characters before their period).
ABBREV_RE_FAST = ("(?i)(?<![A-Za-z0-9_])(?=[a-z.]{1,4}\\." + WS + ")(" + _ALTS + ")\\.("
                  + WS + ")")
# End punctuation, optionally followed by closing quotes/brackets, then whitespace.
BOUNDARY = "([.!?]+[\"')\\]]*)" + WS + "+"
TRIM = "^" + WS + "+|" + WS + "+$"
# The same boundary, its whitespace kept; whitespace as single characters.
BOUNDARY_KEPT = "([.!?]+[\"')\\]]*)(" + WS + "+)"
WS_CHARS = ("\t\n\x0b\x0c\r\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200b))
            + "\u2028\u2029\u202f\u205f\u3000")


def _learned_array(text: Column, abbreviations: list[str]) -> Column:
    """Cut at every boundary; pieces that end in an abbreviation are put together again."""
    from threadlens.operators.abbreviations import ends_in_abbreviation
    parts = F.split(F.regexp_replace(text, BOUNDARY_KEPT, "$1" + SENTINEL + "$2"), SENTINEL)
    joined = F.array_join(F.transform(parts, lambda p: F.concat(p, F.when(
        ends_in_abbreviation(p, abbreviations), F.lit("")).otherwise(F.lit(SENTINEL)))), "")
    return F.transform(F.split(joined, SENTINEL), lambda s: F.regexp_replace(s, "^" + WS + "+", ""))


def sentence_array(c, abbreviations: list[str] | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    # The boundary consumes the whole whitespace run at every split point, so
    # only the text's own ends can carry whitespace: trim once, not per piece.
    text = F.regexp_replace(col, TRIM, "")
    if abbreviations is not None:
        return F.filter(_learned_array(text, abbreviations), lambda s: s != F.lit(""))
    kept = F.regexp_replace(text, ABBREV_RE_FAST, "$1." + KEEP + "$2")
    parts = F.split(F.regexp_replace(kept, BOUNDARY, "$1" + SENTINEL), SENTINEL)
    parts = F.transform(parts, lambda s: F.replace(s, F.lit(KEEP), F.lit("")))
    return F.filter(parts, lambda s: s != F.lit(""))


def split_sentences(df: DataFrame, text_col: str = "comment",
                    keep_position: bool = True, abbreviations: list[str] | None = None) -> DataFrame:
    """One row per sentence of ``text_col``; empty or NULL text -> no rows.

    Adds ``sentence_idx`` (0-based), ``sentence`` and ``previous_sentence``
    (NULL for the first). Each sentence is paired with its predecessor inside
    the array before the explode, so no output row carries the whole array
    (which would copy it once per sentence: quadratic in long texts).
    """
    pairs = let(sentence_array(text_col, abbreviations), lambda a: F.transform(
        a, lambda s, i: F.struct(s.alias("sentence"),
                                 F.when(i > 0, a[i - 1]).alias("previous_sentence"))))
    cols = [F.col(c) for c in df.columns]
    out = df.select(*cols, F.posexplode(pairs).alias("sentence_idx", "_s"))
    out = out.select(*cols, "sentence_idx", F.col("_s.sentence").alias("sentence"),
                     F.col("_s.previous_sentence").alias("previous_sentence"))
    if not keep_position:
        out = out.drop("sentence_idx")
    return out
