"""Abbreviations learned from texts, for the sentence split.

A word that ends in a period far more often than periods alone explain is an
abbreviation (Kiss and Strunk, Computational Linguistics 32, 2006). Words are
parted by whitespace, lower-cased, and freed of marks before and after them; the
type is the word without its final period. With n(w.) and n(w) the numbers of a
type with and without it, N all words and P those with a final period, a type scores

    L * exp(-letters) * periods * letters ^ -n(w)

L is twice the log of the likelihood ratio of "a period follows with chance 0.99"
against "with chance P / N"; ``letters`` are the type's characters but periods,
``periods`` its inner periods and the final one. 0.3 or more is an abbreviation.

Tokens are counted as they stand and only distinct ones looked at; both groupings
are combined map-side, so a type costs a task few rows however often it stands there. A word of more than 40 characters cannot score 0.3 (its
factor is below 1e-17) and is counted without being looked at; numbers are no
types. NULL and empty texts hold no words; no words, no types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from threadlens.functions.hof import let
from threadlens.operators.sentences import WS_CHARS
from threadlens.session import cut_lineage

THRESHOLD = 0.3
MAX_TYPES = 10_000      # types a split may hold as literals; checked
LONGEST = 40
LEAD = "^[^\\p{L}\\p{N}]+"
TRAIL = "[^\\p{L}\\p{N}.]+$"
FINAL = "[^.]\\.$"
IS_TYPE = "^[^\\p{N}]*\\p{L}[^\\p{N}]*$"


def type_counts(df: DataFrame, text_col: str) -> DataFrame:
    """type, n_with, n_without; words that are no types (numbers, marks, longer ones) under ''."""
    raw = F.explode(F.split(F.translate(F.col(text_col), WS_CHARS, " " * len(WS_CHARS)), " "))
    w = df.select(raw.alias("raw")).where("raw != ''")
    w = w.select(F.when(F.length("raw") <= LONGEST, F.lower("raw")).otherwise(F.lit("")).alias("raw"))
    w = w.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    w = w.select("n", F.regexp_replace(F.regexp_replace("raw", LEAD, ""), TRAIL, "").alias("w"))
    w = w.select("n", F.col("w").rlike(FINAL).alias("p"), F.regexp_replace("w", "\\.+$", "").alias("t"))
    w = w.select("n", "p", F.when(F.col("t").rlike(IS_TYPE), F.col("t")).otherwise(F.lit("")).alias("type"))
    zero = F.lit(0).cast("long")
    return w.groupBy("type").agg(F.sum(F.when(F.col("p"), F.col("n")).otherwise(zero)).alias("n_with"),
                                 F.sum(F.when(F.col("p"), zero).otherwise(F.col("n"))).alias("n_without"))


def score(n_with: Column, n_without: Column, type_: Column, words: int, finals: int) -> Column:
    chance = finals / words
    a, b = n_with.cast("double"), n_without.cast("double")
    rest = F.log(F.lit(1 - chance)) if chance < 1 else F.lit(0.0)       # all words end in a period: b is 0
    ratio = 2 * (a * (F.log(F.lit(0.99)) - F.log(F.lit(chance))) + b * (F.log(F.lit(0.01)) - rest))
    periods = F.length(type_) - F.length(F.replace(type_, F.lit("."), F.lit("")))
    letters = (F.length(type_) - periods).cast("double")
    return ratio * (periods + 1) * F.exp(-letters - b * F.log(letters))


def learn_abbreviations(df: DataFrame, text_col: str = "comment", min_count: int = 5,
                        threshold: float = THRESHOLD) -> DataFrame:
    """type, n_with, n_without, score of the abbreviations in all texts.

    Types seen with a period fewer than ``min_count`` times are not learned: one
    sighting of a two-letter word would do otherwise.
    """
    obs = Observation()
    counts = type_counts(df, text_col).observe(
        obs, F.sum(F.col("n_with") + F.col("n_without")).alias("words"), F.sum("n_with").alias("finals"))
    seen = cut_lineage(counts.where((F.col("n_with") >= min_count) & (F.col("type") != "")))
    words, finals = obs.get["words"] or 0, obs.get["finals"] or 0
    if not finals:
        return seen.withColumn("score", F.lit(0.0)).limit(0)
    out = seen.withColumn("score", score(F.col("n_with"), F.col("n_without"), F.col("type"), words, finals))
    return out.where(F.col("score") >= threshold)


def collect_types(abbreviations: DataFrame) -> list[str]:
    """The learned types, for the split; more than MAX_TYPES are refused (raise ``min_count``)."""
    rows = abbreviations.select("type").limit(MAX_TYPES + 1).collect()
    if len(rows) > MAX_TYPES:
        raise ValueError(f"more than {MAX_TYPES} abbreviations; raise min_count")
    return sorted(r["type"] for r in rows)


def ends_in_abbreviation(part: Column, types: list[str]) -> Column:
    """Is the last word of ``part`` one of ``types`` and a period?"""
    if not types:
        return F.lit(False)
    end = F.translate(F.right(part, F.lit(LONGEST + 1)), WS_CHARS, " " * len(WS_CHARS))
    raw = F.substring_index(end, " ", -1)
    bare = F.when(F.length(raw) <= LONGEST, F.regexp_replace(F.lower(raw), LEAD, ""))
    return F.when(part.endswith("."), let(bare, lambda w: F.coalesce(
        w.rlike(FINAL) & F.regexp_replace(w, "\\.+$", "").isin(types), F.lit(False)))).otherwise(F.lit(False))
