"""Gazetteer mentions: contains-any flags, matched terms, antichain reduction.

Term lists are configuration (bounded; their size is checked before they are
inlined). Lists of every size take one path: a JVM higher-order expression over
the array of terms, without Python.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.hof import let

TERMS_MAX = 1_000_000  # refuse to inline/broadcast unbounded term lists


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reduce_antichain(terms: Iterable[str]) -> list[str]:
    """Lower-case, dedup, and drop every term that contains another term.

    Under contains-any matching a super-string is redundant, so the flags are
    identical with the reduced list.
    """
    low = sorted({t.lower() for t in terms if t is not None and t != ""}, key=len)
    kept: list[str] = []
    for t in low:
        if not any(k in t for k in kept):
            kept.append(t)
    return sorted(kept)


def collect_terms(spark: SparkSession, terms: DataFrame, col: str = "term") -> list[str]:
    """Bring a (checked) bounded term list to the driver."""
    n = terms.count()
    if n > TERMS_MAX:
        raise ValueError(f"gazetteer has {n} terms (> {TERMS_MAX}); refusing to inline")
    return [r[0] for r in terms.select(col).collect()]


def contains_any(text, terms: Iterable[str], word_boundary: bool = False) -> Column:
    """1 if the lower-cased text contains any term (case-insensitive substring), else 0."""
    col = _c(text)
    if word_boundary:
        # the antichain reduction only holds for substring matching
        import re
        full = sorted({t.lower() for t in terms if t}, key=lambda t: (-len(t), t))
        pattern = "(?i)\\b(" + "|".join(re.escape(t) for t in full) + ")\\b"
        return F.when(col.isNotNull(), col.rlike(pattern).cast("int"))
    low = reduce_antichain(terms)
    if len(low) > TERMS_MAX:
        raise ValueError(f"{len(low)} terms (> {TERMS_MAX})")
    arr = F.array(*[F.lit(t) for t in low])
    return F.when(col.isNotNull(), let(F.lower(col), lambda lowered: F.exists(
        arr, lambda t: lowered.contains(t)).cast("int")))


def matched_terms(text, terms: Iterable[str]) -> Column:
    """Distinct lower-cased terms (unreduced list, sorted) found in the text."""
    low = sorted({t.lower() for t in terms if t})
    if len(low) > TERMS_MAX:
        raise ValueError("term list too large to inline")
    arr = F.array(*[F.lit(t) for t in low])
    return let(F.lower(_c(text)), lambda lowered: F.filter(arr, lambda t: lowered.contains(t)))


def mention_flags(df: DataFrame, text_col: str, gazetteers: dict[str, list[str]]) -> DataFrame:
    """Add one 0/1 flag column per gazetteer (computed once, after threads)."""
    return df.withColumns({name: contains_any(text_col, terms)
                           for name, terms in gazetteers.items()})
