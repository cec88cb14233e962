"""Text cleaning expressions.

All are native Spark expressions (codegen) except ``html_unescape`` and
``nfc``, which have no Spark built-in and run as one Arrow-batched pandas UDF.
Regexes use ``(?U)`` so that ``\\s``/``\\S`` are Unicode-aware like Python's.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.schemas import CONTEXT_MARKER, NA_LITERALS

# Typographic characters and their ASCII replacements.
TYPO_SINGLE_FROM = "\u201c\u201d\u2018\u2019\u2013"   # “ ” ‘ ’ –
TYPO_SINGLE_TO = "\"\"''-"
TYPO_ELLIPSIS = "\u2026"  # …
# C0 and C1 control characters plus DEL.
CONTROL_CLASS = "[\\x00-\\x1f\\x7f-\\x9f]"
URL_PATTERN = "(?U)http[s]?://\\S+"
URL_TOKEN = "[URL]"
# ASCII punctuation (Python's string.punctuation) as a character class.
PUNCT_CLASS = "[!-/:-@\\[-`{-~]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_cf(c) -> Column:
    """Remove Unicode format characters (category Cf)."""
    return F.regexp_replace(_c(c), "\\p{Cf}", "")


def typographic(c) -> Column:
    """Curly quotes, en dash and ellipsis to ASCII."""
    return F.replace(F.translate(_c(c), TYPO_SINGLE_FROM, TYPO_SINGLE_TO),
                     F.lit(TYPO_ELLIPSIS), F.lit("..."))


def strip_control(c) -> Column:
    """Delete control characters; newlines vanish without a space."""
    return F.regexp_replace(_c(c), CONTROL_CLASS, "")


def mask_urls(c) -> Column:
    return F.regexp_replace(_c(c), URL_PATTERN, URL_TOKEN)


def ends_with_punct(c) -> Column:
    """True when the stripped text ends in ASCII punctuation; blank/NULL -> False."""
    return F.coalesce(_c(c).rlike("(?U)" + PUNCT_CLASS + "\\s*$"), F.lit(False))


def normalize_na(c, na_values=NA_LITERALS) -> Column:
    """Literal NA tokens (read_csv's default set) to NULL."""
    col = _c(c)
    return F.when(col.isin(list(na_values)), F.lit(None).cast("string")).otherwise(col)


def lang_text(c) -> Column:
    """Input form for language ID: newlines removed, lower-cased."""
    return F.lower(F.replace(_c(c), F.lit("\n"), F.lit("")))


def every_string(df: DataFrame, fn) -> DataFrame:
    """Apply ``fn`` to every StringType column, keeping column order."""
    return df.select([
        fn(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def context_concat(parent, child) -> Column:
    """parent + ('' if parent ends in punctuation else '.') + ' [NEXT_COMMENT] ' + child."""
    p = _c(parent)
    return F.concat(p, F.when(ends_with_punct(p), F.lit("")).otherwise(F.lit(".")),
                    F.lit(" " + CONTEXT_MARKER + " "), _c(child))


def recover_child(c) -> Column:
    """Text between the first and second marker; marker absent -> whole string."""
    col = _c(c)
    piece = F.try_element_at(
        F.split(col, "\\[NEXT_COMMENT\\] "), F.lit(2))
    return F.coalesce(piece, col)


# --- Python side (no Spark built-in): HTML unescape and NFC ----------------

# Ranges of code points that NFC leaves as they are, beside each other as well: none is
# decomposed, reordered or the second half of a composition (checked one by one in the tests).
NFC_STABLE = [
    (0x0, 0x2FF), (0x370, 0x373), (0x388, 0x3FF), (0x400, 0x482), (0x48A, 0x530), (0x531, 0x58A), (0x5D0, 0x5EA),
    (0x620, 0x64A), (0x1E00, 0x1EFF), (0x2002, 0x20CF), (0x2190, 0x21FF), (0x2200, 0x22FF), (0x2300, 0x2328),
    (0x232B, 0x2ADB), (0x3001, 0x3029), (0x3030, 0x3096), (0x30A0, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7A3),
    (0xFF01, 0xFFEF), (0x1F000, 0x1FAFF)]
_NOT_STABLE = "[^" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in NFC_STABLE) + "]"


def has_entity(c) -> Column:
    """May HTML unescape change the text? Every entity starts with ``&``."""
    return _c(c).contains("&")


def needs_fix(c) -> Column:
    """May HTML unescape or NFC change the text? False proves that neither does."""
    return has_entity(c) | _c(c).rlike(_NOT_STABLE)


@F.pandas_udf(T.StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: html.unescape(x) if isinstance(x, str) else None)


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x) if isinstance(x, str) else None)


_FIX = T.StructType([
    T.StructField("post_title", T.StringType()),
    T.StructField("parent_comment", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("comment_nfc", T.StringType()),
])


@F.pandas_udf(_FIX)
def fix_encoding(title: pd.Series, parent: pd.Series, comment: pd.Series) -> pd.DataFrame:
    """One Python pass for the three unescapes plus NFC of the comment. NULLs stay NULL."""
    def un(x):
        return html.unescape(x) if isinstance(x, str) else None
    c = comment.map(un)
    return pd.DataFrame({
        "post_title": title.map(un),
        "parent_comment": parent.map(un),
        "comment": c,
        "comment_nfc": c.map(
            lambda x: unicodedata.normalize("NFC", x) if isinstance(x, str) else None),
    })
