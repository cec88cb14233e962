"""The comment cleaning chain, in the reference order:

C1 drop NULL comments -> I1 HTML unescape (title, parent, comment) -> B5 parent
NULL -> '' -> C4 language gate -> I2/I3 NFC + drop Cf (comment) -> I4
typographic (every string column) -> I5 control strip (every string column)
-> I6 URL mask (comment).

Only I1 and I2 run in Python (one fused Arrow UDF); the rest is native. A
text that neither can change (no ``&``, only code points that NFC leaves alone:
``text.needs_fix``) goes to Python as NULL and is kept as it is.
The language gate is a Column (e.g. a stored label or a model prediction);
when it does not read the UDF's output Catalyst evaluates it below the UDF,
so dropped rows never reach Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import (
    every_string, fix_encoding, has_entity, lang_text, mask_urls, needs_fix, strip_cf, strip_control, typographic,
)
from threadlens.session import staged

LangGate = Callable[[DataFrame], Column]


@dataclass(frozen=True)
class ModelGate:
    """Language gate from a trained model (``langid.WordNB``).

    The unescaped stage is written once (the Python UDF runs once), scored on
    the language-ID input form (newlines removed, lower-cased) and filtered.
    """
    model: object
    label: str = "en"
    text_col: str = "comment"

    def apply(self, df: DataFrame) -> DataFrame:
        from threadlens.operators.langid import predict_word_nb
        rows = staged(df.withColumn("_row", F.monotonically_increasing_id()), "gate")
        texts = rows.select("_row", lang_text(self.text_col).alias("_lt"))
        scored = predict_word_nb(self.model, texts, "_lt", "_row", out_col="_lang")
        kept = scored.where(F.col("_lang") == F.lit(self.label)).select("_row")
        return rows.join(kept, "_row", "left_semi").drop("_row")


def fix_and_gate(df: DataFrame, english: LangGate | ModelGate | None = None) -> DataFrame:
    """C1, I1, B5, C4, I2, I3 (the part that needs Python).

    The gate sees the unescaped comment, as in the reference.
    """
    cols = list(df.columns)
    df = df.where(F.col("comment").isNotNull())
    sent = [F.when(check(c), F.col(c)) for c, check in
            (("post_title", has_entity), ("parent_comment", has_entity), ("comment", needs_fix))]
    df = df.withColumn("_fx", fix_encoding(*sent))          # gives NULL only for NULL
    df = df.withColumns({
        "post_title": F.coalesce("_fx.post_title", "post_title"),
        "parent_comment": F.coalesce("_fx.parent_comment", "parent_comment", F.lit("")),
        "_nfc": F.coalesce("_fx.comment_nfc", "comment"),
        "comment": F.coalesce("_fx.comment", "comment"),
    })
    if isinstance(english, ModelGate):                      # a text that NFC left alone is staged once
        df = english.apply(df.withColumn("_nfc", F.nullif("_nfc", "comment")))
        df = df.withColumn("_nfc", F.coalesce("_nfc", "comment"))
    elif english is not None:
        df = df.where(english(df))
    df = df.withColumn("comment", strip_cf(F.col("_nfc")))
    return df.select(*cols)


def normalize_text(df: DataFrame) -> DataFrame:
    """I4, I5 on every string column, then I6 on the comment (native only)."""
    df = every_string(df, lambda c: strip_control(typographic(c)))
    return df.withColumn("comment", mask_urls("comment"))


def clean_comments(df: DataFrame, english: LangGate | ModelGate | None = None) -> DataFrame:
    return normalize_text(fix_and_gate(df, english))


def stored_label_gate(col: str = "lang", value: str = "en") -> LangGate:
    return lambda df: F.col(col) == F.lit(value)


def observe_parent_na(df: DataFrame, name: str = "parent_na"):
    """Data-quality metric: NULL parent texts *before* they are filled with ''.

    Returns ``(df, observation)``; ``observation.get`` is available after the
    first action on ``df`` (computed in the same pass, no extra job).
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count_if(F.col("parent_comment").isNull()).alias("num_na")), obs
