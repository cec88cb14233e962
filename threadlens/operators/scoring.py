"""Scoring stages (the scorer contract).

A scorer adds one score column and preserves row count and keys.
Thresholds, cascades, parsing and arbitration never live inside a scorer.

- ``ExprScorer``: the score is a native Column expression (codegen, no
  Python). Conditional use is ``when(mask, expr)``, which only evaluates the
  expression on masked rows.
- ``FrameScorer``: the score needs a DataFrame job (a Python model via
  ``predict_batch_udf``, a join against a trained profile...). Conditional
  use splits the rows, scores the masked part only and unions them back;
  the input is checkpointed first so upstream stages run once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.labels import sigmoid
from threadlens.session import cut_lineage


@dataclass(frozen=True)
class ExprScorer:
    out_col: str
    expr: Callable[[DataFrame], Column]

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.out_col, self.expr(df))

    def score_where(self, df: DataFrame, mask: Column) -> DataFrame:
        return df.withColumn(self.out_col, F.when(mask, self.expr(df)))


@dataclass(frozen=True)
class FrameScorer:
    out_col: str
    fn: Callable[[DataFrame], DataFrame]
    out_type: T.DataType

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.fn(df)

    def score_where(self, df: DataFrame, mask: Column) -> DataFrame:
        df = cut_lineage(df.withColumn("_mask", F.coalesce(mask, F.lit(False))))
        hit = self.fn(df.where(F.col("_mask")))
        miss = df.where(~F.col("_mask")).withColumn(
            self.out_col, F.lit(None).cast(self.out_type))
        return hit.unionByName(miss).drop("_mask")


def _given(given: Mapping[str, Sequence[Sequence[float]]], k) -> Column:
    """What the row's codes add to slot ``k``: per code column (entity_id,
    final_aspect_ids) a row of weights for each code; an unknown code adds 0."""
    z = F.lit(0.0)
    for col, rows in given.items():
        m = F.array(*[F.array(*[F.lit(float(w)) for w in r]) for r in rows])
        z = z + F.coalesce(F.get(F.get(m, F.col(col)), k), F.lit(0.0))
    return z


def linear_slots(vec_col: str, out_col: str, slots: Sequence[int], scale: float,
                 bias: float = 0.0, link: str = "sigmoid",
                 given: Mapping[str, Sequence[Sequence[float]]] | None = None) -> ExprScorer:
    """score[k] = link(scale * vec[slots[k]] + bias + given weights); vector cast to double."""
    def expr(df: DataFrame) -> Column:
        v = F.col(vec_col)
        idx = F.array(*[F.lit(int(s)) for s in slots])

        def one(i, k):
            z = F.lit(float(scale)) * v[i].cast("double") + F.lit(float(bias))
            if given:
                z = z + _given(given, k)
            return sigmoid(z) if link == "sigmoid" else z
        return F.transform(idx, one)
    return ExprScorer(out_col, expr)


def lexicon(text_col: str, out_col: str, weights: Mapping[str, Mapping[str, float]],
            labels: Sequence[str], bias: float = 0.0, link: str = "sigmoid",
            given: Mapping[str, Sequence[Sequence[float]]] | None = None) -> ExprScorer:
    """Per label: link(bias + sum of weights of terms contained in the text + given weights).

    The lexicon is configuration of bounded size and is inlined as literals.
    """
    def expr(df: DataFrame) -> Column:
        low = F.lower(F.col(text_col))
        outs = []
        for k, lab in enumerate(labels):
            terms = weights.get(lab, {})
            z = F.lit(float(bias))
            for term, w in terms.items():
                z = z + F.when(low.contains(term.lower()), F.lit(float(w))).otherwise(F.lit(0.0))
            if given:
                z = z + _given(given, F.lit(k))
            outs.append(sigmoid(z) if link == "sigmoid" else z)
        return F.array(*outs)
    return ExprScorer(out_col, expr)


def external(out_col: str, make_predict_fn: Callable, input_cols: Sequence[str],
             return_type: T.DataType, batch_size: int = 32) -> FrameScorer:
    """Adapter for a user's own model: loaded once per Python worker,
    called on Arrow batches of ``batch_size`` rows."""
    from pyspark.ml.functions import predict_batch_udf
    udf = predict_batch_udf(make_predict_fn, return_type=return_type, batch_size=batch_size)

    def fn(df: DataFrame) -> DataFrame:
        return df.withColumn(out_col, udf(*[F.col(c) for c in input_cols]))
    return FrameScorer(out_col, fn, return_type)
