"""Helpers for higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda variable.

    Expressions captured inside a lambda are re-evaluated for every element,
    and Catalyst inlines staged columns into lambdas; the initial value of a
    fold is bound only once, so this keeps per-row work linear.
    """
    return F.aggregate(F.array(F.lit(0)), value, lambda acc, _: acc, body)
