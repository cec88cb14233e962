"""Lookup joins that split hot keys.

A lookup join probes a table that has one row per key (a parent, an
ancestor) with many rows per key (replies). If one key holds a large share
of the probe rows (a viral comment), a shuffle join sends all of them to one
task. ``lookup_join`` finds the keys holding more than ``1/max_hot`` of the
probe rows (and at least ``min_rows``), joins those rows against a broadcast
of just their lookup rows (at most ``max_hot`` rows: a proven size bound)
without shuffling them, and shuffle-joins everything else. Rows without a key
(the roots of a forest, often its largest group) match nothing; in the shuffle
they are dealt over ``NULL_SLOTS`` slots instead of meeting in one task. AQE's skew join
remains enabled as a second line of defence.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT = 1000
NULL_SLOTS = 1024
MIN_HOT_ROWS = 100_000
SPLITS: deque[int] = deque(maxlen=1000)  # hot-key counts of recent calls (diagnostics)


def hot_keys(df: DataFrame, key: str, n_rows: int, max_hot: int | None = None,
             min_rows: int | None = None) -> list:
    """Keys with more than max(min_rows, n_rows / max_hot) rows (at most max_hot)."""
    max_hot = MAX_HOT if max_hot is None else max_hot
    min_rows = MIN_HOT_ROWS if min_rows is None else min_rows
    threshold = max(min_rows, n_rows // max_hot)
    if n_rows <= threshold:
        return []
    counts = (df.where(F.col(key).isNotNull()).groupBy(key)
                .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > threshold))
    return [r[0] for r in counts.select(key).limit(max_hot).collect()]


def lookup_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                how: str = "left", n_left: int | None = None, max_hot: int | None = None,
                min_rows: int | None = None, hot: list | None = None) -> DataFrame:
    """``left`` join ``right`` on left_key = right_key with hot keys split off.

    ``right`` should hold one row per key (any duplicates multiply rows in
    both paths alike, so the result equals the plain join regardless).
    ``n_left`` (the probe row count) sets the hot threshold; when it is not
    given, ``left`` is counted, which costs a pass over it, so callers that
    staged ``left`` pass the count they observed while writing it. ``hot``
    passes keys already found on a staged table with the same key
    distribution (detection then costs nothing here).
    """
    cond = F.col(left_key) == F.col(right_key)

    def shuffled(a: DataFrame, b: DataFrame) -> DataFrame:
        # the slot is 0 for rows with a key on both sides, so it never parts a match
        a = a.withColumn("_lslot", F.when(F.col(left_key).isNull(), F.pmod(
            F.monotonically_increasing_id(), F.lit(NULL_SLOTS))).otherwise(F.lit(0)).cast("int"))
        # always 0, but no constant: a constant would stop being a join key
        b = b.withColumn("_rslot", F.pmod(F.xxhash64(F.col(right_key)), F.lit(1)).cast("int"))
        return a.join(b, cond & (F.col("_lslot") == F.col("_rslot")), how).drop("_lslot", "_rslot")

    if hot is None:
        if n_left is None:
            n_left = left.count()
        hot = hot_keys(left, left_key, n_left, max_hot, min_rows)
    SPLITS.append(len(hot))
    if not hot:
        return shuffled(left, right)
    is_hot = F.col(left_key).isin(hot)
    hot_right = right.where(F.col(right_key).isin(hot))        # <= len(hot) rows
    hot_part = left.where(is_hot).join(F.broadcast(hot_right), cond, how)
    cold_part = shuffled(left.where(~is_hot | F.col(left_key).isNull()),
                         right.where(~F.col(right_key).isin(hot) | F.col(right_key).isNull()))
    return hot_part.unionByName(cold_part)
