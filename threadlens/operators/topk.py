"""Gated top-k, recency filters and reproducible sampling.

Per-group ranks use ``row_number`` followed by a ``<= k`` filter, which
Spark plans with a partial ``WindowGroupLimit`` before the shuffle: a hot
group (one topic holding a third of the rows) ships at most k rows per map
task instead of all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions.labels import score_of_label
from threadlens.schemas import RELEVANCE_MIN


def _rank(group: Sequence[str], order: Sequence[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*group).orderBy(*order))


def gated_top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                candidates: int, passes: Column) -> DataFrame:
    """Examine the first ``candidates`` per group in ``order``; keep the first
    ``k`` of them for which ``passes`` holds. Adds ``rank`` (1..k)."""
    cand = df.withColumn("_cand", _rank(group, order)).where(F.col("_cand") <= candidates)
    ok = cand.where(F.coalesce(passes, F.lit(False)))
    kept = ok.withColumn("rank", _rank(group, [F.col("_cand")])).where(F.col("rank") <= k)
    return kept.drop("_cand")


def relevance_top_k(df: DataFrame, topic_col: str, votes_col: str, id_col: str,
                    label: str | Column, k: int, candidates: int,
                    min_score: float = RELEVANCE_MIN) -> DataFrame:
    """Per topic, top posts by votes whose relevance score for ``label`` (a name, or a
    column that names one) >= min."""
    passes = score_of_label("labels", "scores", label) >= F.lit(min_score)
    return gated_top_k(df, [topic_col], [F.col(votes_col).desc(), F.col(id_col)], k,
                       candidates, passes)


def recent(df: DataFrame, ts_col: str, as_of, days: int = 7) -> DataFrame:
    """Rows with ``ts >= as_of - days`` on real timestamps; ``as_of`` is explicit."""
    as_of_c = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    return df.where(F.col(ts_col) >= as_of_c - F.make_dt_interval(F.lit(days)))


def recent_quota(videos: DataFrame, comments: DataFrame, query_col: str, id_col: str,
                 ts_col: str, order: Sequence[Column], as_of, n: int,
                 days: int = 7, comment_key: str | None = None) -> DataFrame:
    """First ``n`` recent videos per query (in ``order``) that have >= 1 comment."""
    r = recent(videos, ts_col, as_of, days)
    ck = comment_key or id_col
    r = r.join(comments.select(F.col(ck).alias(id_col)).distinct(), id_col, "left_semi")
    return r.withColumn("rank", _rank([query_col], order)).where(F.col("rank") <= n)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Reproducible sample of ``n`` rows: smallest xxhash64(key, seed).

    A global top-n (``TakeOrderedAndProject``): each task keeps n rows.
    """
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(n)
