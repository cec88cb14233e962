"""Keep-first dedup and incremental append.

Keep-first is a grouped ``min_by`` rather than a window: the aggregate is
combined map-side, so a key holding a third of all rows is reduced to one row
per map task before the shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the one with the smallest ``order`` (must be total).

    NULL keys form one group, like pandas ``drop_duplicates``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]),
                 F.struct(*[F.col(c) for c in order])).alias("_first"))
    return picked.select(*keys, "_first.*").select(*df.columns)


MAX_BUCKETS = 65_536


def key_bucket(key: str, n_buckets: int) -> F.Column:
    """Stable bucket of a key, for laying out an append-only table."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n_buckets)).cast("int")


def incremental_append(stored: DataFrame, arriving: DataFrame, key: str,
                       order: Sequence[str], bucket_col: str | None = None
                       ) -> tuple[DataFrame, DataFrame]:
    """Append only unseen keys; stored rows win over newer duplicates.

    Returns ``(appended_rows, updated_table)``. Equivalent to anti-joining per
    (group, key) and then keeping the first row per key over stored-then-new:
    a new row whose key is already stored under another group is dropped by
    that dedup anyway. A NULL key counts as one key, stored once. Only the key column of ``stored`` is read; with
    ``stored`` bucketed on ``key`` the anti-join needs no shuffle of it, and
    Spark's runtime bloom filter prunes its scan by the arriving keys.
    Running it twice with the same batch appends nothing the second time.

    With ``bucket_col`` (a partition column of ``stored`` derived from the key,
    see ``key_bucket``), only the stored buckets the batch touches are read:
    the bucket ids (at most the table's bucket count) become a partition
    filter, so a small batch never scans the whole table.
    """
    stored_keys = stored
    if bucket_col is not None:
        touched = [r[0] for r in arriving.select(bucket_col).distinct().limit(MAX_BUCKETS + 1)
                   .collect()]
        if len(touched) <= MAX_BUCKETS:                      # else the whole key column is read
            stored_keys = stored.where(F.col(bucket_col).isin(touched))
    known = stored_keys.select(F.col(key).alias("_known"))
    fresh = arriving.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    fresh = keep_first(fresh, [key], order).select(*stored.columns)
    return fresh, stored.unionByName(fresh)
