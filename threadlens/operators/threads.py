"""Thread depth and level-ordered context propagation.

``assign_levels`` uses pointer doubling: every node keeps a pointer to an
ancestor and the distance to it; each round replaces the pointer by the
pointer's pointer, so a thread of depth D is resolved in ceil(log2 D)+1
rounds of one equi-join each (no per-level driver loop, no recursion limit).
Nodes never reaching a root (parent cycles and everything below them) get
``level = NULL`` and ``unreachable = true``; the loop always ends.

``thread_context`` is inherently sequential by level (a reply's context is
its parent's *resolved* text). The input is written once partitioned by
level, so each round reads one partition and joins it with the previous
round's (staged) output: total join work is O(rows), D small jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import context_concat, recover_child
from threadlens.operators.joins import lookup_join
from threadlens.schemas import DELETED
from threadlens.session import cut_lineage, scratch_path, staged


SCOPE = "platform"


def _scoped(df: DataFrame, col: str) -> Column:
    """An id within its platform (ids of two platforms may be equal); NULL stays."""
    c = F.col(col).cast("string")
    if SCOPE not in df.columns:
        return c
    return F.concat(F.coalesce(F.col(SCOPE).cast("string"), F.lit("")), F.lit("\u0001"), c)


def _edges(df: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    # One parent per id (ids are expected unique; duplicates keep the smallest).
    return (df.select(_scoped(df, id_col).alias("id"), _scoped(df, parent_col).alias("parent"))
              .where(F.col("id").isNotNull())
              .groupBy("id").agg(F.min("parent").alias("parent")))


def _cut_counting_open(state: DataFrame) -> tuple[DataFrame, int]:
    """Checkpoint the state and count its open rows in the same pass."""
    from pyspark.sql import Observation
    obs = Observation()
    cut = cut_lineage(state.observe(obs, F.count_if(F.col("anc").isNotNull()).alias("open")))
    return cut, int(obs.get["open"])


def level_table(df: DataFrame, id_col: str = "comment_id",
                parent_col: str = "parent_comment_id") -> DataFrame:
    """(_node, level, unreachable) for every distinct id of ``df`` (per platform)."""
    from pyspark.sql import Observation
    obs = Observation()
    edges = cut_lineage(_edges(df, id_col, parent_col).observe(obs, F.count(F.lit(1)).alias("n")))
    members = edges.select(F.col("id").alias("_m"))
    # Roots: no parent, or a parent that is not among the ids (orphans).
    # Keyed by parent, so a comment with a huge number of replies is a hot key.
    state = (lookup_join(edges, members, "parent", "_m", "left", n_left=int(obs.get["n"]))
                  .select("id",
                          F.when(F.col("_m").isNotNull(), F.col("parent")).alias("anc"),
                          F.lit(1).cast("int").alias("d")))
    state, n_open = _cut_counting_open(state)
    prev_open = None
    while True:
        if n_open == 0 or n_open == prev_open:
            break  # all resolved, or only cycle-bound nodes remain
        prev_open = n_open
        open_rows = state.where(F.col("anc").isNotNull())
        right = state.select(F.col("id").alias("_rid"), F.col("anc").alias("_ranc"),
                             F.col("d").alias("_rd"))
        # many open nodes can share one ancestor: split hot ancestors off
        jumped = (lookup_join(open_rows, right, "anc", "_rid", "inner", n_left=n_open)
                  .select("id", F.col("_ranc").alias("anc"), (F.col("d") + F.col("_rd")).alias("d")))
        state, n_open = _cut_counting_open(state.where(F.col("anc").isNull()).unionByName(jumped))
    return state.select(
        F.col("id").alias("_node"),
        F.when(F.col("anc").isNull(), F.col("d")).alias("level"),
        F.col("anc").isNotNull().alias("unreachable"))


def assign_levels(df: DataFrame, id_col: str = "comment_id",
                  parent_col: str = "parent_comment_id") -> DataFrame:
    """Add ``level`` (root = 1) and ``unreachable`` to every row of ``df``."""
    lv = level_table(df, id_col, parent_col)
    return df.withColumn("_node", _scoped(df, id_col)).join(lv, "_node", "left").drop("_node")


def orphan_roots(df: DataFrame, id_col: str = "comment_id",
                 parent_col: str = "parent_comment_id", n_rows: int | None = None) -> DataFrame:
    """Rows whose parent id is set but names no surviving row (they become roots).

    ``n_rows`` (rows of ``df``, an upper bound of the probe side) skips a count.
    """
    ids = df.select(_scoped(df, id_col).alias("_m")).distinct()
    probe = df.where(F.col(parent_col).isNotNull()).withColumn("_parent", _scoped(df, parent_col))
    return lookup_join(probe, ids, "_parent", "_m", "left_anti", n_left=n_rows).drop("_parent")


def identity_rewrite(combined: Column) -> Column:
    return combined


def thread_context(df: DataFrame, rewrite: Callable[[Column], Column] = identity_rewrite,
                   id_col: str = "comment_id", parent_col: str = "parent_comment_id",
                   text_col: str = "comment", order_col: str | None = None,
                   out_col: str = "comment_after_coref") -> DataFrame:
    """Level-ordered propagation of resolved parent text.

    Level 1 keeps its raw parent text; deeper levels take the parent's
    resolved text from the previous level (missing -> '', '[deleted]' kept).
    Each row's context is ``parent + sep + ' [NEXT_COMMENT] ' + comment``,
    passed through ``rewrite`` and cut back to the child part.
    Requires ``level`` (from ``assign_levels``); rows without a level get NULL.
    """
    spark = df.sparkSession
    if "level" not in df.columns:
        raise ValueError("thread_context needs a 'level' column (assign_levels)")
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    base = df.withColumn("_ord", order)
    path = scratch_path(spark, "levels")
    base.write.option("compression", "zstd").partitionBy("level").parquet(path)
    base = spark.read.parquet(path)
    stats = (base.where(F.col("level").isNotNull()).groupBy("level")
             .agg(F.count(F.lit(1)).alias("n"), F.count_distinct(_scoped(base, id_col)).alias("ids"))
             .collect())                                   # at most max-depth rows
    sizes = {r["level"]: r["n"] for r in stats}
    unique = {r["level"]: r["n"] == r["ids"] for r in stats}
    levels = sorted(sizes)
    cols = [c for c in base.columns]
    done: list[DataFrame] = []
    prev: DataFrame | None = None
    prev_lvl = None
    for lvl in levels:
        cur = base.where(F.col("level") == lvl)
        if prev is not None:
            if unique[prev_lvl]:
                lookup = prev.select(_scoped(prev, id_col).alias("_pid"), F.col(out_col).alias("_ptext"))
            else:   # duplicate ids: the last row (by order) wins
                lookup = (prev.groupBy(_scoped(prev, id_col).alias("_pid"))
                              .agg(F.max_by(F.col(out_col), F.col("_ord")).alias("_ptext")))
            cur = lookup_join(cur.withColumn("_parent", _scoped(cur, parent_col)), lookup, "_parent", "_pid",
                              "left", n_left=sizes[lvl])
            use_lookup = F.coalesce(F.col("parent_comment") != F.lit(DELETED), F.lit(True))
            cur = cur.withColumn(
                "parent_comment",
                F.coalesce(F.when(use_lookup, F.col("_ptext"))
                           .otherwise(F.col("parent_comment")), F.lit("")))
            cur = cur.select(*cols)
        combined = context_concat(F.col("parent_comment"), F.col(text_col))
        cur = cur.withColumn(out_col, recover_child(rewrite(combined)))
        cur = staged(cur, "level")
        done.append(cur)
        prev, prev_lvl = cur, lvl
    unplaced = base.where(F.col("level").isNull()).withColumn(
        out_col, F.lit(None).cast("string"))
    out = unplaced
    for part in done:
        out = out.unionByName(part)
    return out.drop("_ord").select(*df.columns, out_col)
