"""Operator 1, exact top-k inner products over norm-sorted blocks.

Vectors become integers floor(scale * x); scores are integer inner products.
Candidates lie in blocks of falling length, sorted by length inside. Queries
(rows whose id is divisible by ``every``) first meet the longest block, which
gives each a score that k candidates reach; with it, queries meet the other
blocks. There, lengths end the scan (Cauchy-Schwarz), then a partial sum over
the leading axes of an SVD rotation plus the product of the residual lengths
bounds each score from above, and only candidates that can still enter the
list are scored exactly. Blocks are joined by their number; no vector table is
broadcast or collected (only the d x d second moments, from which the rotation
comes).

Vectors that are null, or hold null, NaN or infinite components, take no part,
nor do rows without id. Shorter vectors count as padded with zeros. A row never
answers a query of its own id; repeated rows are queries and candidates each.
Ties go to the smaller id. Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from threadlens.llm import common as C

BLOCK, QUERIES = 4096, 1024


def _integers(table: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    x = F.col(vec_col)
    fine = F.forall(x, lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) <
                                                                        F.lit(float("inf"))), F.lit(False)))
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return (table.where(F.col(id_col).isNotNull() & x.isNotNull() & fine)
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0),
                                                   lambda a, c: a + c.cast("double") * c.cast("double")))))


def _matrix(col, dim: int) -> np.ndarray:
    out = np.zeros((len(col), dim), dtype=np.int64)
    size = np.diff(np.asarray(col.offsets))
    flat = np.asarray(col.flatten())
    row = np.repeat(np.arange(len(col)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of the table, from its summed second moments."""
    def moments(batches):
        m = np.zeros((dim, dim))
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                a = _matrix(batch.column(0).slice(lo, 4096), dim).astype(np.float64)
                m += a.T @ a
        yield pa.RecordBatch.from_pydict({"cell": np.arange(dim * dim), "x": m.ravel()})

    cells = (vectors.select("v").mapInArrow(moments, "cell long, x double")
             .groupBy("cell").agg(F.sum("x").alias("x")).toPandas())
    m = np.zeros(dim * dim)
    m[cells["cell"].to_numpy(dtype=np.int64)] = cells["x"].to_numpy()
    values, axes = np.linalg.eigh(m.reshape(dim, dim))
    return np.ascontiguousarray(axes[:, ::-1])


def _packed(vectors: DataFrame, dim: int) -> DataFrame:
    """Blocks: (block, ids and vectors as bytes), longest vectors first."""
    def run(key, table):
        norm = np.asarray(table.column("norm"))
        ids = np.asarray(table.column("id"))
        order = np.lexsort((ids, -norm))
        v = _matrix(table.column("v").combine_chunks(), dim)[order]
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()),
                         "data": pa.array([C.blob(ids[order], v.astype(np.int64))], pa.binary())})

    return vectors.groupBy("block").applyInArrow(run, "block long, data binary")


def _search(ids, v, q_ids, q, floor, rotation, k):
    """Top k of a block for each query, as (query row, id, score); candidates
    that score below the query's floor are left out."""
    dim = v.shape[1]
    exact = np.float64 if (np.abs(v).max(initial=0) * float(np.abs(q).max(initial=0)) * dim) < 2 ** 52 else np.int64
    vx, qx = v.astype(exact), q.astype(exact)
    vr, qr = v @ rotation, q @ rotation
    lead = max(1, dim // 4)
    v_tail = np.sqrt((vr[:, lead:] ** 2).sum(1))
    q_tail = np.sqrt((qr[:, lead:] ** 2).sum(1))
    v_norm, q_norm = np.sqrt((vr ** 2).sum(1)), np.sqrt((qr ** 2).sum(1))
    out = []
    for a in range(0, len(q), 256):
        rows = slice(a, min(a + 256, len(q)))
        low = floor[rows].copy()                             # a score that k candidates reach, or -inf
        best = np.zeros((0, 3), dtype=np.int64)              # (row, score, id)
        for b in range(0, len(v), 1024):
            cols = slice(b, min(b + 1024, len(v)))
            slack = 1e-9 * (1 + q_norm[rows] * v_norm[b])
            live = np.flatnonzero(q_norm[rows] * v_norm[b] + slack >= low)
            if not len(live):
                break                                        # lengths only fall from here
            top = (qr[rows][live, :lead] @ vr[cols, :lead].T + np.outer(q_tail[rows][live], v_tail[cols])
                   + slack[live, None])
            i, j = np.nonzero(top >= low[live, None])
            if len(i) * 4 > top.size:
                s = (qx[rows][live] @ vx[cols].T)[i, j]
            else:
                s = np.concatenate([np.einsum("xy,xy->x", qx[rows][live[i[x:x + 65536]]], vx[cols][j[x:x + 65536]])
                                    for x in range(0, len(i), 65536)] or [np.zeros(0)])
            s = s.astype(np.int64)
            i = live[i]
            ok = (s >= low[i]) & (ids[cols][j] != q_ids[rows][i])
            best = np.concatenate([best, np.stack([i[ok], s[ok], ids[cols][j[ok]]], axis=1)])
            order = np.lexsort((best[:, 2], -best[:, 1], best[:, 0]))
            best = best[order]
            rank = np.arange(len(best)) - np.searchsorted(best[:, 0], best[:, 0])
            best = best[rank < k]
            full = np.flatnonzero(rank[rank < k] == k - 1)
            low[best[full, 0]] = np.maximum(low[best[full, 0]], best[full, 1])
        out.append(best + np.array([a, 0, 0]))
    return np.concatenate(out) if out else np.zeros((0, 3), dtype=np.int64)


HIT = "qblock long, qrow long, query_id long, score long, vec_id long"


def top_inner_products(table: DataFrame, k: int = 20, every: int = 20, scale: int = 64,
                       id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best."""
    base = C.stage(_integers(table, id_col, vec_col, scale), "vectors")
    n, dim, queries = base.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)), F.sum(
        F.when(F.pmod("id", F.lit(every)) == 0, 1).otherwise(0))).first()
    dim = max(int(dim), 1)
    rotation = _rotation(base, dim)
    bins = max(1, min(256, math.ceil(n / BLOCK)))
    bounds = base.approxQuantile("norm", [1 - i / bins for i in range(1, bins)], 0.1 / bins) if bins > 1 else []
    subs = max(1, math.ceil(n / bins / BLOCK))
    level = F.lit(0)                                         # number of bounds above the vector's length
    if bounds:
        level = F.size(F.filter(F.array(*[F.lit(float(b)) for b in sorted(set(bounds), reverse=True)]),
                                lambda b: b > F.col("norm")))
    blocks = C.stage(_packed(base.withColumn("block", level.cast("long") * subs +
                                             F.pmod(F.xxhash64("id"), F.lit(subs))), dim), "blocks")
    many = max(1, math.ceil((queries or 0) / QUERIES))
    asked = C.stage(_packed(base.where(F.pmod("id", F.lit(every)) == 0)
                            .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(many))), dim)
                    .withColumnRenamed("block", "qblock").withColumnRenamed("data", "q"), "queries")
    known = [r[0] for r in blocks.select("block").orderBy("block").limit(1).collect()]
    head = known[0] if known else 0

    def hits(batches):
        for batch in batches:
            for x in range(batch.num_rows):
                ids, v = C.unblob(batch.column(1)[x].as_py(), np.int64, np.int64)
                q_ids, q = C.unblob(batch.column(2)[x].as_py(), np.int64, np.int64)
                floor = np.full(len(q_ids), -np.inf)
                if batch.num_columns > 3 and batch.column(3)[x].is_valid:
                    row, least = C.unblob(batch.column(3)[x].as_py(), np.int64, np.int64)
                    floor[row] = least
                got = _search(ids, v.reshape(-1, dim), q_ids, q.reshape(-1, dim), floor, rotation, k)
                yield pa.RecordBatch.from_pydict({
                    "qblock": np.full(len(got), batch.column(0)[x].as_py()), "qrow": got[:, 0],
                    "query_id": q_ids[got[:, 0]], "score": got[:, 1], "vec_id": got[:, 2]})

    first = C.stage(asked.withColumn("block", F.lit(head).cast("long")).join(blocks, "block")
                    .select("qblock", "data", "q").mapInArrow(hits, HIT), "head")
    place = W.partitionBy("qblock", "qrow").orderBy(F.desc("score"), "vec_id")
    # the k-th score of each query that has one, packed by query block
    floors = (first.withColumn("r", F.row_number().over(place)).where(F.col("r") == k)
              .groupBy("qblock").applyInArrow(
                  lambda key, t: pa.table({"qblock": pa.array([key[0].as_py()], pa.int64()), "floor": pa.array(
                      [C.blob(np.asarray(t.column("qrow")), np.asarray(t.column("score")))], pa.binary())}),
                  "qblock long, floor binary"))
    pairs = asked.select("qblock", F.explode(F.sequence(F.lit(0), F.lit(bins * subs))).alias("block"))
    rest = (pairs.withColumn("block", F.col("block").cast("long")).where(F.col("block") != head)
            .join(blocks, "block").join(asked, "qblock").join(floors, "qblock", "left")
            .select("qblock", "data", "q", "floor").mapInArrow(hits, HIT))
    return (first.unionByName(rest).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
