"""Levels and context kept up to date while comments arrive.

A micro-batch changes only the threads it touches: an arriving comment, and every
stored one below it (replies can arrive before what they answer). ``apply_batch``
finds these by frontier joins, loads what the threads need around them, and
computes level and context anew for them alone.

Two tables, Parquet, each batch a folder ``epoch=N`` with partitions ``_bucket``:

- ``edges``: (_node, _up) of each comment with a parent, by bucket of the parent:
  who answers a given comment;
- ``rows``: each comment with ``level``, ``unreachable``, the parent text used and
  the context, by bucket of its own id; a comment's newest epoch holds.

Only buckets that hold a key asked for are read. A batch reads epochs before its
own and overwrites its own, so one that is run again leaves the same tables. The
stream itself keeps no state.

An id's first arrival is kept; later ones are dropped, as are rows without id. A
comment whose parent never arrives is a root, until it arrives. Comments in a
cycle of parents, and those below, have no level and no context. Rules for text
and context are those of ``operators.threads.thread_context``. Large first loads
belong into one batch job (``assign_levels``, ``thread_context``): a batch here
takes one small job a round, as many rounds as its affected threads are deep.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from threadlens.functions.text import context_concat, recover_child
from threadlens.operators.dedup import keep_first, key_bucket
from threadlens.operators.joins import lookup_join
from threadlens.operators.threads import _scoped, identity_rewrite
from threadlens.schemas import DELETED
from threadlens.session import scratch_path, staged, staged_counted

_KEYS = [T.StructField("_node", T.StringType()), T.StructField("_up", T.StringType())]
_PLACE = [T.StructField("epoch", T.LongType()), T.StructField("_bucket", T.IntegerType())]
ROUNDS = 8                                                   # rounds after which the found ids are written together


@dataclass
class ThreadTables:
    """Where the tables lie, and the columns of arriving comments (``parent_comment``
    among them: the parent's text as it was landed)."""

    path: str
    schema: T.StructType
    buckets: int = 64
    id_col: str = "comment_id"
    parent_col: str = "parent_comment_id"
    text_col: str = "comment"
    out_col: str = "comment_after_coref"

    def __post_init__(self):
        self.row_fields = [*_KEYS, *self.schema.fields, T.StructField("_raw_parent", T.StringType()),
                           T.StructField("level", T.IntegerType()), T.StructField("unreachable", T.BooleanType()),
                           T.StructField(self.out_col, T.StringType())]

    def create(self, spark: SparkSession) -> None:
        for name, fields in (("edges", _KEYS), ("rows", self.row_fields)):
            spark.createDataFrame([], T.StructType(fields)).write.mode("ignore").parquet(f"{self.path}/{name}/epoch=-1/_bucket=0")

    def read(self, spark: SparkSession, name: str, before: int, touched: Sequence[int] | None = None) -> DataFrame:
        """Rows of epochs before ``before``, of the ``touched`` buckets only."""
        fields = _KEYS if name == "edges" else self.row_fields
        df = (spark.read.schema(T.StructType([*fields, *_PLACE])).parquet(f"{self.path}/{name}")
              .where(F.col("epoch") < before))
        return df if touched is None else df.where(F.col("_bucket").isin(list(touched)))

    def write(self, df: DataFrame, name: str, epoch: int, key: str) -> None:
        # dealt by bucket: else every task writes a file in every bucket, which each round opens
        (df.withColumn("_bucket", key_bucket(key, self.buckets)).hint("rebalance", "_bucket").write.mode("overwrite")
         .partitionBy("_bucket").parquet(f"{self.path}/{name}/epoch={epoch}"))

    def touched(self, df: DataFrame, key: str) -> list[int]:
        """Buckets of the keys of ``df``: as many as the tables have, at most."""
        return sorted(r[0] for r in df.where(F.col(key).isNotNull()).select(key_bucket(key, self.buckets)).distinct().collect())


def _newest(rows: DataFrame) -> DataFrame:
    place = Window.partitionBy("_node").orderBy(F.desc("epoch"))
    return rows.withColumn("_r", F.row_number().over(place)).where("_r = 1").drop("_r", "epoch", "_bucket")


def current(spark: SparkSession, tables: ThreadTables) -> DataFrame:
    """Every comment with its newest level and context."""
    out = _newest(tables.read(spark, "rows", 1 << 62))
    return out.drop("_node", "_up", "_raw_parent")


@dataclass
class BatchReport:
    """What a batch did: new comments, comments computed, rounds, buckets read."""

    fresh: int = 0
    affected: int = 0
    rounds: int = 0
    edge_buckets: int = 0
    row_buckets: int = 0


def apply_batch(batch: DataFrame, tables: ThreadTables, epoch: int, order: Sequence[str],
                rewrite: Callable[[Column], Column] = identity_rewrite) -> BatchReport:
    """Take the comments of a batch into the tables; ``order`` (total) tells which of
    several rows of one id came first."""
    spark, report = batch.sparkSession, BatchReport()
    arriving = keep_first(batch.where(F.col(tables.id_col).isNotNull())
                          .select(*tables.schema.names)
                          .withColumns({"_node": _scoped(batch, tables.id_col),
                                        "_up": _scoped(batch, tables.parent_col)}), ["_node"], order)
    own = tables.touched(arriving, "_node")
    report.row_buckets = len(own)
    stored = tables.read(spark, "rows", epoch, own).select("_node").distinct()
    fresh, report.fresh = staged_counted(
        arriving.join(stored, "_node", "left_anti")
        .withColumn("_raw_parent", F.col("parent_comment").cast("string")).drop("parent_comment"), "fresh")
    tables.write(fresh.where(F.col("_up").isNotNull()).select("_node", "_up"), "edges", epoch, "_up")

    affected, count = _below(fresh, tables, epoch, report)
    anew, first = _with_parents(fresh, affected, count, tables, epoch, report)
    done = _placed(anew, first, tables, rewrite, report)
    tables.write(done, "rows", epoch, "_node")
    return report


def _below(fresh: DataFrame, tables: ThreadTables, epoch: int, report: BatchReport) -> tuple[DataFrame, int]:
    """(_node of the fresh comments and of all below them, their number)."""
    affected = frontier = fresh.select("_node")
    count = report.fresh
    more = 1 if count else 0
    while more:
        touched = tables.touched(frontier, "_node")
        report.edge_buckets = max(report.edge_buckets, len(touched))
        answers = tables.read(fresh.sparkSession, "edges", epoch + 1, touched).select("_node", "_up")
        asked = frontier.select(F.col("_node").alias("_asked"))
        # a comment with very many replies is a hot key of ``answers``
        found = lookup_join(answers, asked, "_up", "_asked", "inner").select("_node")
        frontier, more = staged_counted(found.join(affected, "_node", "left_anti").distinct(), "below")
        count += more
        report.rounds += 1
        affected = affected.unionByName(frontier)
        if report.rounds % ROUNDS == 0:
            affected = staged(affected, "affected")
    report.affected = count
    return affected, count


def _with_parents(fresh: DataFrame, affected: DataFrame, count: int, tables: ThreadTables, epoch: int,
                  report: BatchReport) -> tuple[DataFrame, DataFrame]:
    """(rows to compute, those of them that start: roots and answers to comments outside)."""
    spark = fresh.sparkSession
    # the parent's text as landed is _raw_parent, the one used is found anew
    base = ["_node", "_up", *[c for c in tables.schema.names if c != "parent_comment"], "_raw_parent"]
    old_ids = affected.join(fresh.select("_node"), "_node", "left_anti")
    touched = tables.touched(old_ids, "_node")
    old = _newest(tables.read(spark, "rows", epoch, touched).select(*base, "epoch", "_bucket")
                  .join(old_ids, "_node", "left_semi"))
    rows, n = staged_counted(fresh.select(*base).unionByName(old), "anew")
    inside = affected.select(F.col("_node").alias("_in"))
    outer = lookup_join(rows.where(F.col("_up").isNotNull()), inside, "_up", "_in", "left_anti", n_left=n)
    outer = outer.unionByName(rows.where(F.col("_up").isNull()))
    asked = staged(outer.where(F.col("_up").isNotNull()).select("_up").distinct(), "asked")
    touched = sorted({*touched, *tables.touched(asked, "_up")})
    report.row_buckets = max(report.row_buckets, len(touched))
    around = _newest(tables.read(spark, "rows", epoch, touched)
                     .select("_node", "level", tables.out_col, "epoch", "_bucket")
                     .join(asked.select(F.col("_up").alias("_node")), "_node", "left_semi"))
    around = around.select(F.col("_node").alias("_pid"), F.col("level").alias("_plevel"),
                           F.col(tables.out_col).alias("_ptext"))
    return rows, lookup_join(outer, around, "_up", "_pid", "left", n_left=n)


def _resolved(df: DataFrame, tables: ThreadTables, rewrite) -> DataFrame:
    """Level and context of rows joined with their parent's (_pid, _plevel, _ptext)."""
    raw, answer = F.col("_raw_parent"), F.col("_pid").isNotNull()
    taken = F.when(F.coalesce(raw != DELETED, F.lit(True)), F.col("_ptext")).otherwise(raw)
    parent = F.when(answer, F.coalesce(taken, F.lit(""))).otherwise(raw)
    df = df.withColumn("parent_comment", parent)
    combined = context_concat(F.col("parent_comment"), F.col(tables.text_col))
    return (df.withColumn(tables.out_col, recover_child(rewrite(combined)))
            .withColumn("level", F.when(answer, F.col("_plevel") + 1).otherwise(F.lit(1)).cast("int"))
            .withColumn("unreachable", F.lit(False))
            .select(*[f.name for f in tables.row_fields]))


def _placed(rows: DataFrame, first: DataFrame, tables: ThreadTables, rewrite, report: BatchReport) -> DataFrame:
    """All rows with level and context. Rounds over the ids alone tell how far each row
    lies below those that start; its text then meets its parent's once, in that round."""
    spark = rows.sparkSession
    astray = F.col("_pid").isNotNull() & F.col("_plevel").isNull()           # below a cycle
    last, n = staged_counted(_resolved(first.where(~astray), tables, rewrite), "placed")
    keys = rows.select("_node", "_up")
    frontier, rounds = last.select("_node"), []
    while n:
        above = frontier.select(F.col("_node").alias("_pid"))
        frontier, n = staged_counted(
            lookup_join(keys, above, "_up", "_pid", "inner", n_left=report.affected).select("_node"), "round")
        report.rounds += 1
        if n:
            rounds.append((frontier, n))
    place = last.select("_node", F.lit(0).alias("_round"))
    for k, (found, _) in enumerate(rounds, 1):
        place = place.unionByName(found.select("_node", F.lit(k).alias("_round")))
    path = scratch_path(spark, "rounds")
    rows = rows.join(place, "_node", "left").withColumn("_round", F.coalesce("_round", F.lit(-1)))
    rows.where("_round <> 0").write.option("compression", "zstd").partitionBy("_round").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    done = last
    for k, (_, many) in enumerate(rounds, 1):
        parents = last.select(F.col("_node").alias("_pid"), F.col("level").alias("_plevel"),
                              F.col(tables.out_col).alias("_ptext"))
        here = rows.where(F.col("_round") == k).drop("_round")
        last = staged(_resolved(lookup_join(here, parents, "_up", "_pid", "inner", n_left=many), tables, rewrite), "placed")
        done = done.unionByName(last)
    lost = rows.where("_round = -1").withColumns(
        {"parent_comment": F.col("_raw_parent"), "level": F.lit(None).cast("int"),
         "unreachable": F.lit(True), tables.out_col: F.lit(None).cast("string")})
    return done.unionByName(lost.select(*done.columns))


def stream_threads(spark: SparkSession, landing_dir: str, tables: ThreadTables, checkpoint: str,
                   order: Sequence[str], rewrite: Callable[[Column], Column] = identity_rewrite,
                   available_now: bool = True, fmt: str = "parquet",
                   reports: list[BatchReport] | None = None):
    """``apply_batch`` on what lands; ``reports`` collects one report a batch."""
    tables.create(spark)
    src = spark.readStream.schema(tables.schema).format(fmt).load(landing_dir)

    def take(batch: DataFrame, epoch: int) -> None:
        report = apply_batch(batch, tables, epoch, order, rewrite)
        if reports is not None:
            reports.append(report)

    writer = src.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
