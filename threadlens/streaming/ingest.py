"""Continuous landing ingest: at most one row per key, first arrival wins.

``readStream`` over the landing folder -> ``foreachBatch`` that keeps the first
row per key of the micro-batch, anti-joins it against the stored table and
appends only unseen keys, however late a row arrives. A retried batch finds its
own rows already stored and appends nothing, so the sink is idempotent; the
file commit protocol makes each append all-or-nothing. The stream keeps no
state: what is stored decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from threadlens.operators.clean import normalize_text
from threadlens.operators.dedup import incremental_append, key_bucket
from threadlens.operators.mentions import mention_flags


def init_stored(df: DataFrame, stored_path: str, key: str, n_buckets: int = 64,
                bucket_col: str = "_bucket") -> None:
    """Write the initial stored table partitioned by key bucket."""
    df.withColumn(bucket_col, key_bucket(key, n_buckets)).write.partitionBy(bucket_col) \
      .parquet(stored_path)


def stream_append(spark: SparkSession, landing_dir: str, schema: T.StructType,
                  stored_path: str, key: str, order: Sequence[str],
                  checkpoint: str, available_now: bool = True, fmt: str = "parquet",
                  n_buckets: int = 64, bucket_col: str = "_bucket"):
    """``stored_path`` is partitioned by ``bucket_col`` (see ``init_stored``);
    each micro-batch reads only the buckets its keys fall into."""
    src = spark.readStream.schema(schema).format(fmt).load(landing_dir)

    def append_batch(batch: DataFrame, epoch_id: int) -> None:
        stored = spark.read.parquet(stored_path)
        batch = batch.withColumn(bucket_col, key_bucket(key, n_buckets)).persist()
        fresh, _ = incremental_append(stored, batch.select(*stored.columns), key, order,
                                      bucket_col=bucket_col)
        fresh.write.mode("append").partitionBy(bucket_col).parquet(stored_path)
        batch.unpersist()

    writer = src.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def stream_clean(spark: SparkSession, landing_dir: str, schema: T.StructType, sink: str,
                 checkpoint: str, available_now: bool = True, fmt: str = "parquet",
                 gazetteers: dict | None = None):
    """Stateless cleaning (typographic, control strip, URL mask) and mention
    flags on a stream, written to a file sink (exactly-once)."""
    src = spark.readStream.schema(schema).format(fmt).load(landing_dir)
    out = normalize_text(src)
    if gazetteers:
        out = mention_flags(out, "comment", gazetteers)
    writer = (out.writeStream.format("parquet").option("path", sink)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
