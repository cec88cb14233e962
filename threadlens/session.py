"""Session helpers: local defaults for tests/bench and checkpoint handling."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; all are plain Spark configs.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # long texts: keep Arrow batches small enough for Python workers
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "threadlens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, checkpoint dir set)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and is
    used as is. Only when it is unset *and* the master is local (tests,
    bench) do we create our own scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is unset; point it at a shared folder "
            "(HDFS/S3/ABFS) before running iterative operators on a cluster")
    path = tempfile.mkdtemp(prefix="threadlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint dir for written stage tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/stage-{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most the rows of ``SCALE_CONF``, for Python workers that take
    long texts; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    most = int(SCALE_CONF[key])
    if not 0 < int(spark.conf.get(key)) <= most:
        spark.conf.set(key, str(most))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the checkpoint folder and read back: for rows that
    carry texts, which a checkpoint writes uncompressed, and for small tables, whose
    size the file tells, so that a join with them needs no shuffle."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _counted(df: DataFrame, cut) -> tuple[DataFrame, int]:
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    obs = Observation()
    done = cut(df.observe(obs, F.count(F.lit(1)).alias("n")))
    return done, int(obs.get["n"])


def cut_lineage_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` that also returns the row count, observed in the same pass."""
    return _counted(df, cut_lineage)


def staged_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``staged`` that also returns the row count, observed in the same pass."""
    return _counted(df, lambda d: staged(d, name))
