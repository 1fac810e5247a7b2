"""Session settings and the shared scratch location.

The warehouse logic does not depend on these settings for correctness;
they make plans scale: adaptive execution re-plans joins with runtime
sizes (broadcast only what measures small), coalesces small shuffle
partitions and splits skewed ones.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# SQL settings applied to sessions this package creates.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # 64 MiB targets keep a post-shuffle partition well inside executor memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    master: str | None = None,
    app_name: str = "starmart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or the directory already set
    on the context). A local session without either gets a temporary folder
    of its own; on a cluster, whose executors would not share one, that is an
    error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getCheckpointDir()
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="starmart-ckpt-")
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


_job_folder: ContextVar[str | None] = ContextVar("starmart_job_folder", default=None)


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for what a job stages; ``scratch_path`` gives paths in it until the job ends, then it is removed."""
    folder = f"{checkpoint_root(spark)}/starmart/job-{uuid.uuid4().hex}"
    token = _job_folder.set(folder)
    try:
        yield folder
    finally:
        _job_folder.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path in the running job's folder, or below the checkpoint root (never reused)."""
    base = _job_folder.get() or f"{checkpoint_root(spark)}/starmart"
    return "/".join([base, *parts, uuid.uuid4().hex])


def stage_bucketed(df: DataFrame, by: str, buckets: int) -> DataFrame:
    """Write ``df`` once to a scratch folder, bucketed by ``by``, and read it back so.

    The table that tells Spark of the buckets is an entry of the session's
    catalog, in a database for such tables, without files of its own.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS starmart_staged LOCATION '{checkpoint_root(spark)}/starmart/staged'")
    name = f"starmart_staged.t_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, by).write.bucketBy(buckets, by).option("compression", "zstd")
    dealt.option("path", scratch_path(spark, "bucketed")).format("parquet").saveAsTable(name)
    return spark.table(name)


def stage_rows(df: DataFrame) -> DataFrame:
    """Write ``df`` once to a scratch folder and read it back."""
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
