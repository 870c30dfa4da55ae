"""Session construction and the shared checkpoint folder.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a
shared file system the cluster names).  Only tests and local benches may pass a
fallback, and only when the session has none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on: ANSI stays on (we use try_* functions for
# tolerant casts), AQE re-plans joins and coalesces small shuffle partitions,
# skew-join splitting is on for hot keys.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # MS932 / cp932 report files need the legacy Java charset list.
    "spark.sql.legacy.javaCharsets": "true",
    # a malformed byte becomes U+FFFD (and is counted) instead of ending the job
    "spark.sql.legacy.codingErrorAction": "true",
}


def get_spark(master: str | None = None, app: str = "tallyspark",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder, setting ``fallback`` only if none is set."""
    conf = spark.sparkContext.getConf()
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required")
        d = fallback
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def shared_checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's shared checkpoint folder, or None when it names none (never a local default)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
    return d or None


def work_dir(spark: SparkSession) -> str:
    """Folder for tables that a job writes for itself: the shared checkpoint folder the cluster names.

    Only a ``local`` session that names none (tests) gets a folder of its own.
    """
    local = spark.sparkContext.master.split("[")[0] == "local"
    if local and not shared_checkpoint_dir(spark):
        return checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="tallyspark-"))
    return checkpoint_dir(spark)


def materialized(df: DataFrame) -> DataFrame:
    """``df`` written once into the work folder and read back: later stages and retries start from the files."""
    path = f"{work_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
