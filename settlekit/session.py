"""Session construction and shared-storage helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC event times, AQE for partition sizing and
# skewed joins. Shuffle partition count is left to the cluster (AQE coalesces).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app_name: str = "settlekit", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session that names none gets a private folder, registered so
    that later calls agree; on a cluster, where every machine would write to a
    disk of its own, it is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="settlekit-shared-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    return f"{shared_dir(spark)}/settlekit/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df, name: str):
    """Write ``df`` as Parquet below the shared folder and read it back.

    For a derived table that several branches of one plan read: it is
    computed once, and every reader gets Parquet column pruning and filter
    pushdown, as from a stored table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    table._staged_path = path
    return table


def drop_tables(*tables, free: bool = False) -> None:
    """Delete staged tables that no result reads any more (others are left as they are).

    With ``free`` Spark also frees the shuffle files of jobs whose DataFrames are
    gone, which it does when the JVM collects them: worth it once a round.
    """
    spark = None
    for df in tables:
        path = getattr(df, "_staged_path", None)
        if path is not None:
            spark = df.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
            df._staged_path = None
    if free and spark is not None:
        free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark free the shuffle files of jobs whose DataFrames are gone."""
    gc.collect()
    spark._jvm.System.gc()
