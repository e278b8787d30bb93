"""Session defaults and the shared scratch area."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_FALLBACK: dict[str, str] = {}


def build_session(app: str = "biomeframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Nothing here is needed for right results; every value can be overridden
    through ``conf``. On a cluster leave ``master`` unset and pass the number
    of shuffle partitions (a few times the number of cores; adaptive execution
    merges the small ones).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.parquet.filterPushdown": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``.

    On a local master without that setting, a temporary folder of this process,
    which is removed at its end. A cluster has no such fallback, because its
    executors would each write to their own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master, app = spark.sparkContext.master, spark.sparkContext.applicationId
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _FALLBACK:
        _FALLBACK[app] = tempfile.mkdtemp(prefix="biomeframe-")
        atexit.register(shutil.rmtree, _FALLBACK[app], ignore_errors=True)
    return _FALLBACK[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's part of the shared folder; never reused."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/biomeframe/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all tables this application has stored; frames read from them end with it."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(context._jsc.hadoopConfiguration()).delete(root, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Used to cut the lineage of loops and where several results read one
    expensive intermediate. Unlike a cached frame it survives lost executors,
    and unlike an eager checkpoint it is computed once, not twice.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
