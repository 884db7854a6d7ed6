"""Session defaults, and the one way this library cuts lineage: a Parquet table in the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables. Only a local session may go without one."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="ledgerloom-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete this application's own tables below the checkpoint folder, once its results are
    written elsewhere. Nothing else in that folder is touched."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(
        f"{checkpoint_root(spark)}/{context.applicationId}"
    )
    return path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages then depend on files, not on executors: a lost executor costs only its running
    tasks. Unlike an RDD checkpoint the table keeps column pruning and size statistics.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, where its input has fewer splits than there are cores.

    Rows are dealt out in turn, by no key. Worth it before costly row-wise work on a small input of
    few row groups; an input of many splits stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
