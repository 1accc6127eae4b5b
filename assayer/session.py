"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "assayer", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are planned for.

    Adaptive execution must stay on: it sizes shuffle partitions and splits the
    hot side of a skewed shuffle join, which the lookup joins count on.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local master may fall back to a temporary folder: there the driver
    and the executors are one process on one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="assayer-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses, deleted as the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
