"""Helpers the operators share: session set-up, cutting lineage, Arrow batches."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.session import scratch_path, shared_folder

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
# Text bytes of a slice of an Arrow batch that is worked on at once.
SLICE_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Make `checkpoint()` usable and the package importable on the executors.

    The checkpoint folder is the one the session names; only a local session
    without one gets a temporary folder. The package goes out as a zip file, so
    workers import it whatever their working directory is.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    if not getattr(sc, "_assayer_sent", False):
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as out:
            for folder, _, names in os.walk(PACKAGE):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
        path = os.path.join(tempfile.mkdtemp(prefix="assayer-code-"), "assayer_code.zip")
        with open(path, "wb") as out:
            out.write(packed.getvalue())
        sc.addPyFile(path)
        sc._assayer_sent = True
    return spark


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame once and cut its lineage, in the shared checkpoint folder.

    Spark deletes the files when the frame is no longer referenced, where
    `spark.cleaner.referenceTracking.cleanCheckpoints` is set.
    """
    prepare(df.sparkSession)
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, deleted when the driver's JVM ends."""
    path = scratch_path(spark, name)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a given table."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `limit` bytes of one column, of one row at least."""
    col = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def with_columns(df: DataFrame, extra: list[T.StructField]) -> T.StructType:
    """The schema of a frame with columns at its end; like-named ones are replaced."""
    names = {f.name.lower() for f in extra}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in names] + extra)


def text_of(column: str = "text"):
    """A text column with NULL read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name like `name` that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, keys: DataFrame, on: str, few: int = 2_000_000) -> DataFrame:
    """Rows whose key is not among `keys`, one settled column named as in the frame.

    Few keys are broadcast, so that the frame stays where it is.
    """
    return df.join(F.broadcast(keys) if keys.count() <= few else keys, on, "left_anti")
