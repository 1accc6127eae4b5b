"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Elements in an XML file, which is read by one task, however large it is.
XML_ROWS = 16384


def save(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: tuple[str, ...] = (),
    **options: str,
) -> DataFrame:
    """Write a frame and return it, so that steps can be chained."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return df


def save_and_read(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write a frame as Parquet and go on from the written table.

    What follows reads columns from the table instead of computing them again,
    and a lost executor costs a re-read only. The schema is known, so it is not
    looked up in the files, of which an empty frame may have none.
    """
    save(df, path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_once(df: DataFrame, path: str) -> DataFrame:
    """Write a projection the first time, then always read what was written.

    A folder without the mark of a completed job is written anew.
    """
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc
    mark = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if mark.getFileSystem(conf.hadoopConfiguration()).exists(mark):
        return df.sparkSession.read.parquet(path)
    return save_and_read(df, path, mode="overwrite")


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files of a written table."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(where).getLength()


def save_xml(
    df: DataFrame, path: str, row_tag: str, root_tag: str, rows_per_file: int = XML_ROWS
) -> DataFrame:
    """XML files of a bounded number of elements each.

    Spark does not split an XML file, so a task that wrote all of its rows to one
    would have all of them read by one task, too.
    """
    return save(
        df, path, fmt="xml", rowTag=row_tag, rootTag=root_tag, maxRecordsPerFile=str(rows_per_file)
    )


def save_single_json(df: DataFrame, path: str) -> DataFrame:
    """One gzip-compressed JSON file; for small extracts only."""
    return save(df.coalesce(1), path, fmt="json", compression="gzip")


def save_single_csv(df: DataFrame, path: str) -> DataFrame:
    """One CSV file with a header; for small lookups only."""
    return save(df.coalesce(1), path, fmt="csv", header="true")
