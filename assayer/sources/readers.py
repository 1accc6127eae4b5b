"""Readers. Each returns a lazy frame; only inference reads data."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.sources import schemas


def spread(scan: DataFrame) -> DataFrame:
    """Deal out the rows of a scan if it has fewer partitions than there are cores.

    A gzip file or a Parquet file of one row group is read by one task, and the
    work per row that follows would stay in it. A scan with enough partitions is
    left alone. Meant for plain scans: their partitions are known without a job.
    """
    wanted = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(wanted) if scan.rdd.getNumPartitions() < wanted else scan


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """One row per text line, in a column `value`.

    `partitions` deals the lines out anew, for files that cannot be split.
    """
    lines = spark.read.text(path)
    return lines if partitions is None else lines.repartition(partitions)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """JSON lines; without a schema it is inferred by a pass over the data."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.GENE)


def read_diseases(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.DISEASE)


def infer_json_type(df: DataFrame, column: str = "value") -> str:
    """DDL type of a column of JSON texts, merged over all rows.

    Texts are parsed and their types merged in the executors; one short string
    comes back.
    """
    merged = F.schema_of_variant_agg(F.try_parse_json(F.col(column)))
    found = df.agg(merged).first()[0]
    if not found or not found.startswith("OBJECT<"):
        raise ValueError(f"the texts of {column} do not share an object type: {found}")
    # Decimal literals become doubles, and a field that is null everywhere,
    # which has no type of its own, becomes text.
    found = re.sub(r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE", found)
    return re.sub(r"\bVOID\b", "STRING", found.replace("OBJECT<", "STRUCT<"))


def parse_json(
    df: DataFrame, schema: T.StructType | str | None = None, column: str = "value"
) -> DataFrame:
    """A column of JSON texts as a frame of its fields.

    With no schema it is inferred, which takes a pass over the data.
    """
    kind = infer_json_type(df, column) if schema is None else schema
    return df.select(parsed_fields(F.col(column), kind))


def parsed_fields(text: Column, kind: T.StructType | str) -> Column:
    """The fields of JSON texts as columns.

    As a generator, not a plain projection: filters and join keys that use the
    fields are not pushed below it, where each would parse the text again.
    """
    return F.inline(F.array(F.from_json(text, kind)))


def rows_as_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON text, without its NULL fields."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(name))


def drop_empty_fields(df: DataFrame) -> DataFrame:
    """Rewrite rows through JSON text, so fields that are NULL everywhere go."""
    return parse_json(rows_as_json(df))


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """CSV or TSV; without a schema types are inferred by a pass over the data."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.csv(path, sep=sep, header=header, inferSchema=schema is None)


def read_non_reference_genes(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of a reference gene and an alternate of it, found by header name."""
    table = spark.read.csv(path, header=True)
    return table.select(*[F.col(name) for name in schemas.NON_REFERENCE.fieldNames()])


def read_eco_scores(spark: SparkSession, path: str) -> DataFrame:
    """Evidence code URIs with their codes and fixed scores (no header)."""
    return read_delimited(spark, path, schemas.ECO_SCORE, sep="\t", header=False)


def read_xml(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | None = None
) -> DataFrame:
    """One row per element of a tag; attributes are `_x`, mixed text `_VALUE`."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader if schema is None else reader.schema(schema)).load(path)


def step_summaries_path(out: str) -> str:
    """Where a job that writes to `out` puts the counts of its checks, by step."""
    return f"{out}/errors/evidence_validation_summary.parquet"


def read_step_summaries(spark: SparkSession, out: str) -> DataFrame:
    """The counts of all checks of a job that wrote to `out`, with their step."""
    return spark.read.parquet(step_summaries_path(out))
