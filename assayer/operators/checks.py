"""Validity checks: each adds a `reason`, NULL for a valid record.

The three readings of a checked frame are `passed`, `rejected` and
`reason_counts`. Where more than one is needed, write the checked frame once
(`sources.writers.save_and_read`) and take them from the table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.config import EvidenceConfig
from assayer.functions import jsonrules
from assayer.functions.lookup import literal_map
from assayer.operators.lookups import lookup_join


def classify_lines(lines: DataFrame, schema: Mapping | None = None) -> DataFrame:
    """Check JSON texts; adds is_valid, reason, error and the four key fields."""
    outline = jsonrules.Outline(schema)
    if outline.tells:
        df = _told_by_outline(lines, outline)
    else:
        # What is found is worked out within one generator: rules behind the first
        # that decides are not evaluated ahead as common parts of a projection.
        found = F.transform(
            F.array(F.try_parse_json("value")), lambda parsed: jsonrules.findings(schema, parsed)
        )
        df = lines.select("value", F.inline(found))
    names = [name for name, _, _ in jsonrules.REQUIRED_STRINGS]
    reason = F.when(~F.col("is_object"), jsonrules.CORRUPT)
    for name, _, missing in jsonrules.REQUIRED_STRINGS:
        reason = reason.when(F.col(name).isNull(), missing)
    reason = reason.when(F.col("violation").isNotNull(), jsonrules.NONCOMPLIANT)
    error = F.when(~F.col("is_object"), "the text is not a JSON object").when(
        reason == jsonrules.NONCOMPLIANT, F.col("violation")
    )
    return df.select(
        "value",
        reason.isNull().alias("is_valid"),
        reason.alias("reason"),
        error.alias("error"),
        *names,
    )


def _once(*columns: Column) -> Column:
    """Columns worked out by a generator of one row, not a projection: what uses them,
    filters too, is not pushed below it and does not work them out again.
    """
    return F.inline(F.array(F.struct(*columns)))


def _told_by_outline(lines: DataFrame, outline: jsonrules.Outline) -> DataFrame:
    """`is_object`, the required strings and the `violation` of JSON texts.

    A text is parsed once and copied into no row, only the values that decide are.
    What is read of them step by step is compiled code; only the rules that look into
    arrays and the like, and all rules of the few texts that the outline does not tell
    to conform, are functions of an array's element, which Spark interprets. Those
    few texts are parsed again.
    """
    paths = outline.strings()
    texts = {pointer: f"text {i}" for i, pointer in enumerate(paths)}
    reads = {pointer: f"string {i}" for i, pointer in enumerate(paths)}

    def value(pointer: str) -> Column:
        return jsonrules.at_path(F.col("at"), paths[pointer])

    df = lines.select("value", _once(outline.read(F.try_parse_json("value")).alias("at")))
    df = df.select("value", "at", _once(*[F.to_json(value(p)).alias(n) for p, n in texts.items()]))
    strings = [jsonrules.string_of(F.col(texts[p]), value(p)).alias(n) for p, n in reads.items()]
    df = df.select("value", "at", _once(*strings))
    sure, rest = outline.signs(F.col("at"), {p: F.col(n) for p, n in reads.items()})
    names = {name: reads["/".join(["#", *path])] for name, path in outline.paths.items()}
    found = [F.col("at").isNotNull().alias("is_object"), *[F.col(n).alias(name) for name, n in names.items()]]
    df = df.select("value", "at", _once(*found, sure.alias("sure")))
    violation = F.lit(None).cast("string")
    if outline.schema is not None:
        all_rules = jsonrules.bound(
            F.try_parse_json("value"), lambda parsed: jsonrules.first_violation(outline.schema, parsed)
        )
        # A text that is no object or lacks a string is refused for that.
        complete = [F.col("is_object"), *[F.col(name).isNotNull() for name in names]]
        violation = F.when(reduce(and_, complete) & ~(F.col("sure") & rest), all_rules)
    return df.select("value", "is_object", *names, _once(violation.alias("violation")))


def passed(df: DataFrame) -> DataFrame:
    """Valid records, without their (empty) reason."""
    return df.filter("reason IS NULL").drop("reason")


def rejected(df: DataFrame) -> DataFrame:
    """Invalid records in full, with their reason."""
    return df.filter("reason IS NOT NULL")


def reason_counts(df: DataFrame, source: str = "sourceID") -> DataFrame:
    """Number of records by source and reason; valid ones under a NULL reason."""
    return df.groupBy(F.col(source).alias("sourceID"), "reason").count()


def classify_targets(
    df: DataFrame, genes: DataFrame, config: EvidenceConfig = EvidenceConfig()
) -> DataFrame:
    """Targets must be genes of the index, of a biotype the source may report."""
    index = genes.select(F.col("id").alias("gene:id"), F.col("biotype").alias("gene:biotype"))
    index = index.filter(F.col("gene:id").isNotNull())
    joined = lookup_join(
        df, index, F.col("target.id"), "gene:id", max_bytes=config.broadcast_bytes
    )
    reason = F.when(F.col("target.id").isNull(), "id_null").when(
        F.col("gene:id").isNull(), "id_not_found"
    )
    if config.excluded_biotypes:
        excluded = literal_map(config.excluded_biotypes)[F.col("sourceID")]
        reason = reason.when(
            F.array_contains(excluded, F.col("gene:biotype")), "biotype_exclusion"
        )
    return joined.withColumn("reason", reason).drop("gene:id", "gene:biotype")


def ancestor_codes(paths: Column, own: Column) -> Column:
    """All codes on the paths to a disease and its own, each once.

    Missing paths leave its own code, so the disease does not get lost.
    """
    known = F.flatten(F.filter(paths, lambda path: path.isNotNull()))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(known, none), F.array(own)))


def disease_ancestors(diseases: DataFrame) -> DataFrame:
    """Disease ids with the codes of their ancestors and themselves."""
    return diseases.filter("id IS NOT NULL").select(
        "id", ancestor_codes(F.col("path_codes"), F.col("id")).alias("efo_codes")
    )


def classify_diseases(
    df: DataFrame, diseases: DataFrame, config: EvidenceConfig = EvidenceConfig()
) -> DataFrame:
    """Diseases must be in the index; adds their ancestors as private.efo_codes."""
    index = disease_ancestors(diseases).select(
        F.col("id").alias("efo:id"), F.struct("efo_codes").alias("private")
    )
    joined = lookup_join(
        df, index, F.col("disease.id"), "efo:id", max_bytes=config.broadcast_bytes
    )
    reason = F.when(F.col("disease.id").isNull(), "id_null").when(
        F.col("efo:id").isNull(), "id_not_found"
    )
    return joined.withColumn("reason", reason).drop("efo:id")


def classify_sources(df: DataFrame, config: EvidenceConfig = EvidenceConfig()) -> DataFrame:
    """Sources must be configured ones; a missing source is not."""
    known = F.coalesce(F.col("sourceID").isin(*config.data_sources), F.lit(False))
    return df.withColumn("reason", F.when(~known, "invalid_data_source"))
