"""From evidence records to scores of target-disease associations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.config import ScoringConfig
from assayer.functions.lookup import weight_of
from assayer.functions.scores import INPUT_PATHS, PRESENCE_PATHS, evidence_score
from assayer.operators.nested import flat_columns
from assayer.operators.ranking import first_per_key, harmonic_term, rank_rows, top_k

SOURCE_KEYS = ["target_id", "disease_id", "source_id"]
PAIR_KEYS = ["target_id", "disease_id"]


def scoring_frame(evidence: DataFrame) -> DataFrame:
    """One flat row per evidence id with the score inputs in `resource_data`.

    Columns are cut down before the ids are made unique, so whole records are
    not shuffled.
    """
    flat = evidence.select(
        F.col("target.id").alias("target_id"),
        F.col("disease.id").alias("disease_id"),
        F.col("type").alias("type_id"),
        F.col("sourceID").alias("source_id"),
        F.col("private.efo_codes").alias("efo_codes"),
        "id",
        F.struct(*flat_columns(INPUT_PATHS, PRESENCE_PATHS)).alias("resource_data"),
    )
    return first_per_key(flat, ["id"])


def disease_scope(df: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Add the diseases a record counts for: all ancestors, or only its own."""
    direct = F.col("source_id").isin(*config.direct_sources)
    scope = F.when(direct, F.array("disease_id")).otherwise(F.col("efo_codes"))
    return df.withColumns({"is_direct_source": direct, "efo_ids": scope}).withColumnRenamed(
        "disease_id", "terminal_disease_id"
    )


def score_evidence(df: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Add each record's own score."""
    return df.withColumn(
        "score_resource",
        evidence_score(
            F.col("type_id"),
            F.col("source_id"),
            weights=config.component_weights,
            allow_unknown_types=config.allow_unknown_types,
            on_invalid=config.on_invalid,
            label=F.col("id"),
        ),
    )


def expand_diseases(df: DataFrame) -> DataFrame:
    """One row per disease a record counts for."""
    rows = df.select(
        "id",
        "source_id",
        "terminal_disease_id",
        "target_id",
        "score_resource",
        F.explode("efo_ids").alias("disease_id"),
    )
    return rows.withColumn("is_direct_id", F.col("terminal_disease_id") == F.col("disease_id"))


def weigh_sources(df: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Weigh each record's score by its source."""
    weight = weight_of(F.col("source_id"), config.source_weights)
    return df.withColumn("score_source", F.col("score_resource") * weight)


def evidence_scores(df: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Every expanded record with its rank in its group and its harmonic term."""
    order = [F.col("score_source").desc(), F.col("is_direct_id").desc(), F.col("id")]
    ranked = rank_rows(weigh_sources(df, config), SOURCE_KEYS, order)
    return ranked.withColumn("score", harmonic_term(F.col("score_source"), F.col("rid")))


def source_scores(df: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Harmonic sum of the best records by target, disease and source.

    Needs no ids: records that tie in score and directness are alike here, so
    nothing wider than the keys, a score and a flag is shuffled.
    """
    order = [F.col("score_source").desc(), F.col("is_direct_id").desc()]
    narrow = weigh_sources(df, config).select(*SOURCE_KEYS, "score_source", "is_direct_id")
    best = top_k(narrow, SOURCE_KEYS, order, config.top_k, fan_in=config.fan_in)
    # Grouped by the keys the rows are partitioned by: no further shuffle.
    return (
        best.groupBy(*SOURCE_KEYS)
        .agg(
            F.sum(harmonic_term(F.col("score_source"), F.col("rid"))).alias("score_raw"),
            F.bool_or("is_direct_id").alias("is_direct"),
        )
        .withColumn("score", F.when(F.col("score_raw") > 1, 1.0).otherwise(F.col("score_raw")))
    )


def association_scores(df: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Harmonic sum of source scores by target and disease, not clipped.

    A group here has one row per source, so it is small.
    """
    order = [F.col("score").desc(), F.col("is_direct").desc(), F.col("source_id")]
    best = top_k(df, PAIR_KEYS, order, config.top_k)
    return best.groupBy(*PAIR_KEYS).agg(
        F.sum(harmonic_term(F.col("score"), F.col("rid"))).alias("score"),
        F.bool_or("is_direct").alias("is_direct"),
        F.sort_array(F.collect_set("source_id")).alias("source_ids"),
    )
