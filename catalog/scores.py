"""Scores of evidence, sources and associations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from assayer.functions import scores as formulas
from assayer.functions.lookup import weight_of
from assayer.functions.numeric import clip, p_value_score, rescale
from assayer.operators import associate
from catalog.registry import query
from catalog.views import (
    EVIDENCE_SQL,
    INPUTS_SQL,
    SCORING,
    WEIGHTS,
    associations,
    rounded,
    score_inputs,
    table,
    text,
)


def source_sql(k: int) -> str:
    return f"""
sources AS (
  SELECT target_id, disease_id, source_id, sum(score_source / (rid * rid)) AS score_raw,
         bool_or(is_direct_id) AS is_direct
  FROM ranked WHERE rid <= {k} GROUP BY ALL
),
clipped AS (
  SELECT *, CASE WHEN score_raw > 1 THEN 1 ELSE score_raw END AS score FROM sources
)"""


SOURCE_SELECT = """
SELECT target_id, disease_id, source_id, round(score_raw + 1e-9, 6) AS score_raw, is_direct,
       round(score + 1e-9, 6) AS score
FROM clipped"""


def association_sql(k: int) -> str:
    return f"""
by_pair AS (
  SELECT *, row_number() OVER (
      PARTITION BY target_id, disease_id
      ORDER BY score DESC, is_direct DESC, source_id) AS pair_rid
  FROM clipped
)
SELECT target_id, disease_id, round(sum(score / (pair_rid * pair_rid)) + 1e-9, 6) AS score,
       bool_or(is_direct) AS is_direct, string_agg(source_id, ',' ORDER BY source_id) AS source_ids
FROM by_pair WHERE pair_rid <= {k} GROUP BY ALL"""


def expanded(spark, sf_dir):
    return associate.expand_diseases(associations(spark, sf_dir))


def associated(spark, sf_dir, config):
    sources = associate.source_scores(expanded(spark, sf_dir), config)
    df = rounded(associate.association_scores(sources, config))
    return df.withColumn("source_ids", F.array_join("source_ids", ","))


@query(
    "association_scores", f"WITH {EVIDENCE_SQL}, {source_sql(100)}, {association_sql(100)}"
)
def association_scores(spark, sf_dir):
    return associated(spark, sf_dir, SCORING)


@query("association_scores_top3", f"WITH {EVIDENCE_SQL}, {source_sql(3)}, {association_sql(3)}")
def association_scores_top3(spark, sf_dir):
    return associated(spark, sf_dir, replace(SCORING, top_k=3))


@query("source_scores", f"WITH {EVIDENCE_SQL}, {source_sql(100)} {SOURCE_SELECT}")
def source_scores(spark, sf_dir):
    return rounded(associate.source_scores(expanded(spark, sf_dir), SCORING))


@query("source_scores_top10", f"WITH {EVIDENCE_SQL}, {source_sql(10)} {SOURCE_SELECT}")
def source_scores_top10(spark, sf_dir):
    return rounded(associate.source_scores(expanded(spark, sf_dir), replace(SCORING, top_k=10)))


@query("source_scores_fan_in", f"WITH {EVIDENCE_SQL}, {source_sql(10)} {SOURCE_SELECT}")
def source_scores_fan_in(spark, sf_dir):
    """The same through intermediate reducers."""
    config = replace(SCORING, top_k=10, fan_in=4)
    return rounded(associate.source_scores(expanded(spark, sf_dir), config))


@query(
    "evidence_scores",
    f"""WITH {EVIDENCE_SQL}
    SELECT id, target_id, disease_id, source_id, is_direct_id, rid,
           round(score_source + 1e-9, 6) AS score_source, round(score_source / (rid * rid) + 1e-9, 6) AS score
    FROM ranked""",
)
def evidence_scores(spark, sf_dir):
    df = associate.evidence_scores(expanded(spark, sf_dir), SCORING)
    return rounded(
        df.select(
            "id", "target_id", "disease_id", "source_id", "is_direct_id", "rid", "score_source",
            "score",
        )
    )


@query(
    "disease_expand",
    f"""WITH {EVIDENCE_SQL}
    SELECT id, disease_id, terminal_disease_id = disease_id AS is_direct_id FROM expanded""",
)
def disease_expand(spark, sf_dir):
    return expanded(spark, sf_dir).select("id", "disease_id", "is_direct_id")


@query(
    "disease_scope",
    f"""WITH {EVIDENCE_SQL}
    SELECT id, terminal_disease_id, source_id = '1-URGENT' AS is_direct_source,
      CASE WHEN source_id = '1-URGENT' THEN terminal_disease_id
           ELSE array_to_string(efo_ids, ',') END AS efo_ids
    FROM ev""",
)
def disease_scope(spark, sf_dir):
    df = associations(spark, sf_dir).select(
        "id", "source_id", F.col("terminal_disease_id").alias("disease_id"),
        F.col("efo_ids").alias("efo_codes"),
    )
    scoped = associate.disease_scope(df, replace(SCORING, direct_sources=("1-URGENT",)))
    return scoped.select(
        "id", "terminal_disease_id", "is_direct_source",
        F.array_join("efo_ids", ",").alias("efo_ids"),
    )


@query(
    "source_weighting",
    """SELECT o_orderkey, o_orderpriority,
      round(o_totalprice * CASE o_orderpriority WHEN '5-LOW' THEN 0.2::DOUBLE
        WHEN '4-NOT SPECIFIED' THEN 0.5::DOUBLE WHEN '3-MEDIUM' THEN 0.5::DOUBLE
        ELSE 1.0::DOUBLE END, 3) AS weighted FROM orders""",
)
def source_weighting(spark, sf_dir):
    price = F.col("o_totalprice") * weight_of(F.col("o_orderpriority"), WEIGHTS)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.round(price, 3).alias("weighted")
    )


@query(
    "p_value_score",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
      CASE WHEN l_discount = 0 THEN 1.0 ELSE
        round(1 - least(1, greatest(0, (log10(l_discount) + 1.5) / 1.5)) + 1e-9, 6) END AS from_discount,
      round(1 - least(1, greatest(0, (-l_quantity / 5 + 10) / 10)) + 1e-9, 6) AS from_quantity,
      CASE WHEN l_linenumber = 7 THEN NULL ELSE 0.0::DOUBLE END AS from_negative
    FROM lineitem""",
)
def p_value_scores(spark, sf_dir):
    p = F.pow(F.lit(10.0), -F.col("l_quantity") / 5)
    negative = F.when(F.col("l_linenumber") == 7, -1.0).otherwise(2.0)
    return rounded(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_quantity",
            p_value_score(F.col("l_discount"), (10**-1.5, 1.0)).alias("from_discount"),
            p_value_score(p).alias("from_quantity"),
            p_value_score(negative).alias("from_negative"),
        )
    )


@query(
    "rescale",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
      round(least(1.0, greatest(0.5, 0.5 + (l_quantity - 10) / 30 * 0.5)) + 1e-9, 6) AS rescaled
    FROM lineitem""",
)
def rescaled(spark, sf_dir):
    return rounded(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
            rescale(F.col("l_quantity"), (10, 40), (0.5, 1.0)).alias("rescaled"),
        )
    )


@query(
    "clip",
    """SELECT o_orderkey, round(least(300000, greatest(50000, o_totalprice)), 2) AS clipped
    FROM orders""",
)
def clipped(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.round(clip(F.col("o_totalprice"), (50000, 300000)), 2).alias("clipped")
    )


KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def branch_sql(column: str) -> str:
    return f"""WITH {INPUTS_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({column} + 1e-9, 6) AS score
    FROM chosen"""


def scored(df, **options):
    score = formulas.evidence_score(F.col("type_id"), F.col("source_id"), **options)
    return rounded(df.select(*KEYS, score.alias("score")))


def register_branch(name, type_id, column, source_id=None, has_gene=None):
    @query(f"score_{name}", branch_sql(column))
    def branch(spark, sf_dir):
        return scored(score_inputs(spark, sf_dir, type_id, source_id, has_gene))

    return branch


register_branch("known_drug", "known_drug", "s_known_drug")
register_branch("animal_model", "animal_model", "s_animal_model")
register_branch("rna_expression", "rna_expression", "s_rna_expression")
register_branch("affected_pathway", "affected_pathway", "s_affected_pathway")
register_branch("literature", "literature", "s_literature")
register_branch("somatic_mutation", "somatic_mutation", "s_somatic_mutation")
register_branch("genetic_no_gene", "genetic_association", "s_no_gene", None, False)
register_branch("genetic_phewas", "genetic_association", "s_phewas", "phewas_catalog", True)
register_branch(
    "genetic_twentythree", "genetic_association", "s_23andme", "twentythreeandme", True
)
register_branch("genetic_gwas", "genetic_association", "s_gwas", "gwas_catalog", True)
register_branch("genetic_default", "genetic_association", "s_default", "eva", True)


@query("score_dispatch", branch_sql("score"))
def score_dispatch(spark, sf_dir):
    return scored(score_inputs(spark, sf_dir))


@query(
    "score_weighted",
    f"""WITH {INPUTS_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      round(0.5 * s_known_drug + 1e-9, 6) AS score FROM branches""",
)
def score_weighted(spark, sf_dir):
    """Component weights other than 1."""
    weights = {"drug2clinic": 0.25, "target2drug": 2.0}
    return scored(score_inputs(spark, sf_dir, "known_drug"), weights=weights)


@query(
    "score_invalid_null",
    f"""WITH {INPUTS_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN type_id = 'unheard_of' THEN NULL ELSE round(score + 1e-9, 6) END AS score FROM chosen""",
)
def score_invalid_null(spark, sf_dir):
    """Records without a formula score NULL instead of failing the job."""
    inputs = score_inputs(spark, sf_dir)
    return scored(inputs, allow_unknown_types=False, on_invalid="null")


@query(
    "score_components",
    f"""WITH {INPUTS_SQL}, parts AS (
      SELECT *, unnest(CASE type_id
        WHEN 'known_drug' THEN [{{'name': 'drug2clinic', 'score': prob}},
          {{'name': 'target2drug', 'score': l_linenumber % 2}}]
        WHEN 'rna_expression' THEN [{{'name': 'p_value', 'score': ps}},
          {{'name': 'log2_fold_scale_factor', 'score': abs(q / 10.0 - 2.5) / 10}},
          {{'name': 'log2_fold_change_rank', 'score': 2 * q / 100.0}}]
        WHEN 'animal_model' THEN [{{'name': 'disease_model_association', 'score': prob}}]
        WHEN 'somatic_mutation' THEN [{{'name': 'resource_score', 'score': prob}},
          {{'name': 'mutation_frequency', 'score': freq}}]
        WHEN 'literature' THEN [{{'name': 'resource_score', 'score': s_literature}}]
        WHEN 'affected_pathway' THEN [{{'name': 'resource_score', 'score': s_affected_pathway}}]
        WHEN 'genetic_association' THEN CASE
          WHEN NOT has_gene THEN [{{'name': 'resource_score', 'score': s_no_gene}}]
          WHEN source_id = 'phewas_catalog' THEN [{{'name': 'v2d_score', 'score': ps_phewas}},
            {{'name': 'sample_size', 'score': least(1, l_orderkey / 8800.0)}}]
          WHEN source_id = 'twentythreeandme' THEN [{{'name': 'v2d_score', 'score': ps_23}},
            {{'name': 'sample_size', 'score': least(1, l_orderkey / 297901.0)}}]
          WHEN source_id = 'gwas_catalog' THEN [{{'name': 'v2d_score', 'score': ps_gwas}},
            {{'name': 'g2v_score', 'score': prob}},
            {{'name': 'sample_size', 'score': least(1, 200.0 * q / 5000)}}]
          ELSE [{{'name': 'v2d_score', 'score': s_no_gene}},
            {{'name': 'g2v_score', 'score': prob}}] END
        END) AS c FROM chosen)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c.name AS name,
      round(CAST(c.score AS DOUBLE) + 1e-9, 6) AS score, 1.0::DOUBLE AS weight FROM parts""",
)
def score_components(spark, sf_dir):
    parts = formulas.score_components(F.col("type_id"), F.col("source_id"))
    df = score_inputs(spark, sf_dir).select(*KEYS, F.explode(parts).alias("c"))
    return rounded(df.select(*KEYS, "c.name", "c.score", "c.weight"))


@query(
    "somatic_frequency",
    """WITH per_order AS (
      SELECT l_orderkey, count(*) AS n,
        1 + sum(CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber ELSE 0 END) AS carriers,
        greatest(1, max(CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END))
          AS largest
      FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, round(0.5 + least(carriers, largest)::DOUBLE / largest / 9 * 0.5 + 1e-9, 6) AS freq
    FROM per_order""",
)
def somatic_frequency(spark, sf_dir):
    """Mutations gathered per order, every third without a count.

    An order has a handful of lines, so its list is short.
    """
    counted = F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber").cast("bigint"))
    mutation = F.struct(
        counted.alias("number_samples_with_mutation_type"),
        F.col("l_quantity").cast("bigint").alias("number_mutated_samples"),
    )
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(mutation).alias("mutations")
    )
    freq = formulas.mutation_frequency(F.col("mutations"))
    return rounded(lists.select("l_orderkey", freq.alias("freq")))


@query(
    "scoring_frame",
    """WITH d AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount,
        CAST(l_quantity AS BIGINT) AS q FROM lineitem)
    SELECT DISTINCT 'I' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || q AS id,
      'T' || l_partkey AS target_id, l_linenumber % 2 = 0 AS gene2variant_exists,
      l_linenumber AS target2drug
    FROM d""",
)
def scoring_frame(spark, sf_dir):
    """Nested evidence flattened to score inputs, one row per id."""
    lines = table(spark, sf_dir, "lineitem")
    key, line = F.col("l_orderkey"), F.col("l_linenumber")

    def score(value, *extra):
        return F.struct(*extra, F.struct(value.alias("value")).alias("resource_score"))

    none, words = F.lit(None).cast("double"), F.lit(None).cast("string")
    typed = F.struct(words.alias("type"), none.alias("value")).alias("resource_score")
    evidence = F.struct(
        score(none).alias("drug2clinic"),
        score(line.cast("bigint")).alias("target2drug"),
        F.struct(none.alias("value"), none.alias("percentile_rank")).alias("log2_fold_change"),
        typed,
        F.struct(typed, none.alias("gwas_sample_size")).alias("variant2disease"),
        F.when(line % 2 == 0, score(none)).alias("gene2variant"),
        score(none).alias("disease_model_association"),
        F.array().cast("array<string>").alias("known_mutations"),
    )
    frame = lines.select(
        F.struct(text("T", F.col("l_partkey")).alias("id")).alias("target"),
        F.struct(F.lit("D").alias("id")).alias("disease"),
        F.lit("known_drug").alias("type"),
        F.lit("chembl").alias("sourceID"),
        F.struct(F.array(F.lit("D")).alias("efo_codes")).alias("private"),
        text(
            "I", key, "-", line, "-", F.col("l_partkey"), "-", F.col("l_quantity").cast("bigint")
        ).alias("id"),
        evidence.alias("evidence"),
        F.struct(words.alias("cases")).alias("unique_association_fields"),
    )
    return associate.scoring_frame(frame).select(
        "id",
        "target_id",
        F.col("resource_data.evidence_gene2variant_exists").alias("gene2variant_exists"),
        F.col("resource_data.evidence_target2drug_resource_score_value")
        .cast("int")
        .alias("target2drug"),
    )


@query(
    "source_weighting_many",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey < 1500
      THEN (l_partkey % 7) / 8.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM lineitem""",
)
def source_weighting_many(spark, sf_dir):
    """More weights than a literal map takes."""
    weights = {str(i): (i % 7) / 8 for i in range(1500)}
    weight = weight_of(F.col("l_partkey").cast("string"), weights)
    df = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    return df.withColumn("weight", weight)
