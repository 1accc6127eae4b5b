"""Normalization and validity checks of evidence records."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.operators import checks, normalize
from assayer.operators.lookups import lookup_join
from assayer.plans.jobs import normalize_evidence
from catalog.registry import query
from catalog.views import RECORDS_SQL, records, references, table, text

NAME_SQL = "l_orderkey || '-' || l_linenumber AS target_name"


# The fields that steps read, with the name by which records are compared.
TARGET_PATHS = ("target.activity", "target.id", "target.target_name", "target.target_type")
CODE_PATHS = (
    "target.target_name",
    "evidence.biological_model.evidence_codes",
    "evidence.drug2clinic.evidence_codes",
    "evidence.evidence_codes",
    "evidence.gene2variant.evidence_codes",
    "evidence.gene2variant.functional_consequence",
    "evidence.target2drug.evidence_codes",
    "evidence.variant2disease.evidence_codes",
)
SCORE_PATHS = ("evidence.gene2variant.resource_score", "evidence.resource_score.value")
NORMALIZED_PATHS = (*TARGET_PATHS, *CODE_PATHS, *SCORE_PATHS, "disease.id", "sourceID", "type")


def targeted(spark, sf_dir):
    refs = references(spark, sf_dir)
    accessions = normalize.accession_lookup(refs.genes)
    df = records(spark, sf_dir, *TARGET_PATHS)
    return normalize.normalize_targets(df, accessions, refs.non_reference)


def normalized(spark, sf_dir):
    return normalize_evidence(records(spark, sf_dir, *NORMALIZED_PATHS), references(spark, sf_dir))


@query(
    "accession_lookup",
    f"WITH {RECORDS_SQL} SELECT ensembl_gene_id, uniprot_id FROM accessions",
)
def accession_lookup(spark, sf_dir):
    return normalize.accession_lookup(references(spark, sf_dir).genes)


@query(
    "nonref_lookup",
    """WITH g AS (
      SELECT 'S' || (c_custkey % 50) AS gene_symbol, c_name AS gene,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 't' ELSE 'f' END AS is_reference FROM customer),
    r AS (SELECT gene_symbol, max(CASE WHEN is_reference = 't' THEN gene END) AS reference
      FROM g GROUP BY gene_symbol)
    SELECT DISTINCT g.gene_symbol, reference, gene AS alternate
    FROM g JOIN r ON g.gene_symbol = r.gene_symbol
    WHERE is_reference = 'f' AND reference IS NOT NULL""",
)
def nonref_lookup(spark, sf_dir):
    genes = table(spark, sf_dir, "customer").select(
        text("S", F.col("c_custkey") % 50).alias("gene_symbol"),
        F.col("c_name").alias("ensembl_gene_id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "t").otherwise("f").alias("is_reference"),
    )
    return normalize.non_reference_lookup(genes)


@query(
    "lookup_rewrite_left",
    f"""WITH {RECORDS_SQL}
    SELECT {NAME_SQL}, target_1 AS target_id, target_id_uniprot FROM first_step""",
)
def lookup_rewrite_left(spark, sf_dir):
    """Accessions to genes only, with no alternate genes to replace."""
    refs = references(spark, sf_dir)
    none = refs.non_reference.filter("false")
    df = normalize.normalize_targets(
        records(spark, sf_dir, *TARGET_PATHS), normalize.accession_lookup(refs.genes), none
    )
    return df.select(
        "target.target_name", F.col("target.id").alias("target_id"), "context.target_id_uniprot"
    )


@query(
    "lookup_rewrite_chain",
    f"""WITH {RECORDS_SQL}
    SELECT {NAME_SQL}, target_id, 'gene_evidence' AS target_type, 'up' AS activity,
      target_id_type, target_id_uniprot, target_id_nonrefalt FROM targeted""",
)
def lookup_rewrite_chain(spark, sf_dir):
    """Accessions to genes, then alternate genes to reference genes."""
    return targeted(spark, sf_dir).select(
        "target.target_name", F.col("target.id").alias("target_id"), "target.target_type",
        "target.activity", "context.*",
    )


@query(
    "lookup_rewrite_counts",
    f"""WITH {RECORDS_SQL}
    SELECT target_id_type, target_id_uniprot IS NOT NULL AS by_accession,
      target_id_nonrefalt IS NOT NULL AS by_reference, count(*) AS n FROM targeted GROUP BY ALL""",
)
def lookup_rewrite_counts(spark, sf_dir):
    context = targeted(spark, sf_dir).select("context.*")
    return context.groupBy(
        "target_id_type",
        F.col("target_id_uniprot").isNotNull().alias("by_accession"),
        F.col("target_id_nonrefalt").isNotNull().alias("by_reference"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "type_reassignment",
    f"""WITH {RECORDS_SQL}
    SELECT {NAME_SQL}, type_id AS type,
      CASE WHEN raw_type = 'genetic_literature' THEN 'genetic_association' END AS type_assignment
    FROM classified""",
)
def type_reassignment(spark, sf_dir):
    df = records(spark, sf_dir, "target.target_name", "disease.id", "type")
    df = normalize.normalize_types(normalize.normalize_diseases(df))
    return df.select("target.target_name", "type", "context.type_assignment")


@query(
    "code_aggregation",
    f"""WITH {RECORDS_SQL}
    SELECT {NAME_SQL},
      CASE WHEN raw_type IN ('rna_expression', 'literature', 'affected_pathway') THEN 'base'
        WHEN raw_type = 'genetic_association' THEN 'v2d' WHEN raw_type = 'known_drug' THEN 't2d'
        WHEN raw_type = 'animal_model' THEN 'biom' END AS evidence_codes_source,
      CASE WHEN raw_type IN ('rna_expression', 'literature', 'affected_pathway')
          THEN 'ECO_0000179'
        WHEN raw_type = 'genetic_association' THEN 'GWAS,ECO_0000205,SO_' || l_linenumber
        WHEN raw_type = 'known_drug' THEN 'target_drug,drug_disease,ECO_0000205'
        WHEN raw_type = 'animal_model' THEN 'ECO_0000057' ELSE '' END AS codes
    FROM parsed""",
)
def code_aggregation(spark, sf_dir):
    df = normalize.normalize_evidence_codes(records(spark, sf_dir, *CODE_PATHS))
    return df.select(
        "target.target_name",
        "context.evidence_codes_source",
        F.array_join("evidence.evidence_codes", ",").alias("codes"),
    )


@query(
    "score_enforcement",
    f"""WITH {RECORDS_SQL}
    SELECT {NAME_SQL}, eco_score IS NOT NULL AS enforced,
      CASE WHEN eco_score IS NULL THEN NULL WHEN l_linenumber % 3 = 0 THEN 'value_null'
        WHEN prob <> eco_score THEN 'value_unequal' ELSE 'value_equal' END AS updated,
      CASE WHEN raw_type = 'genetic_association' THEN CASE
        WHEN eco_score IS NOT NULL OR l_linenumber % 3 <> 0 THEN 'probability' END END AS kind,
      CASE WHEN eco_score IS NOT NULL THEN 'Score assigned manually from evidence code'
        END AS description,
      CASE WHEN raw_type = 'genetic_association' THEN
        round(CASE WHEN eco_score IS NOT NULL THEN eco_score
          WHEN l_linenumber % 3 <> 0 THEN prob END + 1e-9, 6) END AS value
    FROM classified""",
)
def score_enforcement(spark, sf_dir):
    score = F.col("evidence.gene2variant.resource_score")
    return normalized(spark, sf_dir).select(
        "target.target_name",
        F.col("context.resource_score_enforced_by_eco_code").alias("enforced"),
        F.col("context.resource_score_enforced_update").alias("updated"),
        score["type"].alias("kind"),
        score["method"]["description"].alias("description"),
        F.round(score["value"] + 1e-9, 6).alias("value"),
    )


@query(
    "ancestor_codes",
    f"""WITH {RECORDS_SQL}
    SELECT id, array_to_string(efo_codes, ',') AS efo_codes FROM ancestors""",
)
def ancestor_codes(spark, sf_dir):
    found = checks.disease_ancestors(references(spark, sf_dir).diseases)
    return found.select("id", F.array_join("efo_codes", ",").alias("efo_codes"))


def checked_targets(spark, sf_dir):
    return checks.classify_targets(normalized(spark, sf_dir), references(spark, sf_dir).genes)


def checked_diseases(spark, sf_dir):
    df = records(spark, sf_dir, "target.target_name", "disease.id", "sourceID")
    df = normalize.normalize_diseases(df)
    return checks.classify_diseases(df, references(spark, sf_dir).diseases)


def register_check(name, classify, reason, subject, extra="", extra_columns=()):
    """A check's valid records, its rejects, and its counts."""
    subject_path = f"{subject}.id" if subject != "sourceID" else "sourceID"
    subject_sql = {"target": "target_id", "disease": "disease_id", "sourceID": "source_id"}[subject]

    @query(
        f"validate_{name}",
        f"""WITH {RECORDS_SQL}
        SELECT {NAME_SQL}, {subject_sql} AS subject{extra} FROM classified
        WHERE {reason} IS NULL""",
    )
    def valid(spark, sf_dir):
        df = checks.passed(classify(spark, sf_dir))
        return df.select(
            "target.target_name", F.col(subject_path).alias("subject"), *map(F.expr, extra_columns)
        )

    @query(
        f"validate_{name}_rejects",
        f"""WITH {RECORDS_SQL}
        SELECT {NAME_SQL}, {subject_sql} AS subject, {reason} AS reason FROM classified
        WHERE {reason} IS NOT NULL""",
    )
    def rejects(spark, sf_dir):
        df = checks.rejected(classify(spark, sf_dir))
        return df.select("target.target_name", F.col(subject_path).alias("subject"), "reason")

    @query(
        f"validate_{name}_summary",
        f"""WITH {RECORDS_SQL}
        SELECT source_id AS "sourceID", {reason} AS reason, count(*) AS count
        FROM classified GROUP BY ALL""",
    )
    def summary(spark, sf_dir):
        return checks.reason_counts(classify(spark, sf_dir))


register_check("target", checked_targets, "target_reason", "target")
register_check(
    "disease",
    checked_diseases,
    "disease_reason",
    "disease",
    ", array_to_string(efo_codes, ',') AS codes",
    ("array_join(private.efo_codes, ',') AS codes",),
)
register_check(
    "source",
    lambda spark, sf_dir: checks.classify_sources(
        records(spark, sf_dir, "target.target_name", "sourceID")
    ),
    "source_reason",
    "sourceID",
)


@query(
    "lookup_hot_key",
    """WITH facts AS (SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_partkey % 3 = 0 THEN 'S7' WHEN l_partkey % 5 = 0 THEN NULL
          ELSE 'S' || l_suppkey END AS accession FROM lineitem),
    known AS (SELECT 'S' || s_suppkey AS accession, s_name FROM supplier WHERE s_suppkey % 4 <> 1)
    SELECT l_orderkey, l_linenumber, l_partkey, facts.accession, s_name FROM facts
    LEFT JOIN known ON facts.accession = known.accession""",
)
def lookup_hot_key(spark, sf_dir):
    """A shuffled lookup by a key that a third of all rows have and a fifth lacks."""
    part, own = F.col("l_partkey"), text("S", F.col("l_suppkey"))
    accession = F.when(part % 3 == 0, "S7").when(part % 5 != 0, own).alias("accession")
    facts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", accession)
    known = table(spark, sf_dir, "supplier").filter("s_suppkey % 4 <> 1")
    known = known.select(text("S", F.col("s_suppkey")).alias("known"), "s_name")
    return lookup_join(facts, known, F.col("accession"), "known", max_bytes=0).drop("known")
