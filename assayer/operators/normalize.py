"""Normalization of evidence records: ids, types, codes and fixed scores.

Every step leaves the record's schema as it is and notes what it did in the
`context` struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.config import ENSEMBL_PREFIX, UNIPROT_PREFIX, EvidenceConfig
from assayer.functions.lookup import literal_map
from assayer.functions.text import disease_code, evidence_codes, url_basename
from assayer.operators.lookups import lookup_join
from assayer.operators.nested import append_struct, mutate, mutate_columns

# --- fixed values: what a score assigned by evidence code says of itself ---
ENFORCED_DESCRIPTION = "Score assigned manually from evidence code"
ENFORCED_TYPE = "probability"

# The fields of a record that the normalizations read or rewrite.
READ_PATHS = (
    "target.id",
    "target.target_type",
    "target.activity",
    "disease.id",
    "type",
    "evidence.evidence_codes",
    "evidence.gene2variant.resource_score",
    "evidence.biological_model.evidence_codes",
    "evidence.drug2clinic.evidence_codes",
    "evidence.gene2variant.evidence_codes",
    "evidence.gene2variant.functional_consequence",
    "evidence.resource_score.value",
    "evidence.target2drug.evidence_codes",
    "evidence.variant2disease.evidence_codes",
)


def no_codes() -> Column:
    return F.array().cast("array<string>")


def accession_lookup(genes: DataFrame) -> DataFrame:
    """Each protein accession, primary or not, with its gene; distinct pairs."""
    accessions = F.concat(
        F.array("uniprot_id"), F.coalesce(F.col("uniprot_accessions"), no_codes())
    )
    pairs = genes.filter("ensembl_gene_id IS NOT NULL").select(
        "ensembl_gene_id", F.explode(accessions).alias("uniprot_id")
    )
    return pairs.filter(F.trim("uniprot_id") != "").distinct()


def non_reference_lookup(genes: DataFrame) -> DataFrame:
    """Alternate gene ids with the reference gene of the same symbol.

    Takes gene_symbol, ensembl_gene_id and is_reference ("t" or "f"). Alternates
    meet the one reference of their symbol in a join; no id list is built up.
    """
    is_reference = F.col("is_reference")
    references = (
        genes.filter(is_reference == "t")
        .groupBy(F.col("gene_symbol").alias("symbol"))
        .agg(F.max("ensembl_gene_id").alias("reference"))
        .filter("reference IS NOT NULL")
    )
    alternates = genes.filter((is_reference == "f") & F.col("ensembl_gene_id").isNotNull())
    alternates = alternates.select(
        "gene_symbol", F.col("ensembl_gene_id").alias("alternate")
    ).distinct()
    on = F.col("gene_symbol").eqNullSafe(F.col("symbol"))
    return alternates.join(references, on, "inner").select("gene_symbol", "reference", "alternate")


def normalize_targets(
    df: DataFrame,
    accessions: DataFrame,
    non_reference: DataFrame,
    config: EvidenceConfig = EvidenceConfig(),
) -> DataFrame:
    """Turn target URLs into gene ids.

    Ids that came as protein accessions become the gene of the accession; then
    alternate genes become their reference gene. Both ids replaced are kept in
    the context. An id of neither known prefix is not replaced.
    """
    limit = config.broadcast_bytes
    target = F.col("target.id")
    kind = (
        F.when(target.startswith(ENSEMBL_PREFIX), "ensembl")
        .when(target.startswith(UNIPROT_PREFIX), "uniprot")
        .otherwise("other")
    )
    df = df.withColumn("target_id_type", kind)
    df = mutate_columns(df, ["target.id", "target.target_type", "target.activity"], url_basename)

    by_accession = accessions.groupBy(F.col("uniprot_id").alias("uniprot:id")).agg(
        F.min("ensembl_gene_id").alias("uniprot:gene")
    )
    df = lookup_join(df, by_accession, target, "uniprot:id", unique=True, max_bytes=limit)
    mapped = F.col("uniprot:gene").isNotNull() & (F.col("target_id_type") == "uniprot")
    df = df.withColumn("target_id_uniprot", F.when(mapped, target))
    df = mutate(df, {"target.id": lambda c: F.when(mapped, F.col("uniprot:gene")).otherwise(c)})
    df = df.drop("uniprot:id", "uniprot:gene")

    by_alternate = non_reference.groupBy(F.col("alternate").alias("nonref:id")).agg(
        F.min("reference").alias("nonref:gene")
    )
    df = lookup_join(df, by_alternate, target, "nonref:id", unique=True, max_bytes=limit)
    mapped = F.col("nonref:gene").isNotNull() & (F.col("target_id_type") != "other")
    df = df.withColumn("target_id_nonrefalt", F.when(mapped, target))
    df = mutate(df, {"target.id": lambda c: F.when(mapped, F.col("nonref:gene")).otherwise(c)})
    df = df.drop("nonref:id", "nonref:gene")
    return append_struct(
        df, "context", "target_id_type", "target_id_uniprot", "target_id_nonrefalt"
    )


def normalize_diseases(df: DataFrame) -> DataFrame:
    """Turn disease URLs into codes."""
    return mutate(df, {"disease.id": disease_code})


def normalize_types(df: DataFrame, config: EvidenceConfig = EvidenceConfig()) -> DataFrame:
    """Rename data types that go by another name upstream."""
    renamed = literal_map(config.type_renames)[F.col("type")]
    df = df.withColumn("type_assignment", renamed)
    df = df.withColumn("type", F.coalesce("type_assignment", "type"))
    return append_struct(df, "context", "type_assignment")


def normalize_evidence_codes(df: DataFrame) -> DataFrame:
    """Gather a record's evidence code URLs, as distinct codes, in one field.

    They come from the first place the record has: its own list, the variant,
    the drug or the model.
    """

    def codes(part: str):
        return F.coalesce(F.col(f"evidence.{part}.evidence_codes"), no_codes())

    consequence = F.col("evidence.gene2variant.functional_consequence")
    origins = {
        "base": ("evidence_codes", F.col("evidence.evidence_codes")),
        "v2d": (
            "variant2disease",
            F.concat(
                codes("variant2disease"),
                codes("gene2variant"),
                F.when(consequence.isNull(), no_codes()).otherwise(F.array(consequence)),
            ),
        ),
        "t2d": ("target2drug", F.concat(codes("target2drug"), codes("drug2clinic"))),
        "biom": ("biological_model", codes("biological_model")),
    }
    label, urls = None, None
    for name, (part, value) in origins.items():
        here = F.col(f"evidence.{part}").isNotNull()
        label = F.when(here, name) if label is None else label.when(here, name)
        urls = F.when(here, value) if urls is None else urls.when(here, value)
    found = F.array_distinct(evidence_codes(urls.otherwise(no_codes())))
    # The label reads the list that the rewrite replaces, so it comes first.
    df = df.withColumn("evidence_codes_source", label)
    df = mutate(df, {"evidence.evidence_codes": found})
    return append_struct(df, "context", "evidence_codes_source")


def normalize_resource_scores(
    df: DataFrame, eco_scores: DataFrame, config: EvidenceConfig = EvidenceConfig()
) -> DataFrame:
    """Give genetic associations the fixed score of their evidence code URI.

    The URI is the functional consequence, else the first evidence code. Codes
    have lost their URL by then, so as a rule only the consequence matches.
    Records whose URI has no fixed score keep the one they have.
    """
    score = "evidence.gene2variant.resource_score"
    applies = F.coalesce(F.col("type") == "genetic_association", F.lit(False))
    applies = applies & F.col("evidence.gene2variant").isNotNull()
    uri = F.coalesce(
        F.col("evidence.gene2variant.functional_consequence"),
        F.get(F.col("evidence.evidence_codes"), F.lit(0)),
    )
    fixed = eco_scores.groupBy(F.col("uri").alias("eco:uri")).agg(
        F.max("score").alias("eco:score")
    )
    limit = config.broadcast_bytes
    df = lookup_join(
        df, fixed, F.when(applies, uri), "eco:uri", unique=True, max_bytes=limit
    )
    original = F.coalesce(F.col(f"{score}.value"), F.col("evidence.resource_score.value"))
    expected = F.col("eco:score")
    enforced = expected.isNotNull()
    update = F.when(
        enforced,
        F.when(original.isNull(), "value_null")
        .when(original != expected, "value_unequal")
        .otherwise("value_equal"),
    )
    df = df.withColumns(
        {
            "resource_score_enforced_by_eco_code": enforced,
            "resource_score_enforced_update": update,
        }
    )
    replacement = F.struct(
        F.struct(F.lit(ENFORCED_DESCRIPTION).alias("description")).alias("method"),
        F.lit(ENFORCED_TYPE).alias("type"),
        expected.alias("value"),
    )
    df = mutate(df, {score: lambda c: F.when(enforced, replacement).otherwise(c)})
    return append_struct(
        df.drop("eco:uri", "eco:score"),
        "context",
        "resource_score_enforced_by_eco_code",
        "resource_score_enforced_update",
    )
