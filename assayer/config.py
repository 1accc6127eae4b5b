"""Settings of the evidence and scoring jobs, as plain frozen dataclasses.

The values below the "fixed values" comments must stay as they are: results
depend on the exact spelling of source names, biotypes and identifier prefixes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --- fixed values: identifier prefixes -------------------------------------
UNIPROT_PREFIX = "http://identifiers.org/uniprot/"
ENSEMBL_PREFIX = "http://identifiers.org/ensembl/"

# --- fixed values: data types that have a score formula --------------------
SCORED_TYPES = (
    "known_drug",
    "rna_expression",
    "animal_model",
    "somatic_mutation",
    "literature",
    "genetic_association",
    "affected_pathway",
)

# --- fixed values: accepted data sources and the data type of each ---------
DATA_SOURCES = {
    "cancer_gene_census": "somatic_mutation",
    "chembl": "known_drug",
    "crispr": "affected_pathway",
    "europepmc": "literature",
    "eva": "genetic_association",
    "eva_somatic": "somatic_mutation",
    "expression_atlas": "rna_expression",
    "gene2phenotype": "genetic_association",
    "genomics_england": "genetic_association",
    "gwas_catalog": "genetic_association",
    "intogen": "somatic_mutation",
    "phenodigm": "animal_model",
    "phewas_catalog": "genetic_association",
    "postgap": "genetic_association",
    "progeny": "affected_pathway",
    "reactome": "affected_pathway",
    "slapenrich": "affected_pathway",
    "sysbio": "affected_pathway",
    "uniprot": "genetic_association",
    "uniprot_literature": "genetic_association",
    "uniprot_somatic": "somatic_mutation",
}

# --- fixed values: source weights (a source not listed weighs 1) -----------
SOURCE_WEIGHTS = {
    "crisp": 1.0,
    "europepmc": 0.2,
    "expression_atlas": 0.2,
    "phenodigm": 0.2,
    "progeny": 0.5,
    "slapenrich": 0.5,
    "sysbio": 0.5,
}

# --- fixed values: gene biotypes refused per source ------------------------
EXCLUDED_BIOTYPES = {
    "expression_atlas": (
        "IG_C_pseudogene",
        "IG_J_pseudogene",
        "IG_pseudogene",
        "IG_V_pseudogene",
        "polymorphic_pseudogene",
        "processed_pseudogene",
        "pseudogene",
        "rRNA",
        "rRNA_pseudogene",
        "snoRNA",
        "snRNA",
        "transcribed_processed_pseudogene",
        "transcribed_unitary_pseudogene",
        "transcribed_unprocessed_pseudogene",
        "TR_J_pseudogene",
        "TR_V_pseudogene",
        "unitary_pseudogene",
        "unprocessed_pseudogene",
    ),
}

# --- fixed values: score component names (every default weight is 1) -------
COMPONENT_NAMES = (
    "resource_score",
    "sample_size",
    "drug2clinic",
    "target2drug",
    "disease_model_association",
    "p_value",
    "log2_fold_scale_factor",
    "log2_fold_change_rank",
    "mutation_frequency",
    "v2d_score",
    "g2v_score",
)

# A lookup is broadcast only if its rows, written as JSON text, take no more
# bytes than this; a bigger one goes through a shuffle join.
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class EvidenceConfig:
    """What the evidence job accepts."""

    data_sources: Mapping[str, str] = field(default_factory=lambda: dict(DATA_SOURCES))
    excluded_biotypes: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: dict(EXCLUDED_BIOTYPES)
    )
    type_renames: Mapping[str, str] = field(
        default_factory=lambda: {"genetic_literature": "genetic_association"}
    )
    assert_schemas: bool = False
    broadcast_bytes: int = BROADCAST_BYTES


@dataclass(frozen=True)
class ScoringConfig:
    """How scores are computed and added up."""

    source_weights: Mapping[str, float] = field(default_factory=lambda: dict(SOURCE_WEIGHTS))
    component_weights: Mapping[str, float] = field(default_factory=dict)
    direct_sources: tuple[str, ...] = ("expression_atlas",)
    top_k: int = 100
    # Unknown data types score 0 if allowed, else they are invalid records.
    allow_unknown_types: bool = True
    # "fail" stops the job at a record that lacks an input its formula needs,
    # "null" gives such a record a NULL score.
    on_invalid: str = "fail"
    # Intermediate top-k reducers per group; see operators.ranking.top_k.
    fan_in: int = 1
