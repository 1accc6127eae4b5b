"""Schemas of the input records.

An explicit schema spares the pass over all records that inference takes, and
keeps the columns the same whatever records happen to be present.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def strings(names: Iterable[str]) -> dict[str, T.DataType]:
    return {name: S for name in names}


def array(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)


LINKS = array(struct(nice_name=S, url=S))
PHENOTYPES = array(struct(**strings("id label species term_id")))
REFERENCES = struct(references=array(struct(lit_id=S)))
PLAIN_DATABASE = struct(id=S, version=S)
DATABASE = struct(dbxref=struct(id=S, url=S, version=S), id=S, version=S)
BY_DATABASE = struct(database=PLAIN_DATABASE)
BY_ALL = struct(database=DATABASE, expert=struct(statement=S, status=B), literature=REFERENCES)
METHOD_SCORE = struct(method=struct(description=S), type=S, value=D)
CODES = array(S)

BIOLOGICAL_MODEL = struct(
    allele_ids=S,
    allelic_composition=S,
    date_asserted=S,
    evidence_codes=CODES,
    genetic_background=S,
    is_associated=B,
    model_gene_id=S,
    model_id=S,
    phenotypes=PHENOTYPES,
    provenance_type=BY_DATABASE,
    resource_score=METHOD_SCORE,
    species=S,
    zygosity=S,
)

DISEASE_MODEL = struct(
    date_asserted=S,
    disease_id=S,
    evidence_codes=CODES,
    human_phenotypes=PHENOTYPES,
    is_associated=B,
    model_id=S,
    model_phenotypes=PHENOTYPES,
    provenance_type=BY_DATABASE,
    resource_score=METHOD_SCORE,
)

DRUG_TO_CLINIC = struct(
    clinical_trial_phase=struct(label=S, numeric_index=L),
    date_asserted=S,
    evidence_codes=CODES,
    is_associated=B,
    provenance_type=struct(expert=struct(status=B)),
    resource_score=struct(type=S, value=D),
    status=S,
    urls=LINKS,
)

GENE_TO_VARIANT = struct(
    date_asserted=S,
    evidence_codes=CODES,
    functional_consequence=S,
    is_associated=B,
    provenance_type=BY_ALL,
    resource_score=METHOD_SCORE,
    urls=LINKS,
)

KNOWN_MUTATIONS = array(
    struct(
        functional_consequence=S,
        inheritance_pattern=S,
        number_mutated_samples=L,
        number_samples_tested=L,
        number_samples_with_mutation_type=L,
        preferred_name=S,
        role_in_cancer=S,
    )
)

MINED_SENTENCES = array(
    struct(d_end=L, d_start=L, section=S, t_end=L, t_start=L, text=S)
)

ORTHOLOGS = struct(
    date_asserted=S,
    evidence_codes=CODES,
    human_gene_id=S,
    is_associated=B,
    model_gene_id=S,
    provenance_type=BY_DATABASE,
    resource_score=METHOD_SCORE,
    species=S,
)

TARGET_TO_DRUG = struct(
    action_type=S,
    date_asserted=S,
    evidence_codes=CODES,
    is_associated=B,
    mechanism_of_action=S,
    provenance_type=struct(
        database=PLAIN_DATABASE, expert=struct(status=B), literature=REFERENCES
    ),
    resource_score=struct(type=S, value=L),
    urls=LINKS,
)

VARIANT_TO_DISEASE = struct(
    clinical_significance=S,
    confidence_interval=S,
    date_asserted=S,
    evidence_codes=CODES,
    gwas_panel_resolution=L,
    gwas_sample_size=L,
    is_associated=B,
    odds_ratio=S,
    provenance_type=BY_ALL,
    resource_score=struct(
        exponent=L, mantissa=L, method=struct(description=S, url=S), type=S, value=D
    ),
    unique_experiment_reference=S,
    urls=LINKS,
)

EVIDENCE_BODY = struct(
    biological_model=BIOLOGICAL_MODEL,
    clinical_significance=S,
    comparison_name=S,
    confidence_level=S,
    date_asserted=S,
    disease_model_association=DISEASE_MODEL,
    drug2clinic=DRUG_TO_CLINIC,
    evidence_codes=CODES,
    experiment_overview=S,
    gene2variant=GENE_TO_VARIANT,
    is_associated=B,
    known_mutations=KNOWN_MUTATIONS,
    literature_ref=struct(lit_id=S, mined_sentences=MINED_SENTENCES),
    log2_fold_change=struct(percentile_rank=L, value=D),
    organism_part=S,
    orthologs=ORTHOLOGS,
    provenance_type=BY_ALL,
    reference_replicates_n=L,
    reference_sample=S,
    resource_score=struct(
        method=struct(description=S, reference=S, url=S), type=S, value=D
    ),
    target2drug=TARGET_TO_DRUG,
    test_replicates_n=L,
    test_sample=S,
    unique_experiment_reference=S,
    urls=LINKS,
    variant2disease=VARIANT_TO_DISEASE,
)

# --- fixed values: fields that identify an association; hashed for its id --
ASSOCIATION_FIELDS = (
    "alleleOrigin",
    "cases",
    "chembl_molecule",
    "clinvarAccession",
    "comparison_name",
    "dbSnps",
    "disease_acronym",
    "disease_id",
    "disease_iri",
    "disease_phenodigm_id",
    "disease_uri",
    "efo_id",
    "gene",
    "geneID",
    "gene_name",
    "gene_set",
    "model_description",
    "model_gene_id",
    "model_genetic_background",
    "mutationDescription",
    "mutation_type",
    "mutations",
    "odds_ratio",
    "original_disease_label",
    "original_disease_name",
    "panel_diseasegroup",
    "panel_diseasesubgroup",
    "panel_id",
    "panel_name",
    "panel_version",
    "pathway_id",
    "phenotype",
    "pmid",
    "predictionModel",
    "previous_code",
    "probe_id",
    "publication_id",
    "pubmed_refs",
    "pvalue_annotation",
    "reaction_activity",
    "reaction_id",
    "score",
    "study_id",
    "study_name",
    "symbol",
    "target",
    "target_id",
    "tumor_type",
    "tumor_type_acronym",
    "uniprot_release",
    "url",
    "variant",
    "variant_id",
)

EVIDENCE = struct(
    access_level=S,
    disease=struct(biosample=struct(id=S, name=S), id=S, name=S, source_name=S),
    drug=struct(id=S, molecule_name=S, molecule_type=S),
    evidence=EVIDENCE_BODY,
    literature=REFERENCES,
    sourceID=S,
    target=struct(
        activity=S,
        binding_subunit_known=B,
        complex_id=S,
        id=S,
        target_class=array(S),
        target_name=S,
        target_type=S,
        tier=S,
    ),
    type=S,
    unique_association_fields=struct(**strings(ASSOCIATION_FIELDS)),
    validated_against_schema_version=S,
    variant=struct(id=S, type=S),
)

# Only the fields the jobs use.
GENE = struct(
    id=S,
    ensembl_gene_id=S,
    approved_symbol=S,
    approved_name=S,
    biotype=S,
    uniprot_id=S,
    uniprot_accessions=array(S),
)
DISEASE = struct(id=S, code=S, path_codes=array(array(S)))
NON_REFERENCE = struct(reference=S, alternate=S)
ECO_SCORE = struct(uri=S, code=S, score=D)


# Protein entries as read from XML: attributes are `_x`, the text of an element with
# attributes is `_VALUE`, and elements that repeat are arrays.
ENTRY = """
accession ARRAY<STRING>,
name ARRAY<STRING>,
comment ARRAY<STRUCT<_type: STRING, text: STRUCT<_VALUE: STRING, _evidence: STRING>>>,
feature ARRAY<STRUCT<
  _type: STRING, _description: STRING,
  location: STRUCT<
    begin: STRUCT<_position: BIGINT>, end: STRUCT<_position: BIGINT>, position: STRUCT<_position: BIGINT>>>>,
sequence STRUCT<_VALUE: STRING, _length: BIGINT>
"""
