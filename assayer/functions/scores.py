"""Evidence scores by data type, as column expressions.

A score is the product of weighted components, for some types transformed
afterwards. Every formula below lists its components as (name, value) pairs;
the product, the weights and the choice between formulas are shared. Inputs
are the flat fields packed by `operators.associate.scoring_frame`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.config import COMPONENT_NAMES, SCORED_TYPES
from assayer.functions.numeric import cap, p_value_score, rescale

# --- fixed values: paths of the score inputs; flat names swap . for _ ------
INPUT_PATHS = (
    "evidence.drug2clinic.resource_score.value",
    "evidence.target2drug.resource_score.value",
    "evidence.log2_fold_change.value",
    "evidence.log2_fold_change.percentile_rank",
    "evidence.resource_score.value",
    "evidence.resource_score.type",
    "unique_association_fields.cases",
    "evidence.variant2disease.resource_score.type",
    "evidence.gene2variant.resource_score.value",
    "evidence.variant2disease.gwas_sample_size",
    "evidence.disease_model_association.resource_score.value",
    "evidence.known_mutations",
    "evidence.variant2disease.resource_score.value",
)
# --- fixed values: structs of which only the presence counts ---------------
PRESENCE_PATHS = ("evidence.gene2variant",)

# --- fixed values: sources with a formula of their own ---------------------
LITERATURE_PERCENT_SOURCE = "europepmc"
GWAS_SOURCE = "gwas_catalog"
# source: (number of cases that counts in full, p-value range)
PHEWAS_SOURCES = {
    "phewas_catalog": (8800, (1e-25, 0.05)),
    "twentythreeandme": (297901, (1e-30, 0.05)),
}
PATHWAY_P_RANGE = (1e-14, 1e-4)
GWAS_P_RANGE = (1e-15, 1.0)
GWAS_FULL_SAMPLE = 5000

Components = list[tuple[str, Column]]
Field = Callable[[str], Column]


def flat_name(path: str) -> str:
    return path.replace(".", "_")


@dataclass(frozen=True)
class Formula:
    """Components of one formula and what is done to their product."""

    components: Components
    transform: Callable[[Column], Column] = lambda product: product

    def score(self, weights: Mapping[str, float]) -> Column:
        terms = [weighted(name, value, weights) for name, value in self.components]
        return self.transform(reduce(lambda a, b: a * b, terms))

    def breakdown(self, weights: Mapping[str, float]) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(name).alias("name"),
                    value.cast("double").alias("score"),
                    F.lit(float(weights.get(name, 1.0))).alias("weight"),
                )
                for name, value in self.components
            ]
        )


def weighted(name: str, value: Column, weights: Mapping[str, float]) -> Column:
    if name not in COMPONENT_NAMES:
        raise ValueError(f"unknown score component: {name}")
    weight = float(weights.get(name, 1.0))
    value = value.cast("double")
    return value if weight == 1.0 else value * F.lit(weight)


def field_of(struct: str | None) -> Field:
    """Access to the flat input fields, at top level or inside a struct."""
    prefix = f"{struct}." if struct else ""
    return lambda path: F.col(prefix + flat_name(path))


def known_drug(at: Field) -> Formula:
    return Formula(
        [
            ("drug2clinic", at("evidence.drug2clinic.resource_score.value")),
            ("target2drug", at("evidence.target2drug.resource_score.value")),
        ]
    )


def animal_model(at: Field) -> Formula:
    value = at("evidence.disease_model_association.resource_score.value")
    return Formula([("disease_model_association", value)])


def rna_expression(at: Field) -> Formula:
    return Formula(
        [
            ("p_value", p_value_score(at("evidence.resource_score.value"))),
            ("log2_fold_scale_factor", F.abs(at("evidence.log2_fold_change.value")) / 10.0),
            ("log2_fold_change_rank", at("evidence.log2_fold_change.percentile_rank") / 100.0),
        ],
        transform=lambda product: cap(product, 1.0),
    )


def affected_pathway(at: Field) -> Formula:
    """A p-value maps to the upper half of the unit range, other scores stay."""
    value = at("evidence.resource_score.value")
    kind = at("evidence.resource_score.type")
    upper_half = p_value_score(value, PATHWAY_P_RANGE) * 0.5 + 0.5
    # A missing kind is a missing input, so it must not fall through to `value`.
    score = F.when(kind == "pvalue", upper_half).when(kind.isNotNull(), value)
    return Formula([("resource_score", score)])


def literature(at: Field, source: Column) -> Formula:
    value = at("evidence.resource_score.value")
    percent = cap(value / 100.0, 1.0)
    score = F.when(source == LITERATURE_PERCENT_SOURCE, percent).otherwise(value)
    return Formula([("resource_score", score)])


def mutation_frequency(mutations: Column) -> Column:
    """Share of samples that carry a mutation type, mapped to [0.5, 1].

    Entries without a count of samples of their type are left out. With no
    entries at all the frequency is 1.
    """
    counted = F.filter(mutations, lambda m: m["number_samples_with_mutation_type"].isNotNull())
    carriers = F.aggregate(
        counted,
        F.lit(1.0),
        lambda total, m: total + m["number_samples_with_mutation_type"].cast("double"),
    )
    samples = F.transform(counted, lambda m: m["number_mutated_samples"].cast("double"))
    # greatest and least skip NULL, so an empty list leaves 1.
    largest = F.greatest(F.lit(1.0), F.array_max(samples))
    share = F.least(carriers, largest) / largest
    scaled = rescale(share, (0.0, 9.0), (0.5, 1.0))
    return F.when(F.coalesce(F.size(mutations), F.lit(0)) > 0, scaled).otherwise(F.lit(1.0))


def somatic_mutation(at: Field) -> Formula:
    return Formula(
        [
            ("resource_score", at("evidence.resource_score.value")),
            ("mutation_frequency", mutation_frequency(at("evidence.known_mutations"))),
        ]
    )


def typed_score(value: Column, kind: Column) -> Column:
    """A probability as it is, a p-value as a score, NULL for any other kind."""
    return F.when(kind == "probability", value).when(kind == "pvalue", p_value_score(value))


def genetic_without_gene(at: Field) -> Formula:
    score = typed_score(at("evidence.resource_score.value"), at("evidence.resource_score.type"))
    return Formula([("resource_score", score)])


def genetic_phewas(at: Field, source: str) -> Formula:
    full, p_range = PHEWAS_SOURCES[source]
    cases = at("unique_association_fields.cases").try_cast("int")
    p = at("evidence.variant2disease.resource_score.value")
    return Formula(
        [
            ("v2d_score", p_value_score(p, p_range)),
            ("sample_size", rescale(cases, (0, full), (0, 1))),
        ]
    )


def genetic_gwas(at: Field) -> Formula:
    size = at("evidence.variant2disease.gwas_sample_size")
    p = at("evidence.variant2disease.resource_score.value")
    return Formula(
        [
            ("v2d_score", p_value_score(p, GWAS_P_RANGE)),
            ("g2v_score", at("evidence.gene2variant.resource_score.value")),
            ("sample_size", rescale(size, (0, GWAS_FULL_SAMPLE), (0, 1))),
        ]
    )


def genetic_default(at: Field) -> Formula:
    score = typed_score(
        at("evidence.variant2disease.resource_score.value"),
        at("evidence.variant2disease.resource_score.type"),
    )
    return Formula(
        [
            ("v2d_score", score),
            ("g2v_score", at("evidence.gene2variant.resource_score.value")),
        ]
    )


def genetic_choice(at: Field, source: Column) -> list[tuple[Column, Formula]]:
    """Formulas for genetic associations with the condition of each, in order."""
    has_gene = F.coalesce(at(f"{PRESENCE_PATHS[0]}.exists"), F.lit(False))
    return [
        (~has_gene, genetic_without_gene(at)),
        *[(source == name, genetic_phewas(at, name)) for name in PHEWAS_SOURCES],
        (source == GWAS_SOURCE, genetic_gwas(at)),
        (F.lit(True), genetic_default(at)),
    ]


def formulas(at: Field, kind: Column, source: Column) -> list[tuple[Column, Formula]]:
    """All formulas with their conditions; the first that holds applies."""
    plain = {
        "known_drug": known_drug(at),
        "rna_expression": rna_expression(at),
        "animal_model": animal_model(at),
        "somatic_mutation": somatic_mutation(at),
        "literature": literature(at, source),
        "affected_pathway": affected_pathway(at),
    }
    chosen = [(kind == name, formula) for name, formula in plain.items()]
    genetic = kind == "genetic_association"
    return chosen + [(genetic & cond, formula) for cond, formula in genetic_choice(at, source)]


def _first(pairs: list[tuple[Column, Column]]) -> Column:
    (cond, value), *rest = pairs
    case = F.when(cond, value)
    for cond, value in rest:
        case = case.when(cond, value)
    return case


def evidence_score(
    kind: Column,
    source: Column,
    struct: str | None = "resource_data",
    weights: Mapping[str, float] | None = None,
    allow_unknown_types: bool = True,
    on_invalid: str = "fail",
    label: Column | None = None,
) -> Column:
    """Score of a record by its data type and source.

    An unknown data type scores 0 where allowed. A record whose formula lacks
    an input, or has a score type it cannot use, fails the job with
    `on_invalid="fail"` and scores NULL with "null". `label` names the record
    in the error text.
    """
    if on_invalid not in ("fail", "null"):
        raise ValueError(f"on_invalid must be fail or null: {on_invalid}")
    weights = weights or {}
    score = _first([(c, f.score(weights)) for c, f in formulas(field_of(struct), kind, source)])
    known = F.coalesce(kind.isin(*SCORED_TYPES), F.lit(False))
    if allow_unknown_types:
        score = F.when(known, score).otherwise(F.lit(0.0))
    if on_invalid == "null":
        return score
    named = F.lit("?") if label is None else F.coalesce(label.cast("string"), F.lit("?"))
    message = F.concat(
        F.lit("cannot score record "), named,
        F.lit(" of type "), F.coalesce(kind, F.lit("?")),
        F.lit(" from source "), F.coalesce(source, F.lit("?")),
    )
    # score appears once: coalesce raises only where it is NULL.
    return F.coalesce(score, F.raise_error(message).cast("double"))


def score_components(
    kind: Column,
    source: Column,
    struct: str | None = "resource_data",
    weights: Mapping[str, float] | None = None,
) -> Column:
    """The components of a record's score as (name, score, weight) structs."""
    weights = weights or {}
    return _first([(c, f.breakdown(weights)) for c, f in formulas(field_of(struct), kind, source)])
