"""The given tables read as evidence records and their reference tables.

Each view exists as a frame and as SQL common table expressions of the same
content, from which the queries and their oracles start.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.config import EvidenceConfig, ScoringConfig
from assayer.operators import checks
from assayer.plans.jobs import ReferenceTables, parse_evidence, parse_fields
from assayer.session import scratch_path
from assayer.sources import schemas
from assayer.sources.readers import spread

PLACES = 6
NUDGE = 1e-9


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def text(*parts: Column | str) -> Column:
    """Concatenation; plain strings are literal."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded as in the oracles.

    Scores often end in a 5 right behind the last place. A nudge up makes both
    engines round such a tie the same way, whatever its last bit is.
    """
    return df.select(
        *[
            F.round(F.col(c) + NUDGE, PLACES).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


# --- associations: one weighted score per order line -----------------------

WEIGHTS = {"5-LOW": 0.2, "4-NOT SPECIFIED": 0.5, "3-MEDIUM": 0.5}
SCORING = ScoringConfig(source_weights=WEIGHTS)

# The order line number 1 stands for evidence on the region as a whole.
EVIDENCE_SQL = """
ev AS (
  SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
               CAST(l_quantity AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT),
               CAST(round(l_discount * 100) AS BIGINT), l_returnflag, l_linestatus)) AS id,
         o_orderpriority AS source_id,
         'T' || l_suppkey AS target_id,
         CASE WHEN l_linenumber = 1 THEN 'R' || n_regionkey
              ELSE 'N' || n_nationkey END AS terminal_disease_id,
         CASE WHEN l_linenumber = 1 THEN ['R' || n_regionkey]
              ELSE ['R' || n_regionkey, 'N' || n_nationkey] END AS efo_ids,
         l_discount * 10 AS score_resource
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
),
expanded AS (
  SELECT id, source_id, terminal_disease_id, target_id, score_resource,
         unnest(efo_ids) AS disease_id
  FROM ev
),
weighed AS (
  SELECT *, terminal_disease_id = disease_id AS is_direct_id,
         score_resource * CASE source_id WHEN '5-LOW' THEN 0.2::DOUBLE
           WHEN '4-NOT SPECIFIED' THEN 0.5::DOUBLE
           WHEN '3-MEDIUM' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS score_source
  FROM expanded
),
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY target_id, disease_id, source_id
      ORDER BY score_source DESC, is_direct_id DESC, id) AS rid
  FROM weighed
)"""


def associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored evidence before it is expanded to diseases."""
    lines = spread(
        table(
            spark, sf_dir, "lineitem",
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
        )
    )
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    region, nation = text("R", F.col("n_regionkey")), text("N", F.col("n_nationkey"))
    whole = F.col("l_linenumber") == 1
    key = F.concat_ws(
        "|",
        *[F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
        F.col("l_quantity").cast("bigint"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        F.round(F.col("l_discount") * 100).cast("bigint"),
        "l_returnflag",
        "l_linestatus",
    )
    return joined.select(
        F.md5(key).alias("id"),
        F.col("o_orderpriority").alias("source_id"),
        text("T", F.col("l_suppkey")).alias("target_id"),
        F.when(whole, region).otherwise(nation).alias("terminal_disease_id"),
        F.when(whole, F.array(region)).otherwise(F.array(region, nation)).alias("efo_ids"),
        (F.col("l_discount") * 10).alias("score_resource"),
    )


# --- score inputs: the flat fields of every formula, per order line --------

INPUTS_SQL = """
inputs AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(l_quantity AS BIGINT) AS q, l_discount * 10 AS prob,
         pow(10, -l_quantity / 5) AS p,
         CASE l_partkey % 8 WHEN 0 THEN 'known_drug' WHEN 1 THEN 'rna_expression'
           WHEN 2 THEN 'animal_model' WHEN 3 THEN 'somatic_mutation'
           WHEN 4 THEN 'literature' WHEN 5 THEN 'genetic_association'
           WHEN 6 THEN 'affected_pathway' ELSE 'unheard_of' END AS type_id,
         CASE l_suppkey % 5 WHEN 0 THEN 'europepmc' WHEN 1 THEN 'gwas_catalog'
           WHEN 2 THEN 'phewas_catalog' WHEN 3 THEN 'twentythreeandme'
           ELSE 'eva' END AS source_id,
         CASE l_linenumber % 2 WHEN 0 THEN 'pvalue' ELSE 'probability' END AS kind,
         l_linenumber % 3 <> 0 AS has_gene
  FROM lineitem
),
pieces AS (
  SELECT *,
    CASE WHEN kind = 'pvalue' THEN p ELSE prob END AS value,
    1 - least(1, greatest(0, (log10(p) + 10) / 10)) AS ps,
    1 - least(1, greatest(0, (log10(p) + 14) / 10)) AS ps_path,
    1 - least(1, greatest(0, (log10(p) + 15) / 15)) AS ps_gwas,
    1 - least(1, greatest(0, (log10(p) + 25) / (log10(0.05) + 25))) AS ps_phewas,
    1 - least(1, greatest(0, (log10(p) + 30) / (log10(0.05) + 30))) AS ps_23,
    CASE WHEN l_linenumber = 7 THEN 1.0 ELSE
      0.5 + least(1 + q % 4 + CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 3 END,
                  greatest(q, CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 10 END))::DOUBLE
            / greatest(q, CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 10 END) / 9 * 0.5
    END AS freq
  FROM inputs
),
branches AS (
  SELECT *,
    prob * (l_linenumber % 2) AS s_known_drug,
    prob AS s_animal_model,
    least(1, ps * abs(q / 10.0 - 2.5) / 10 * (2 * q) / 100) AS s_rna_expression,
    CASE WHEN kind = 'pvalue' THEN ps_path * 0.5 + 0.5 ELSE prob END AS s_affected_pathway,
    CASE WHEN source_id = 'europepmc' THEN least(4 * q / 100.0, 1) ELSE 4.0 * q END AS s_literature,
    prob * freq AS s_somatic_mutation,
    CASE WHEN kind = 'pvalue' THEN ps ELSE prob END AS s_no_gene,
    ps_phewas * least(1, l_orderkey / 8800.0) AS s_phewas,
    ps_23 * least(1, l_orderkey / 297901.0) AS s_23andme,
    ps_gwas * prob * least(1, 200.0 * q / 5000) AS s_gwas,
    CASE WHEN kind = 'pvalue' THEN ps ELSE prob END * prob AS s_default
  FROM pieces
),
chosen AS (
  SELECT *, CASE type_id
      WHEN 'known_drug' THEN s_known_drug WHEN 'rna_expression' THEN s_rna_expression
      WHEN 'animal_model' THEN s_animal_model WHEN 'somatic_mutation' THEN s_somatic_mutation
      WHEN 'literature' THEN s_literature WHEN 'affected_pathway' THEN s_affected_pathway
      WHEN 'genetic_association' THEN
        CASE WHEN NOT has_gene THEN s_no_gene
          WHEN source_id = 'phewas_catalog' THEN s_phewas
          WHEN source_id = 'twentythreeandme' THEN s_23andme
          WHEN source_id = 'gwas_catalog' THEN s_gwas ELSE s_default END
      ELSE 0.0 END AS score
  FROM branches
)"""

TYPE_NAMES = (
    "known_drug", "rna_expression", "animal_model", "somatic_mutation", "literature",
    "genetic_association", "affected_pathway",
)
SOURCE_NAMES = ("europepmc", "gwas_catalog", "phewas_catalog", "twentythreeandme")


def pick(index: Column, names: tuple[str, ...], other: str) -> Column:
    case = F.when(index == 0, names[0])
    for i, name in enumerate(names[1:], start=1):
        case = case.when(index == i, name)
    return case.otherwise(other)


def score_inputs(
    spark: SparkSession, sf_dir: str, type_id: str | None = None, source_id: str | None = None,
    has_gene: bool | None = None,
) -> DataFrame:
    """Score inputs; a given type, source or gene flag holds for all rows."""
    q = F.col("l_quantity").cast("bigint")
    prob = F.col("l_discount") * 10
    p = F.pow(F.lit(10.0), -F.col("l_quantity") / 5)
    line = F.col("l_linenumber")
    kind = F.when(line % 2 == 0, "pvalue").otherwise("probability")
    value = F.when(kind == "pvalue", p).otherwise(prob)
    types = pick(F.col("l_partkey") % 8, TYPE_NAMES, "unheard_of")
    sources = pick(F.col("l_suppkey") % 5, SOURCE_NAMES, "eva")
    types = F.lit(type_id) if type_id else types
    body = (
        F.when(types == "literature", 4.0 * q)
        .when(types == "rna_expression", p)
        .when(types == "somatic_mutation", prob)
        .otherwise(value)
    )

    def mutation(with_type: Column, mutated: Column) -> Column:
        return F.struct(
            with_type.cast("bigint").alias("number_samples_with_mutation_type"),
            mutated.cast("bigint").alias("number_mutated_samples"),
        )

    # Every second record has an entry without a count, which must not matter.
    second = mutation(F.when(line % 2 == 1, 3), F.when(line % 2 == 1, 10).otherwise(999))
    mutations = F.when(line != 7, F.array(mutation(q % 4, q), second))
    gene = (line % 3 != 0) if has_gene is None else F.lit(has_gene)
    inputs = {
        "evidence_drug2clinic_resource_score_value": prob,
        "evidence_target2drug_resource_score_value": (line % 2).cast("bigint"),
        "evidence_log2_fold_change_value": F.col("l_quantity") / 10 - 2.5,
        "evidence_log2_fold_change_percentile_rank": 2 * q,
        "evidence_resource_score_value": body,
        "evidence_resource_score_type": kind,
        "unique_association_fields_cases": F.col("l_orderkey").cast("string"),
        "evidence_variant2disease_resource_score_type": kind,
        "evidence_gene2variant_resource_score_value": prob,
        "evidence_variant2disease_gwas_sample_size": 200 * q,
        "evidence_disease_model_association_resource_score_value": prob,
        "evidence_known_mutations": mutations,
        "evidence_variant2disease_resource_score_value": F.when(
            sources.isin("europepmc", "eva") if source_id is None else F.lit(source_id == "eva"),
            value,
        ).otherwise(p),
        "evidence_gene2variant_exists": gene,
    }
    lines = table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
    )
    return spread(lines).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        types.alias("type_id"),
        (F.lit(source_id) if source_id else sources).alias("source_id"),
        F.struct(*[c.alias(name) for name, c in inputs.items()]).alias("resource_data"),
    )


# --- evidence records as JSON text, and their reference tables -------------

RECORDS_SQL = """
raw AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(l_quantity AS BIGINT) AS q, l_discount * 10 AS prob, pow(10, -l_quantity / 5) AS p,
    (l_orderkey + l_linenumber) % 50 AS fault,
    CASE l_partkey % 8 WHEN 0 THEN 'known_drug' WHEN 1 THEN 'rna_expression'
      WHEN 2 THEN 'animal_model' WHEN 3 THEN 'somatic_mutation' WHEN 4 THEN 'literature'
      WHEN 5 THEN 'genetic_association' WHEN 6 THEN 'affected_pathway'
      ELSE 'genetic_literature' END AS raw_type,
    CASE l_partkey % 8 WHEN 0 THEN 'chembl' WHEN 1 THEN 'expression_atlas'
      WHEN 2 THEN 'phenodigm' WHEN 3 THEN 'intogen' WHEN 4 THEN 'europepmc'
      WHEN 5 THEN CASE l_suppkey % 4 WHEN 0 THEN 'gwas_catalog' WHEN 1 THEN 'phewas_catalog'
                    WHEN 2 THEN 'eva' ELSE 'twentythreeandme' END
      WHEN 6 THEN CASE l_suppkey % 2 WHEN 0 THEN 'reactome' ELSE 'slapenrich' END
      ELSE 'uniprot_literature' END AS source_id,
    CASE WHEN l_suppkey % 5 <= 2 THEN 'http://identifiers.org/ensembl/G' || l_suppkey
         WHEN l_suppkey % 10 = 3 THEN 'http://identifiers.org/uniprot/S' || (l_suppkey % 20)
         WHEN l_suppkey % 10 = 8 THEN 'http://identifiers.org/uniprot/P' || l_suppkey
         ELSE 'http://other.example/ids/G' || l_suppkey END AS target_url,
    'http://www.ebi.ac.uk/efo/N' || c_nationkey AS disease_url,
    'http://purl.obolibrary.org/obo/SO_' || l_linenumber AS consequence
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
),
genes AS (
  SELECT 'G' || s_suppkey AS id, 'G' || s_suppkey AS ensembl_gene_id,
    CASE WHEN s_suppkey % 7 = 0 THEN 'pseudogene' ELSE 'protein_coding' END AS biotype,
    'P' || s_suppkey AS uniprot_id,
    ['Q' || s_suppkey, ' ', 'S' || (s_suppkey % 20)] AS uniprot_accessions
  FROM supplier WHERE s_suppkey % 11 <> 0
),
diseases AS (
  SELECT 'N' || n_nationkey AS id,
    CASE WHEN n_nationkey = 3 THEN NULL
      ELSE [['ALL', 'R' || n_regionkey, 'N' || n_nationkey], ['TOP', 'R' || n_regionkey]] END
      AS path_codes
  FROM nation WHERE n_nationkey <> 24
),
ancestors AS (
  SELECT 'N' || n_nationkey AS id,
    CASE WHEN n_nationkey = 3 THEN ['N' || n_nationkey]
      ELSE ['ALL', 'R' || n_regionkey, 'N' || n_nationkey, 'TOP'] END AS efo_codes
  FROM nation WHERE n_nationkey <> 24
),
nonref AS (
  SELECT 'G' || (s_suppkey + 1) AS reference, 'G' || s_suppkey AS alternate
  FROM supplier WHERE s_suppkey % 13 = 0
),
eco AS (
  SELECT 'http://purl.obolibrary.org/obo/SO_' || r_regionkey AS uri, r_regionkey / 10.0 AS score
  FROM region
),
accessions AS (
  SELECT DISTINCT ensembl_gene_id, a AS uniprot_id
  FROM (SELECT ensembl_gene_id, unnest(list_concat([uniprot_id], uniprot_accessions)) AS a
        FROM genes)
  WHERE trim(a) <> ''
),
by_accession AS (
  SELECT uniprot_id, min(ensembl_gene_id) AS gene FROM accessions GROUP BY uniprot_id
),
reasoned AS (
  SELECT *, CASE fault WHEN 0 THEN 'corrupt_json' WHEN 1 THEN 'missing_data_source'
      WHEN 2 THEN 'missing_data_type' WHEN 3 THEN 'missing_target_id'
      WHEN 4 THEN 'missing_disease_id' WHEN 5 THEN 'noncompliance_with_json_schema'
      END AS schema_reason
  FROM raw
),
parsed AS (SELECT * FROM reasoned WHERE schema_reason IS NULL),
resolved AS (
  SELECT parsed.*,
    string_split(target_url, '/')[-1] AS raw_target,
    CASE WHEN target_url LIKE 'http://identifiers.org/ensembl/%' THEN 'ensembl'
         WHEN target_url LIKE 'http://identifiers.org/uniprot/%' THEN 'uniprot'
         ELSE 'other' END AS target_id_type,
    string_split(disease_url, '/')[-1] AS disease_id
  FROM parsed
),
first_step AS (
  SELECT resolved.*, CASE WHEN target_id_type = 'uniprot' AND gene IS NOT NULL
      THEN raw_target END AS target_id_uniprot,
    CASE WHEN target_id_type = 'uniprot' AND gene IS NOT NULL
      THEN gene ELSE raw_target END AS target_1
  FROM resolved LEFT JOIN by_accession ON raw_target = uniprot_id
),
targeted AS (
  SELECT first_step.*, CASE WHEN target_id_type <> 'other' AND reference IS NOT NULL
      THEN target_1 END AS target_id_nonrefalt,
    CASE WHEN target_id_type <> 'other' AND reference IS NOT NULL
      THEN reference ELSE target_1 END AS target_id
  FROM first_step LEFT JOIN nonref ON target_1 = alternate
),
classified AS (
  SELECT targeted.*,
    CASE WHEN genes.id IS NULL THEN 'id_not_found'
         WHEN source_id = 'expression_atlas' AND biotype = 'pseudogene'
           THEN 'biotype_exclusion' END AS target_reason,
    CASE WHEN ancestors.id IS NULL THEN 'id_not_found' END AS disease_reason,
    CASE WHEN source_id = 'twentythreeandme' THEN 'invalid_data_source' END AS source_reason,
    ancestors.efo_codes,
    eco.score AS eco_score,
    CASE WHEN raw_type = 'genetic_literature' THEN 'genetic_association' ELSE raw_type END
      AS type_id
  FROM targeted LEFT JOIN genes ON target_id = genes.id
  LEFT JOIN ancestors ON disease_id = ancestors.id
  LEFT JOIN eco ON raw_type = 'genetic_association' AND consequence = eco.uri
),
identified AS (
  SELECT *, md5('{' || CASE WHEN raw_type = 'genetic_association'
        THEN '"cases":"' || l_orderkey || '",' ELSE '' END
      || '"disease_id":"' || disease_url || '","datasource":"' || source_id
      || '","study_id":"' || l_orderkey || '","target":"' || target_url
      || '","variant_id":"' || l_linenumber || '-' || l_partkey || '-' || q || '"}') AS id
  FROM classified
)"""

CODE_PREFIX = "http://purl.obolibrary.org/obo/"
ECO_PREFIX = "http://identifiers.org/eco/"

# A schema for the records below; only rule 5 of `record_lines` breaks it.
RECORD_SCHEMA = {
    "type": "object",
    "required": ["sourceID", "type", "target", "disease", "evidence"],
    "properties": {
        "type": {
            "type": "string",
            "enum": [*TYPE_NAMES, "genetic_literature"],
        },
        "sourceID": {"type": "string", "pattern": "^[a-z_]+$"},
        "target": {
            "type": "object",
            "required": ["id"],
            "properties": {"id": {"type": "string", "format": "uri", "minLength": 3}},
        },
        "disease": {"$ref": "#/definitions/entity"},
        "evidence": {
            "type": "object",
            "properties": {
                "date_asserted": {"type": "string", "format": "date-time"},
                "evidence_codes": {"type": "array", "items": {"type": "string"}},
                "resource_score": {
                    "type": "object",
                    "properties": {"value": {"type": "number", "minimum": 0}},
                },
            },
        },
    },
    "definitions": {
        "entity": {"type": "object", "properties": {"id": {"type": "string", "format": "uri"}}}
    },
}


def when_type(kind: Column, names: tuple[str, ...], value: Column) -> Column:
    return F.when(kind.isin(*names), value)


def record_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with the nested parts of its evidence record."""
    lines = spread(
        table(
            spark, sf_dir, "lineitem",
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
        )
    )
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    supp, part = F.col("l_suppkey"), F.col("l_partkey")
    kind = pick(part % 8, TYPE_NAMES, "genetic_literature")
    gwas = pick(supp % 4, ("gwas_catalog", "phewas_catalog", "eva"), "twentythreeandme")
    source = (
        F.when(part % 8 == 5, gwas)
        .when(part % 8 == 6, F.when(supp % 2 == 0, "reactome").otherwise("slapenrich"))
        .otherwise(
            pick(
                part % 8,
                ("chembl", "expression_atlas", "phenodigm", "intogen", "europepmc"),
                "uniprot_literature",
            )
        )
    )
    target = (
        F.when(supp % 5 <= 2, text("http://identifiers.org/ensembl/G", supp))
        .when(supp % 10 == 3, text("http://identifiers.org/uniprot/S", supp % 20))
        .when(supp % 10 == 8, text("http://identifiers.org/uniprot/P", supp))
        .otherwise(text("http://other.example/ids/G", supp))
    )
    disease = text("http://www.ebi.ac.uk/efo/N", F.col("c_nationkey"))
    shared = {"kind": kind, "source": source, "target": target, "disease": disease}
    columns = [c for c in joined.columns if c.startswith("l_")]
    made = joined.select(*columns, *[value.alias(name) for name, value in shared.items()])
    # The copy of a row ends a compiled method: fused with the joins, what makes the
    # parts would be one too long for the JVM. The parts themselves are no function of an
    # array's element, which would be interpreted.
    apart = made.select(F.inline(F.transform(F.array(F.struct("*")), lambda row: row)))
    return apart.select(F.inline(F.array(record_parts({c: F.col(c) for c in apart.columns}))))


def record_parts(row: Mapping[str, Column]) -> Column:
    """The keys of an order line with the nested parts of its evidence record."""
    fault = (row["l_orderkey"] + row["l_linenumber"]) % 50
    q = row["l_quantity"].cast("bigint")
    prob = row["l_discount"] * 10
    p = F.pow(F.lit(10.0), -row["l_quantity"] / 5)
    supp, line, part = row["l_suppkey"], row["l_linenumber"], row["l_partkey"]
    kind, source, target, disease = row["kind"], row["source"], row["target"], row["disease"]
    genetic = kind == "genetic_association"
    score_kind = F.when(line % 2 == 0, "pvalue").otherwise("probability")
    # Probability in the sources that take it, p-value in those that need one.
    v2d_kind = F.when(supp % 4 == 2, score_kind).otherwise("pvalue")
    v2d_value = F.when(v2d_kind == "pvalue", p).otherwise(prob)
    own_value = (
        F.when(kind == "literature", 4.0 * q)
        .when(kind == "rna_expression", p)
        .when(kind == "affected_pathway", F.when(line % 2 == 0, p).otherwise(prob))
        .when(kind.isin("somatic_mutation", "genetic_literature"), prob)
    )
    own_kind = F.when(kind == "affected_pathway", score_kind).otherwise("probability")

    def codes(*urls: str) -> Column:
        return F.array(*[F.lit(u) for u in urls])

    def scored(value: Column, type_: Column | None = None) -> Column:
        parts = [] if type_ is None else [type_.alias("type")]
        return F.struct(*parts, value.alias("value"))

    evidence = F.struct(
        F.when(
            kind == "animal_model",
            F.struct(codes(CODE_PREFIX + "ECO_0000057").alias("evidence_codes")),
        ).alias("biological_model"),
        F.when(fault == 5, "yesterday")
        .otherwise("2019-10-30T11:55:46")
        .alias("date_asserted"),
        F.when(kind == "animal_model", F.struct(scored(prob).alias("resource_score"))).alias(
            "disease_model_association"
        ),
        F.when(
            kind == "known_drug",
            F.struct(
                codes(ECO_PREFIX + "drug_disease", CODE_PREFIX + "ECO_0000205").alias(
                    "evidence_codes"
                ),
                scored(prob).alias("resource_score"),
            ),
        ).alias("drug2clinic"),
        when_type(
            kind,
            ("rna_expression", "literature", "affected_pathway"),
            codes(ECO_PREFIX + "ECO:0000179", CODE_PREFIX + "ECO_0000179"),
        ).alias("evidence_codes"),
        F.when(
            genetic,
            F.struct(
                codes(CODE_PREFIX + "ECO_0000205").alias("evidence_codes"),
                text(CODE_PREFIX + "SO_", line).alias("functional_consequence"),
                F.when(
                    line % 3 != 0, F.struct(F.lit("probability").alias("type"), prob.alias("value"))
                ).alias("resource_score"),
            ),
        ).alias("gene2variant"),
        F.when(
            kind == "somatic_mutation",
            F.array(
                F.struct(
                    q.alias("number_mutated_samples"),
                    (q % 4).alias("number_samples_with_mutation_type"),
                )
            ),
        ).alias("known_mutations"),
        F.when(
            kind == "rna_expression",
            F.struct(
                (2 * q).alias("percentile_rank"), (row["l_quantity"] / 10 - 2.5).alias("value")
            ),
        ).alias("log2_fold_change"),
        F.when(own_value.isNotNull(), scored(own_value, own_kind)).alias("resource_score"),
        F.when(
            kind == "known_drug",
            F.struct(
                codes(ECO_PREFIX + "target_drug").alias("evidence_codes"),
                scored((line % 2).cast("bigint")).alias("resource_score"),
            ),
        ).alias("target2drug"),
        F.when(
            genetic,
            F.struct(
                codes(ECO_PREFIX + "GWAS", CODE_PREFIX + "ECO_0000205").alias("evidence_codes"),
                (200 * q).alias("gwas_sample_size"),
                scored(v2d_value, v2d_kind).alias("resource_score"),
            ),
        ).alias("variant2disease"),
    )
    unique = F.struct(
        F.when(genetic, row["l_orderkey"].cast("string")).alias("cases"),
        disease.alias("disease_id"),
        F.lit("stale").alias("datasource"),
        row["l_orderkey"].cast("string").alias("study_id"),
        target.alias("target"),
        text(line, "-", part, "-", q).alias("variant_id"),
    )
    return F.struct(
        row["l_orderkey"].alias("l_orderkey"),
        line.alias("l_linenumber"),
        fault.alias("fault"),
        F.when(fault != 4, F.struct(disease.alias("id"))).alias("disease"),
        evidence.alias("evidence"),
        F.when(fault != 1, source).alias("sourceID"),
        F.struct(
            F.lit("http://example.org/activity/up").alias("activity"),
            F.when(fault != 3, target).alias("id"),
            text(row["l_orderkey"], "-", line).alias("target_name"),
            F.lit("http://example.org/target/gene_evidence").alias("target_type"),
        ).alias("target"),
        kind.alias("type"),
        unique.alias("unique_association_fields"),
    )


# Where texts were written that would else be made anew for each query.
_WRITTEN: dict[str, str] = {}


def write_texts(spark: SparkSession, sf_dir: str) -> None:
    """Write the records' texts once, so that queries read them like any input."""
    path = scratch_path(spark, "texts")
    _record_lines(spark, sf_dir).write.parquet(path)
    _WRITTEN[sf_dir] = path


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence records as JSON texts, one in fifty faulty in each of six ways."""
    if sf_dir in _WRITTEN:
        return spark.read.parquet(_WRITTEN[sf_dir])
    return _record_lines(spark, sf_dir)


def _record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ["disease", "evidence", "sourceID", "target", "type", "unique_association_fields"]
    df = record_rows(spark, sf_dir)
    record = F.to_json(F.struct(*parts))
    untyped = F.to_json(
        F.struct(*[F.lit(5).alias(p) if p == "type" else F.col(p) for p in parts])
    )
    # Each text is made in the one case that needs it.
    value = (
        F.when(F.col("fault") == 0, F.substring(record, F.lit(1), F.length(record) - 1))
        .when(F.col("fault") == 2, untyped)
        .otherwise(record)
    )
    # Whoever checks lines gets the keys along, to compare row by row.
    return df.select("l_orderkey", "l_linenumber", value.alias("value"))


def records(spark: SparkSession, sf_dir: str, *paths: str) -> DataFrame:
    """The records that pass the schema check, parsed, with their ids; given paths,
    only the fields there.
    """
    checked = checks.classify_lines(record_lines(spark, sf_dir), RECORD_SCHEMA)
    valid = checks.passed(checked)
    return parse_fields(valid, paths, record_type()) if paths else parse_evidence(valid, record_type())


def record_type() -> T.StructType:
    """The evidence schema with the stale field that the id must not use."""
    unique = schemas.strings((*schemas.ASSOCIATION_FIELDS, "datasource"))
    return T.StructType(
        [
            T.StructField(f.name, schemas.struct(**unique))
            if f.name == "unique_association_fields"
            else f
            for f in schemas.EVIDENCE.fields
        ]
    )


def references(spark: SparkSession, sf_dir: str) -> ReferenceTables:
    suppliers = table(spark, sf_dir, "supplier", "s_suppkey")
    key = F.col("s_suppkey")
    genes = suppliers.filter(key % 11 != 0).select(
        text("G", key).alias("id"),
        text("G", key).alias("ensembl_gene_id"),
        F.when(key % 7 == 0, "pseudogene").otherwise("protein_coding").alias("biotype"),
        text("P", key).alias("uniprot_id"),
        F.array(text("Q", key), F.lit(" "), text("S", key % 20)).alias("uniprot_accessions"),
    )
    n, r = F.col("n_nationkey"), F.col("n_regionkey")
    paths = F.array(
        F.array(F.lit("ALL"), text("R", r), text("N", n)), F.array(F.lit("TOP"), text("R", r))
    )
    diseases = table(spark, sf_dir, "nation").filter(n != 24)
    diseases = diseases.select(text("N", n).alias("id"), F.when(n != 3, paths).alias("path_codes"))
    non_reference = suppliers.filter(key % 13 == 0).select(
        text("G", key + 1).alias("reference"), text("G", key).alias("alternate")
    )
    eco = table(spark, sf_dir, "region", "r_regionkey").select(
        text(CODE_PREFIX + "SO_", F.col("r_regionkey")).alias("uri"),
        (F.col("r_regionkey") / 10.0).alias("score"),
    )
    return ReferenceTables(genes, diseases, non_reference, eco)


EVIDENCE_CONFIG = EvidenceConfig()
