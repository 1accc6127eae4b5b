"""Hand-made records, one per corner case, through the whole evidence job."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from assayer.config import EvidenceConfig, ScoringConfig
from assayer.operators import associate, normalize
from assayer.plans import jobs
from assayer.sources import schemas

OBO = "http://purl.obolibrary.org/obo/"
BASE = {
    "sourceID": "gwas_catalog",
    "type": "genetic_association",
    "target": {
        "id": "http://identifiers.org/ensembl/ENSG01",
        "activity": "http://x.org/a/up",
        "target_type": "http://x.org/t/gene",
    },
    "disease": {"id": "http://www.ebi.ac.uk/efo/EFO_1"},
    "evidence": {
        "gene2variant": {
            "functional_consequence": OBO + "SO_1",
            "evidence_codes": [OBO + "ECO_0000205"],
            "resource_score": {"type": "probability", "value": 0.0001},
        },
        "variant2disease": {
            "evidence_codes": ["http://identifiers.org/eco/PheWAS", OBO + "ECO_0000205"],
            "gwas_sample_size": 2500,
            "resource_score": {"type": "pvalue", "value": 1e-9},
        },
    },
    "unique_association_fields": {"study_id": "S1"},
}


def record(name, **changes):
    """The base record with values set at dotted paths; None deletes."""
    out = copy.deepcopy(BASE)
    out["target"]["target_name"] = name
    out["unique_association_fields"]["variant"] = name
    for path, value in changes.items():
        *parents, leaf = path.split("__")
        place = out
        for part in parents:
            place = place.setdefault(part, {})
        if value is None:
            place.pop(leaf)
        else:
            place[leaf] = value
    return json.dumps(out)


ENS, UNI = "http://identifiers.org/ensembl/", "http://identifiers.org/uniprot/"
LINES = [
    record("plain"),
    record("bad_target", target__id=ENS + "ENSG99"),
    record("bad_disease", disease__id="http://www.ebi.ac.uk/efo/NONE_1"),
    record("excluded_biotype", sourceID="expression_atlas", target__id=ENS + "ENSG02"),
    record("included_biotype", sourceID="expression_atlas"),
    record("other_source_biotype", target__id=ENS + "ENSG02"),
    record("bad_source", sourceID="nobody"),
    record("accession", target__id=UNI + "P1"),
    record("second_accession", target__id=UNI + "Q1"),
    record("accession_then_reference", target__id=UNI + "P3"),
    record("alternate", target__id=ENS + "ENSG03"),
    record("accession_text_elsewhere", target__id=ENS + "P1"),
    record("other_prefix", target__id="http://y.org/ENSG03"),
    record("score_null", evidence__gene2variant__resource_score=None),
    record("score_equal", evidence__gene2variant__resource_score={"value": 0.5}),
    record("score_unmapped", evidence__gene2variant__functional_consequence=OBO + "SO_9"),
    record("no_consequence", evidence__gene2variant__functional_consequence=None),
    record("literature", type="genetic_literature"),
    record("drug", type="known_drug", sourceID="chembl", evidence={
        "target2drug": {"evidence_codes": ["http://identifiers.org/eco/target_drug"]}}),
    record("base_codes", evidence={"evidence_codes": ["http://identifiers.org/eco/ECO:1", OBO + "ECO_1"]}),
    record("no_codes", evidence={}),
    "{not json",
    "[1, 2]",
    record("no_source", sourceID=None),
    record("number_type", type=3),
    record("no_target", target__id=None),
    record("no_disease", disease={"name": "x"}),
    record("bad_date", evidence__date_asserted="yesterday"),
]

RULES = {
    "properties": {
        "evidence": {"properties": {"date_asserted": {"type": "string", "format": "date-time"}}}
    }
}


@pytest.fixture(scope="module")
def refs(spark):
    genes = spark.createDataFrame(
        [
            ("ENSG01", "ENSG01", None, None, "protein_coding", "P1", ["Q1", "", "Q2"]),
            ("ENSG02", "ENSG02", None, None, "rRNA", "", []),
            ("ENSG03", "ENSG03", None, None, "protein_coding", "P3", None),
            ("ENSG04", "ENSG04", None, None, "protein_coding", None, []),
        ],
        schemas.GENE,
    )
    diseases = spark.createDataFrame(
        [("EFO_1", "EFO_1", [["TOP", "MID", "EFO_1"], ["TOP", "EFO_1"]]), ("EFO_2", "EFO_2", None)],
        schemas.DISEASE,
    )
    non_reference = spark.createDataFrame([("ENSG04", "ENSG03")], schemas.NON_REFERENCE)
    eco = spark.createDataFrame([(OBO + "SO_1", "x", 0.5)], schemas.ECO_SCORE)
    return jobs.ReferenceTables(genes, diseases, non_reference, eco)


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(line,) for line in LINES], "value string")


@pytest.fixture(scope="module")
def prepared(lines, refs):
    df = jobs.prepare_evidence(lines, refs, RULES, config=EvidenceConfig(assert_schemas=True))
    return {r.target.target_name: r for r in df.collect()}


@pytest.fixture(scope="module")
def classified(lines, refs):
    return jobs.classify_evidence(lines, refs, RULES)


def test_valid_records(prepared):
    assert set(prepared) == {
        "plain", "included_biotype", "other_source_biotype", "accession", "second_accession",
        "accession_then_reference", "alternate", "score_null", "score_equal", "score_unmapped",
        "no_consequence", "literature", "drug", "base_codes", "no_codes", "other_prefix",
    }


def test_targets(prepared):
    def target(name):
        row = prepared[name]
        context = row.context
        return (
            row.target.id, context.target_id_type, context.target_id_uniprot,
            context.target_id_nonrefalt,
        )

    assert target("plain") == ("ENSG01", "ensembl", None, None)
    assert target("accession") == ("ENSG01", "uniprot", "P1", None)
    assert target("second_accession") == ("ENSG01", "uniprot", "Q1", None)
    assert target("accession_then_reference") == ("ENSG04", "uniprot", "P3", "ENSG03")
    assert target("alternate") == ("ENSG04", "ensembl", None, "ENSG03")
    assert target("other_prefix") == ("ENSG03", "other", None, None)
    assert prepared["plain"].target.activity == "up"
    assert prepared["plain"].target.target_type == "gene"


def test_scores_by_code(prepared):
    def score(name):
        row = prepared[name]
        found = row.evidence.gene2variant.resource_score
        return (
            found.value if found else None, row.context.resource_score_enforced_by_eco_code,
            row.context.resource_score_enforced_update,
        )

    assert score("plain") == (0.5, True, "value_unequal")
    assert score("score_null") == (0.5, True, "value_null")
    assert score("score_equal") == (0.5, True, "value_equal")
    assert score("score_unmapped") == (0.0001, False, None)
    # The first code has lost its URL by now, so it matches nothing.
    assert score("no_consequence") == (0.0001, False, None)
    assert score("literature") == (0.5, True, "value_unequal")


def test_codes(prepared):
    def codes(name):
        row = prepared[name]
        return row.context.evidence_codes_source, row.evidence.evidence_codes

    assert codes("plain") == ("v2d", ["PheWAS", "ECO_0000205", "SO_1"])
    assert codes("no_consequence") == ("v2d", ["PheWAS", "ECO_0000205"])
    assert codes("drug") == ("t2d", ["target_drug"])
    assert codes("base_codes") == ("base", ["ECO_1"])
    assert codes("no_codes") == (None, [])


def test_types_and_ancestors(prepared):
    assert prepared["literature"].type == "genetic_association"
    assert prepared["literature"].context.type_assignment == "genetic_association"
    assert prepared["plain"].context.type_assignment is None
    assert prepared["plain"].private.efo_codes == ["TOP", "MID", "EFO_1"]


def test_rejections(classified):
    found = {
        r.name or r.value: (r.rejected_at, r.reason)
        for r in classified.select(
            F.col("target.target_name").alias("name"), "value", "rejected_at", "reason"
        ).collect()
        if r.rejected_at != "none"
    }
    assert found == {
        "{not json": ("schema", "corrupt_json"),
        "[1, 2]": ("schema", "corrupt_json"),
        "no_source": ("schema", "missing_data_source"),
        "number_type": ("schema", "missing_data_type"),
        "no_target": ("schema", "missing_target_id"),
        "no_disease": ("schema", "missing_disease_id"),
        "bad_date": ("schema", "noncompliance_with_json_schema"),
        "bad_target": ("target_id", "id_not_found"),
        "accession_text_elsewhere": ("target_id", "id_not_found"),
        "excluded_biotype": ("target_id", "biotype_exclusion"),
        "bad_disease": ("disease_id", "id_not_found"),
        "bad_source": ("data_source", "invalid_data_source"),
    }


def test_step_summaries(classified):
    found = {}
    for r in jobs.step_summaries(classified).collect():
        key = (r.step, r.reason)
        found[key] = found.get(key, 0) + r["count"]
    assert found["schema", None] == 21 and found["target_id", None] == 18
    assert found["disease_id", None] == 17 and found["data_source", None] == 16
    assert found["target_id", "biotype_exclusion"] == 1


def test_tables_hold_every_record(spark, lines, refs, prepared, tmp_path):
    valid = jobs.prepare_evidence_tables(lines, refs, str(tmp_path), RULES)
    assert {r.id for r in valid.select("id").collect()} == {r.id for r in prepared.values()}
    assert spark.read.parquet(f"{tmp_path}/evidence_classified.parquet").count() == len(LINES)
    summary = spark.read.parquet(f"{tmp_path}/errors/evidence_validation_summary.parquet")
    assert summary.filter("step = 'schema'").agg(F.sum("count")).first()[0] == len(LINES)
    steps = spark.read.parquet(jobs.steps_path(str(tmp_path))).orderBy("number").collect()
    assert [s.step for s in steps] == ["read", "schema", "normalize", "target_id", "disease_id", "data_source"]
    assert all(s.rows == len(LINES) for s in steps) and steps[-1].passed == len(prepared)
    assert [s.passed for s in steps] == sorted((s.passed for s in steps), reverse=True)
    assert "disease" in steps[2].schema and "disease" not in steps[0].schema


def test_no_texts_no_steps(spark, refs, tmp_path):
    none = spark.createDataFrame([], "value string")
    assert jobs.prepare_evidence_tables(none, refs, str(tmp_path), RULES).count() == 0
    assert {s.rows for s in spark.read.parquet(jobs.steps_path(str(tmp_path))).collect()} == {0}


def test_scores_from_texts(spark, lines, refs, tmp_path):
    evidence = jobs.prepare_evidence(lines, refs, RULES).filter("sourceID = 'gwas_catalog'")
    evidence = evidence.filter("target.target_name IN ('plain', 'score_null', 'score_unmapped')")
    evidence, rows = jobs.counted(evidence, "evidence")
    frame = jobs.prepare_scores(evidence)
    scores = jobs.calculate_scores(frame, str(tmp_path), save_evidence_scores=True, config=ScoringConfig())
    best = 0.6 * 0.5 * 0.5
    expected = best + best / 4 + 0.6 * 0.0001 * 0.5 / 9
    found = {r.disease_id: r for r in scores.collect()}
    assert set(found) == {"TOP", "MID", "EFO_1"}
    assert found["TOP"].score == pytest.approx(expected)
    assert found["EFO_1"].is_direct and not found["TOP"].is_direct
    assert rows.get["rows"] >= 3
    assert spark.read.parquet(f"{tmp_path}/score_evidence.parquet").count() == 9


def test_repeated_ids_score_once(spark, refs):
    twice = spark.createDataFrame([(record("same"),), (record("same"),)], "value string")
    assert jobs.prepare_scores(jobs.prepare_evidence(twice, refs)).count() == 1


def test_non_reference_lookup(spark):
    genes = spark.createDataFrame(
        [("A", "g1", "t"), ("A", "g2", "f"), ("A", "g3", "f"), ("A", "g3", "f"), ("B", "g4", "f"), ("C", "g5", "t")],
        "gene_symbol string, ensembl_gene_id string, is_reference string",
    )
    found = sorted(tuple(r) for r in normalize.non_reference_lookup(genes).collect())
    assert found == [("A", "g1", "g2"), ("A", "g1", "g3")]


def test_accession_lookup_keeps_primary_without_others(refs):
    found = {tuple(r) for r in normalize.accession_lookup(refs.genes).collect()}
    assert found == {("ENSG01", "P1"), ("ENSG01", "Q1"), ("ENSG01", "Q2"), ("ENSG03", "P3")}


def test_ranks_read_written_rows(spark, lines, refs, tmp_path, monkeypatch):
    # Ranking reads its rows several times; each must be a read of a table, not the whole job.
    seen, rank = [], associate.evidence_scores
    monkeypatch.setattr(associate, "evidence_scores", lambda df, config: seen.append(df) or rank(df, config))
    frame = jobs.prepare_scores(jobs.prepare_evidence(lines, refs))
    jobs.calculate_scores(frame, str(tmp_path), save_evidence_scores=True, config=ScoringConfig(on_invalid="null"))
    assert "from_json" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert all("/expanded-" in path for path in seen[0].inputFiles())


def test_fields_at_paths_are_those_of_whole_records(spark, plan):
    odd = [
        BASE,
        {"target": {}, "disease": 5, "evidence": {"gene2variant": {}, "variant2disease": "x"}},
        {"target": {"id": 7, "tier": [1]}, "disease": {"id": None}, "evidence": {"gene2variant": {
            "resource_score": {"value": "high", "type": 1}, "evidence_codes": [1, None]}}},
        {"disease": {"id": "d", "name": {"a": 1}}, "evidence": [], "type": ["t"], "more": 1},
    ]
    lines = spark.createDataFrame([(json.dumps(r),) for r in odd], "value string")
    paths = [
        "disease.id", "evidence.gene2variant.evidence_codes", "evidence.gene2variant.resource_score",
        "evidence.variant2disease.gwas_sample_size", "target.id", "type",
    ]
    some, whole = jobs.parse_fields(lines, paths), jobs.parse_evidence(lines)
    assert some.columns == ["disease", "evidence", "target", "type"]
    assert [str(r) for r in some.select(*paths).collect()] == [str(r) for r in whole.select(*paths).collect()]
    present = [F.col(p).isNotNull() for p in ("disease", "evidence.gene2variant", "evidence.variant2disease")]
    assert some.select(*present).collect() == whole.select(*present).collect()
    assert "mined_sentences" in plan(whole.select("type")) and "mined_sentences" not in plan(some)
    with pytest.raises(KeyError):
        jobs.parse_fields(lines, ["target.none"])


def test_scores_parse_only_the_fields_in_use(lines, refs, plan):
    whole = jobs.prepare_scores(jobs.prepare_evidence(lines, refs, RULES))
    found = jobs.prepare_evidence(lines, refs, RULES, fields=jobs.SCORE_FIELDS)
    scores = jobs.prepare_scores(found)
    assert "mechanism_of_action" in plan(whole)
    assert "mechanism_of_action" not in plan(scores) and "zygosity" not in plan(scores)
    assert found.schema["context"].dataType == jobs.prepare_evidence(lines, refs).schema["context"].dataType
    rows = sorted(scores.collect(), key=lambda r: r.id)
    assert len(rows) == 16 and rows == sorted(whole.collect(), key=lambda r: r.id)
