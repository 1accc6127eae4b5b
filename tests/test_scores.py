import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from assayer.config import ScoringConfig
from assayer.functions import scores
from assayer.operators import associate
from assayer.operators.nested import flat_columns
from assayer.sources import schemas
from assayer.sources.readers import parse_json

import json


def frame(spark, records):
    """Records given as nested dicts, as score inputs."""
    lines = [(r["type"], r["source"], json.dumps(r["record"])) for r in records]
    df = spark.createDataFrame(lines, "type_id string, source_id string, value string")
    df = df.select("*", F.from_json("value", schemas.EVIDENCE).alias("r"))
    df = df.select("type_id", "source_id", "r.*")
    return df.select(
        "type_id",
        "source_id",
        F.lit("id1").alias("id"),
        F.struct(*flat_columns(scores.INPUT_PATHS, scores.PRESENCE_PATHS)).alias("resource_data"),
    )


def score(spark, type_id, source_id, evidence, fields=None, **options):
    record = {"evidence": evidence, "unique_association_fields": fields or {}}
    df = frame(spark, [{"type": type_id, "source": source_id, "record": record}])
    value = scores.evidence_score(F.col("type_id"), F.col("source_id"), label=F.col("id"), **options)
    return df.select(value.alias("s")).first().s


def rs(value, kind=None):
    return {"resource_score": {"value": value, **({"type": kind} if kind else {})}}


def mutations(*pairs):
    return [
        {"number_samples_with_mutation_type": a, "number_mutated_samples": b} for a, b in pairs
    ]


CASES = [
    ("known_drug", "chembl", {"drug2clinic": rs(0.4), "target2drug": rs(2)}, None, 0.8),
    ("animal_model", "phenodigm", {"disease_model_association": rs(0.25)}, None, 0.25),
    (
        "rna_expression", "expression_atlas",
        # Half of the decades of the p-value, 4 of 10 and 50 of 100.
        {**rs(1e-5), "log2_fold_change": {"value": 4, "percentile_rank": 50}}, None, 0.5 * 0.4 * 0.5,
    ),
    (
        "rna_expression", "expression_atlas",
        {**rs(1e-12), "log2_fold_change": {"value": -40, "percentile_rank": 100}}, None, 1.0,
    ),
    # Half way between 1e-4 and 1e-14, in the upper half.
    ("affected_pathway", "slapenrich", rs(1e-9, "pvalue"), None, 0.75),
    ("affected_pathway", "reactome", rs(0.4, "probability"), None, 0.4),
    ("literature", "europepmc", rs(37), None, 0.37),
    ("literature", "europepmc", rs(370), None, 1.0),
    ("literature", "other", rs(37), None, 37.0),
    ("somatic_mutation", "intogen", {**rs(0.8), "known_mutations": mutations((4, 25))}, None, 0.8 * (0.5 + 0.2 / 18)),
    ("somatic_mutation", "intogen", rs(0.8), None, 0.8),
    ("somatic_mutation", "intogen", {**rs(0.8), "known_mutations": []}, None, 0.8),
    (
        "somatic_mutation", "intogen",
        {**rs(1.0), "known_mutations": mutations((None, 900), (50, 10), (3, 20))}, None,
        0.5 + 1 / 18,
    ),
    ("genetic_association", "uniprot", rs(0.3, "probability"), None, 0.3),
    ("genetic_association", "uniprot", rs(1e-5, "pvalue"), None, 0.5),
    (
        "genetic_association", "eva",
        {"gene2variant": rs(0.2), "variant2disease": rs(1e-3, "pvalue")}, None, 0.3 * 0.2,
    ),
    (
        "genetic_association", "eva",
        {"gene2variant": rs(0.2), "variant2disease": rs(0.5, "probability")}, None, 0.1,
    ),
    (
        "genetic_association", "gwas_catalog",
        {"gene2variant": rs(0.5), "variant2disease": {**rs(1e-9), "gwas_sample_size": 2500}}, None,
        0.6 * 0.5 * 0.5,
    ),
    (
        "genetic_association", "phewas_catalog",
        {"gene2variant": {}, "variant2disease": rs(0.0)}, {"cases": "4400"}, 0.5,
    ),
    (
        "genetic_association", "twentythreeandme",
        {"gene2variant": {}, "variant2disease": rs(1e-40)}, {"cases": "400000"}, 1.0,
    ),
    ("unheard_of", "chembl", {}, None, 0.0),
]


@pytest.mark.parametrize("type_id, source_id, evidence, fields, expected", CASES)
def test_scores(spark, type_id, source_id, evidence, fields, expected):
    assert score(spark, type_id, source_id, evidence, fields) == pytest.approx(expected, abs=1e-6)


INVALID = [
    ("known_drug", "chembl", {"drug2clinic": rs(0.7)}, None),
    ("rna_expression", "expression_atlas", rs(1e-5), None),
    ("affected_pathway", "sysbio", rs(0.5), None),
    ("genetic_association", "eva", rs(0.5, "rank"), None),
    ("genetic_association", "phewas_catalog", {"gene2variant": {}, "variant2disease": rs(0.1)}, {"cases": "many"}),
    ("genetic_association", "uniprot", rs(-1.0, "pvalue"), None),
]


@pytest.mark.parametrize("type_id, source_id, evidence, fields", INVALID)
def test_invalid_records(spark, type_id, source_id, evidence, fields):
    assert score(spark, type_id, source_id, evidence, fields, on_invalid="null") is None
    with pytest.raises(Exception, match="cannot score record id1"):
        score(spark, type_id, source_id, evidence, fields)


def test_unknown_type_can_be_refused(spark):
    with pytest.raises(Exception, match="cannot score record"):
        score(spark, "unheard_of", "x", {}, allow_unknown_types=False)


def test_components(spark):
    record = {"evidence": {"drug2clinic": rs(0.7), "target2drug": rs(1)}}
    df = frame(spark, [{"type": "known_drug", "source": "chembl", "record": record}])
    parts = scores.score_components(F.col("type_id"), F.col("source_id"), weights={"drug2clinic": 0.5})
    assert df.select(parts.alias("c")).first().c == [
        Row(name="drug2clinic", score=0.7, weight=0.5),
        Row(name="target2drug", score=1.0, weight=1.0),
    ]


# --- roll-up -----------------------------------------------------------------


def expanded(spark, data):
    return spark.createDataFrame(
        data,
        "id string, source_id string, terminal_disease_id string, target_id string,"
        "score_resource double, efo_ids array<string>",
    ).transform(associate.expand_diseases)


DATA = [
    ("1", "a", "d", "t", 1.0, ["d", "up"]),
    ("2", "a", "d", "t", 0.5, ["d", "up"]),
    ("3", "b", "e", "t", 0.4, ["e", "up"]),
    ("4", "a", "up", "t", 0.2, ["up"]),
    ("5", "a", "x", "t", 0.9, None),
]
CONFIG = ScoringConfig(source_weights={"b": 0.5})


def test_source_and_association_scores(spark):
    sources = associate.source_scores(expanded(spark, DATA), CONFIG)
    found = {(r.disease_id, r.source_id): r for r in sources.collect()}
    assert set(found) == {("d", "a"), ("up", "a"), ("e", "b"), ("up", "b")}
    assert found["d", "a"].score_raw == pytest.approx(1 + 0.5 / 4)
    assert found["d", "a"].score == 1.0
    up = 1 + 0.5 / 4 + 0.2 / 9
    assert found["up", "a"].score_raw == pytest.approx(up) and found["up", "a"].is_direct
    assert found["up", "b"].score == pytest.approx(0.2) and not found["up", "b"].is_direct
    pairs = {r.disease_id: r for r in associate.association_scores(sources, CONFIG).collect()}
    # Not clipped, unlike the score of a source.
    assert pairs["up"].score == pytest.approx(1 + 0.2 / 4)
    assert pairs["up"].source_ids == ["a", "b"] and pairs["up"].is_direct


def test_only_the_best_count(spark):
    data = [(str(i), "a", "d", "t", i / 1000, ["d"]) for i in range(300)]
    sources = associate.source_scores(expanded(spark, data), ScoringConfig(top_k=100))
    expected = sum((299 - r) / 1000 / (r + 1) ** 2 for r in range(100))
    assert sources.first().score_raw == pytest.approx(expected)


def test_evidence_scores_rank_all(spark):
    found = {(r.id, r.disease_id): r for r in associate.evidence_scores(expanded(spark, DATA), CONFIG).collect()}
    assert [found[i, "up"].rid for i in "124"] == [1, 2, 3]
    assert found["2", "up"].score == pytest.approx(0.125)


def test_direct_sources_count_for_their_own_disease(spark):
    df = spark.createDataFrame(
        [("expression_atlas", "d", ["d", "up"]), ("eva", "d", ["d", "up"])],
        "source_id string, disease_id string, efo_codes array<string>",
    )
    found = {r.source_id: r.efo_ids for r in associate.disease_scope(df).collect()}
    assert found == {"expression_atlas": ["d"], "eva": ["d", "up"]}


def test_scores_use_no_python_workers(spark, plan):
    df = frame(spark, [{"type": "known_drug", "source": "chembl", "record": {"evidence": {}}}])
    value = scores.evidence_score(F.col("type_id"), F.col("source_id"), on_invalid="null")
    assert "Python" not in plan(df.select(value))


def test_parse_json_reads_texts_once(spark, plan):
    df = spark.createDataFrame([('{"type": "a", "sourceID": "b"}',)], "value string")
    parsed = parse_json(df, schemas.EVIDENCE).filter("type = 'a' AND sourceID = 'b'")
    text = plan(parsed)
    assert text[text.index("== Physical Plan ==") :].count("from_json") == 1
