"""Every stage on its own input, and the queries over small tables."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from assayer.llm import neardup, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Inputs and outputs of the stages."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        found.append((docs, spark.read.parquet(path)))
        docs = found[-1][1]
    return found


def test_columns_and_rows(spark, stages):
    names = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(out.columns == names for _, out in stages[:-1])
    counts = [out.count() for _, out in stages]
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[2]


def test_quality_stage_keeps_good_documents(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    gone = stages[0][0].join(stages[0][1], "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.filter("quality = 1").count() <= 0.05 * labels.filter("quality = 1").count()
    kept = stages[0][1].join(labels, "doc_id")
    assert kept.filter("quality = 0").count() <= 0.15 * labels.filter("quality = 0").count()


def test_duplicate_stage_is_done(stages):
    again = neardup.near_duplicates(stages[1][1], 5, 80)
    assert again.filter("NOT kept").count() == 0


def test_contamination_stage_is_done(spark, stages):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = [r.text for r in bench.collect()]
    kept = [r.text or "" for r in stages[2][1].select("text").collect()]
    assert not any(t in k for t in texts for k in kept)
    assert stages[2][1].count() >= 0.9 * stages[2][0].count()


def test_odd_documents(spark, odd_docs):
    docs = odd_docs.selectExpr("doc_id", "text", "ids AS lang", "ids AS source", "1L AS n_chars", "score AS key")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert {"doc_id", "n_tokens", "key"} <= set(docs.columns) and docs.count() > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    found = __spark_entry__.queries()[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(want.fetchall())
