"""The registered queries: contract, and all of the library's against DuckDB."""

import math
import re

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as driver
from catalog import ORACLES, QUERIES, views

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["target_id", "disease_id", "score", "is_direct", "source_ids"]
    assert df.limit(1).count() == 1


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value + 0.0)
        return str(value)

    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    found = comparable(df.columns, df.collect())
    cursor = duck.execute(driver.oracle_sql()[name])
    assert found == comparable([d[0] for d in cursor.description], cursor.fetchall())


def test_record_texts_are_made_by_compiled_code(spark, plan, capsys):
    lines = views._record_lines(spark, SF_DIR)
    # The parts of a record are no function of an array's element, which is interpreted.
    assert "biological_model" in plan(lines)
    assert "lambdafunction(struct(" not in plan(lines)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        views._record_lines(spark, SF_DIR).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    # Longer methods are never compiled by the JVM.
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize(
    "name",
    [
        "json_parse",
        "lookup_rewrite_chain",
        "lookup_rewrite_left",
        "validate_disease",
        "validate_disease_summary",
        "validate_source_summary",
    ],
)
def test_records_are_parsed_by_the_fields_in_use(spark, plan, name):
    text = plan(driver.queries()[name](spark, SF_DIR))
    assert "from_json" in text and "mined_sentences" not in text
