import pytest

LONG = "lange worte " * 5_000
# Nulls, empty and blank texts, ties, repeated rows, a very long text.
ROWS = [
    (1, "one two three four five six seven eight nine ten"),
    (2, "One Two three four five six seven eight nine ten"),
    (2, "One Two three four five six seven eight nine ten"),
    (3, ""),
    (4, None),
    (None, "one two three four five six seven eight nine ten"),
    (None, None),
    (5, " \t\n "),
    (6, "word"),
    (7, LONG),
    (8, "a\x00b  c   d\n\n▁e ▁ <|endoftext|> it's 'sm   x"),
    (9, "日本 語 😀 ́accent naïve"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Difficult documents, with columns named like the operators' own."""
    rows = [(*r, r[0], "x", 1, None, 2) for r in ROWS]
    schema = SCHEMA + ", id long, ids string, score int, spans string, shard int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
