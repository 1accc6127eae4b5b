"""A training corpus from `documents`, stage by stage.

Each stage takes what the one before kept, as a table, and returns the columns of
`documents`; the last adds the tokens. Quality, near-duplicate and contamination
stages drop rows; the secret stage replaces secrets in the texts it keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import common, decontaminate, labelled, neardup, pieces, quality, secret_scan
from assayer.llm.queries import PIECE_MODEL, REJECT_BELOW, tokenizer

# No SQL can express the fitted model of the first stage.
ORACLE_SQL = None

QUALITY_FOLDS, QUALITY_HELD_OUT = 5, 0
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    labels = common.table(spark, sf_dir, "labels", "doc_id", "quality")
    learn = labelled.fold(F.col("doc_id"), QUALITY_FOLDS) != QUALITY_HELD_OUT
    model = quality.fit(docs, labels, "quality", learn)
    score = common.free_name(docs, "score")
    return quality.score(docs, model, name=score).filter(F.col(score) >= REJECT_BELOW).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark.

    Rows are told apart by id and text, so those without an id are judged too.
    """
    key = common.free_name(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = decontaminate.contaminated(
        keyed, common.table(spark, sf_dir, "benchmark"), doc_id=key
    )
    keys = common.settle(found.select(F.col("doc_id").alias(key)).distinct())
    return common.without(keyed, keys, key).drop(key)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced and their lengths set anew."""
    spans = common.free_name(docs, "spans")
    found = secret_scan.scan(docs, spans=spans)
    found = found.withColumn("text", secret_scan.redacted(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        changed = F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        found = found.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return found.select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the number of their tokens and checksums of ids and decoded text."""
    return pieces.digests(pieces.encode_decode(docs, tokenizer(PIECE_MODEL)))


STAGES = [
    ("quality", reject_poor),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = common.scratch(common.prepare(spark), f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
