"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import alignment, common, decontaminate, hard_negatives, html_text, labelled, neardup, pieces, quality, secret_scan, shard, suffix_dedup, token_files, toxicity, vector_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Where the public tokenizer files are; a parameter of the operators.
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"
END_ID = 2


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


SHARDS = 8


@query("op1_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    return shard.shard_by_bytes(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = pieces.encode_decode(docs, tokenizer(PIECE_MODEL))
    return pieces.digests(encoded.drop("text"))


SHINGLE_WORDS = 4
SIMILAR_PERCENT = 80


@query("op3_minhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    return neardup.near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


@query("op4_spaced_seeds", decontaminate.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.contaminated(docs, common.table(spark, sf_dir, "benchmark"))


REJECT_BELOW = 0.3


def _scored(spark: SparkSession, sf_dir: str, label: str, kind, folds: int, out: int) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    labels = common.table(spark, sf_dir, "labels", "doc_id", label)
    held_out = labelled.fold(F.col("doc_id"), folds) == out
    model = kind.fit(docs, labels, label, ~held_out)
    return quality.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"),
    )


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "toxic", toxicity, 4, 2)


@query("op6_html_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages", "page_id", "url", "html")
    found = html_text.main_text(pages).drop("html")
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "quality", quality, 5, 0)


@query("op7_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    found = secret_scan.scan(docs).drop("text")
    fixed = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int) -> Column:
        # Of one argument: `filter` gives a second one the place in the array.
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{name}": count(i) for i, name in enumerate(secret_scan.KINDS[:3])}
    return found.select(
        "doc_id",
        *[count.alias(name) for name, count in counts.items()],
        F.sha2(secret_scan.written(fixed).cast("binary"), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


@query("op9_token_files")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    folder = common.scratch(common.prepare(spark), "token-files")
    manifest = token_files.write_token_files(docs, tokenizer(BYTE_MODEL), END_ID, folder)
    documents = token_files.fetch(token_files.frames(manifest))
    return documents.select("doc_id", "start", "n_tokens", F.crc32("payload").alias("ids_crc32"))


SIMILAR_COSINE = 0.9


@query("op10_multi_index")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return vector_dedup.linked_vectors(vectors, SIMILAR_COSINE)


@query("op11_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    models = tokenizer(BYTE_MODEL), tokenizer(PIECE_MODEL)
    rows = alignment.aligned(docs, *models).drop("text")
    # Texts without tokens have no groups to hash.
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    rows = rows.withColumn("groups_sha256", digest).drop("groups")
    return alignment.with_totals(rows, *models).select(
        "doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256"
    )


# Of a score, the percentages between which negatives lie; how many are taken.
NEGATIVES = {"positives": 5, "negatives": 10, "low": 30, "high": 90}
SCALE, ANCHORS, RELABELLED, LABELS = 256, 100, 7, 10

NEGATIVES_SQL = """
WITH rows AS (
    SELECT vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        list_inner_product(a.vector, b.vector)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND len(a.vector) = len(b.vector)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
    SELECT p.*, n.id AS negative_id, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS rank
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % RELABELLED == 0, (F.col("label") + 1) % LABELS)
    vectors = vectors.withColumn("label", F.coalesce(moved, "label"))
    rows = common.settle(hard_negatives.scaled(vectors, SCALE))
    return hard_negatives.mine(rows, rows.filter(F.col("id") % ANCHORS == 0), **NEGATIVES)


@query("op13_suffix_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return suffix_dedup.repeated_spans(docs).select(
        "doc_id",
        "n_bytes",
        length.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
