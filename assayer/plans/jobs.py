"""Evidence preparation, score preparation and score calculation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.config import EvidenceConfig, ScoringConfig
from assayer.functions.scores import INPUT_PATHS, PRESENCE_PATHS
from assayer.functions.text import add_record_id
from assayer.operators import associate, checks, normalize
from assayer.operators.nested import aligned_type, pruned_type, same_schema
from assayer.session import scratch_path
from assayer.sources import schemas
from assayer.sources.readers import (
    infer_json_type,
    parse_json,
    parsed_fields,
    step_summaries_path,
)
from assayer.sources.writers import save, save_and_read

# Checks in the order they run; a record is rejected by the first it fails.
STEPS = ("schema", "target_id", "disease_id", "data_source")
VALID = "none"
# The fields that identify a record.
IDENTITY = "unique_association_fields"


@dataclass(frozen=True)
class ReferenceTables:
    """What evidence records are looked up in."""

    genes: DataFrame
    diseases: DataFrame
    non_reference: DataFrame
    eco_scores: DataFrame


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass this point, as part of whatever job runs.

    The count is in `observation.get["rows"]` once an action has finished.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


class StepLog:
    """Rows and schema of the steps of a job, found out by the one action that runs it.

    Each mark adds an observation to the plan, no pass of its own. The counts are
    there when the action is done.
    """

    def __init__(self) -> None:
        self.steps: list[tuple[str, Observation, str]] = []

    def mark(self, df: DataFrame, step: str, passing: Column | None = None) -> DataFrame:
        """Note a step: all its rows, and those for which `passing` holds (all without)."""
        seen = Observation(f"{len(self.steps)} {step}")
        good = F.lit(True) if passing is None else passing
        self.steps.append((step, seen, df.schema.treeString()))
        every = F.count(F.lit(1)).alias("rows")
        return df.observe(seen, every, F.count_if(good).alias("passed"))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row a step, in their order; only after the action."""
        rows = [
            (i, step, seen.get["rows"], seen.get["passed"], schema)
            for i, (step, seen, schema) in enumerate(self.steps)
        ]
        kind = "number int, step string, rows bigint, passed bigint, schema string"
        return spark.createDataFrame(rows, kind)


def steps_path(out: str) -> str:
    """Where a job that writes to `out` puts the counts and schemas of its steps."""
    return f"{out}/steps.parquet"


def _open_identity(kind: T.StructType | str) -> tuple[T.StructType, dict[str, T.DataType]]:
    """A schema whose identifying fields are a map with every key of a record.

    A schema lists the fields that are read. All fields a record has identify
    it, though, so the listed ones, with their types, are taken from the map.
    """
    found = as_type(kind)
    if IDENTITY not in found.names or not isinstance(found[IDENTITY].dataType, T.StructType):
        return found, {}
    every = T.MapType(T.StringType(), T.StringType())
    fields = [T.StructField(f.name, every if f.name == IDENTITY else f.dataType) for f in found]
    return T.StructType(fields), {f.name: f.dataType for f in found[IDENTITY].dataType}


def as_type(kind: T.StructType | str) -> T.StructType:
    return T.DataType.fromDDL(kind) if isinstance(kind, str) else kind


def record_kind(lines: DataFrame, schema: T.StructType | str | None) -> T.StructType | str:
    """The type to read records by: the one given, or else the one the texts have,
    with the paths that the steps need and no text has.
    """
    if schema is not None:
        return schema
    return aligned_type(T.DataType.fromDDL(infer_json_type(lines)), schemas.EVIDENCE)


def parse_evidence(lines: DataFrame, schema: T.StructType | str | None = schemas.EVIDENCE):
    """JSON texts as nested records with their id."""
    kind, listed = _open_identity(record_kind(lines, schema))
    return add_record_id(parse_json(lines, kind), listed=listed)


def parse_fields(
    lines: DataFrame, paths: Iterable[str], schema: T.StructType | str | None = schemas.EVIDENCE
) -> DataFrame:
    """The fields of nested records at some paths, without their id.

    Spark does not prune what a generator parses, and a record's many other fields
    cost more to make and to copy than those that a job of few fields needs.
    """
    return parse_json(lines, pruned_type(as_type(record_kind(lines, schema)), paths))


def fields_in_use(kind: T.StructType, paths: Iterable[str]) -> T.StructType:
    """A record type with the fields at some paths, and what the steps of a job need."""
    # A record's own context is added to by the steps.
    own = [c for c in ("context",) if c in kind.names]
    return pruned_type(kind, [*paths, *normalize.READ_PATHS, "sourceID", IDENTITY, *own])


def normalize_evidence(
    df: DataFrame, refs: ReferenceTables, config: EvidenceConfig = EvidenceConfig()
) -> DataFrame:
    """All normalizations, in the order they build on each other."""
    df = normalize.normalize_targets(
        df, normalize.accession_lookup(refs.genes), refs.non_reference, config
    )
    df = normalize.normalize_diseases(df)
    df = normalize.normalize_types(df, config)
    df = normalize.normalize_evidence_codes(df)
    return normalize.normalize_resource_scores(df, refs.eco_scores, config)


def prepare_evidence(
    lines: DataFrame,
    refs: ReferenceTables,
    json_schema: Mapping | None = None,
    schema: T.StructType | str | None = schemas.EVIDENCE,
    config: EvidenceConfig = EvidenceConfig(),
    fields: Iterable[str] | None = None,
) -> DataFrame:
    """Valid, normalized evidence records of JSON texts, as one lazy plan.

    Rejected records are dropped as soon as a check refuses them; use
    `prepare_evidence_tables` to keep them. Given the paths of the fields that what
    follows reads, only these are parsed, besides those that the job itself needs; all
    rules of the schema and all keys of the id still count.
    """
    valid = checks.passed(checks.classify_lines(lines, json_schema))
    kind = schema
    if fields is not None:
        kind = fields_in_use(as_type(record_kind(valid, schema)), fields)
    df = normalize_evidence(parse_evidence(valid, kind), refs, config)
    for classify in (
        lambda d: checks.classify_targets(d, refs.genes, config),
        lambda d: checks.classify_diseases(d, refs.diseases, config),
        lambda d: checks.classify_sources(d, config),
    ):
        before = df
        df = checks.passed(classify(df))
        if config.assert_schemas:
            # A check may add the ancestors, but must not change a column.
            same_schema(before)(df.select(*before.columns))
    return df


def classify_evidence(
    lines: DataFrame,
    refs: ReferenceTables,
    json_schema: Mapping | None = None,
    schema: T.StructType | str | None = schemas.EVIDENCE,
    config: EvidenceConfig = EvidenceConfig(),
    log: StepLog | None = None,
) -> DataFrame:
    """All records, valid or not, with the check that refused each and why.

    A log gets the rows and the schema of each step, and how many records no
    check had refused by then. One pass: `rejected_at` is the step of the first failed check ("none" for a
    valid record), `reason` and `error` are its findings and `value` is the text
    of a record that never parsed into one.
    """
    def mark(df: DataFrame, step: str, passing: Column | None = None) -> DataFrame:
        return df if log is None else log.mark(df, step, passing)

    checked = checks.classify_lines(mark(lines, "read"), json_schema)
    checked = mark(checked, "schema", F.col("reason").isNull())
    kind, listed = _open_identity(record_kind(lines, schema))
    parsed = checked.select(
        "value",
        F.col("reason").alias("reason:schema"),
        "error",
        # A text that is not JSON has no fields, the others keep theirs.
        parsed_fields(F.col("value"), kind),
    )
    df = normalize_evidence(add_record_id(parsed, listed=listed), refs, config)
    valid = F.col("reason:schema").isNull()
    df = mark(df, "normalize", valid)
    for step, classify in (
        ("target_id", lambda d: checks.classify_targets(d, refs.genes, config)),
        ("disease_id", lambda d: checks.classify_diseases(d, refs.diseases, config)),
        ("data_source", lambda d: checks.classify_sources(d, config)),
    ):
        df = classify(df).withColumnRenamed("reason", f"reason:{step}")
        valid &= F.col(f"reason:{step}").isNull()
        df = mark(df, step, valid)
    reasons = {step: F.col(f"`reason:{step}`") for step in STEPS}
    step = F.coalesce(*[F.when(c.isNotNull(), name) for name, c in reasons.items()], F.lit(VALID))
    df = df.withColumns({"rejected_at": step, "reason": F.coalesce(*reasons.values())})
    df = df.drop(*[f"reason:{name}" for name in STEPS])
    keep_text = F.when(F.col("rejected_at") == "schema", F.col("value"))
    return df.withColumn("value", keep_text)


def step_summaries(classified: DataFrame) -> DataFrame:
    """Counts by step, source and reason, NULL for records that passed the step.

    The records are counted once by step and reason. Each of those few counts
    then adds to the passes of all steps before the one that refused it.
    """
    counts = classified.groupBy("sourceID", "rejected_at", "reason").count()
    order = F.array(*[F.lit(s) for s in STEPS])
    at = F.array_position(order, F.col("rejected_at"))
    reached = F.when(at > 0, F.slice(order, 1, at.cast("int"))).otherwise(order)
    per_step = counts.withColumn("step", F.explode(reached))
    reason = F.when(F.col("step") == F.col("rejected_at"), F.col("reason"))
    return (
        per_step.withColumn("reason", reason)
        .groupBy("step", "sourceID", "reason")
        .agg(F.sum("count").alias("count"))
    )


def prepare_evidence_tables(
    lines: DataFrame,
    refs: ReferenceTables,
    out: str,
    json_schema: Mapping | None = None,
    schema: T.StructType | str | None = schemas.EVIDENCE,
    config: EvidenceConfig = EvidenceConfig(),
) -> DataFrame:
    """Write classified evidence and its summaries; returns the valid records.

    The records are computed once and written once, split by the check that
    refused them. Summaries and valid records are read back from that table:
    the former touches three columns, the latter one partition. The rows and the
    schema of each step, observed meanwhile, become a small table, too.
    """
    path, log = f"{out}/evidence_classified.parquet", StepLog()
    classified = save_and_read(
        classify_evidence(lines, refs, json_schema, schema, config, log),
        path,
        partition_by=("rejected_at",),
    )
    save(log.table(lines.sparkSession), steps_path(out))
    summaries = step_summaries(classified)
    save(summaries, step_summaries_path(out), partition_by=("step",))
    valid = classified.filter(F.col("rejected_at") == VALID)
    return valid.drop("rejected_at", "reason", "error", "value")


# The fields of a record that its scores need; a struct whose presence counts is there
# with any field of it.
SCORE_FIELDS = (
    "target.id",
    "disease.id",
    *INPUT_PATHS,
    *[p for p in PRESENCE_PATHS if not any(q.startswith(f"{p}.") for q in INPUT_PATHS)],
)


def prepare_scores(evidence: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Flat, unique evidence records with the diseases each counts for."""
    return associate.disease_scope(associate.scoring_frame(evidence), config)


def expanded_scores(prepared: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Scored records, one row per disease each counts for."""
    return associate.expand_diseases(associate.score_evidence(prepared, config))


def calculate_scores(
    prepared: DataFrame,
    out: str,
    save_evidence_scores: bool = False,
    config: ScoringConfig = ScoringConfig(),
) -> DataFrame:
    """Write source and association scores; returns the latter.

    Association scores are computed from the written source scores, so records
    are scored and expanded once.
    """
    expanded = expanded_scores(prepared, config)
    if save_evidence_scores:
        # Ranking reads its rows several times, which must not prepare them anew.
        expanded = save_and_read(expanded, scratch_path(prepared.sparkSession, "expanded"))
        save(associate.evidence_scores(expanded, config), f"{out}/score_evidence.parquet")
    sources = save_and_read(
        associate.source_scores(expanded, config), f"{out}/score_source.parquet"
    )
    return save_and_read(
        associate.association_scores(sources, config), f"{out}/score_association.parquet"
    )
