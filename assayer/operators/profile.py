"""Profiling reports: counts, shares, histograms, coverage, examples.

All are grouped aggregates with partial aggregation, so a hot group is thinned
out before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.operators.lookups import keys_in
from assayer.operators.ranking import (
    PER_SLICE,
    SAMPLE,
    before_slices,
    cut_groups,
    first_per_key,
    with_slices_before,
)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def count_of_counts(df: DataFrame, *keys: str) -> DataFrame:
    """How many keys occur how many times."""
    return count_by(df, *keys).groupBy(F.col("n").alias("times")).agg(
        F.count(F.lit(1)).alias("n_keys")
    )


def distinct_by(df: DataFrame, keys: Sequence[str], *values: str) -> DataFrame:
    """Distinct values per group, or over all rows without keys."""
    return df.groupBy(*keys).agg(*[F.count_distinct(v).alias(f"n_{v}") for v in values])


def repeated_keys(df: DataFrame, *keys: str, more_than: int = 1) -> DataFrame:
    """Keys that occur more than so many times."""
    return count_by(df, *keys).filter(F.col("n") > more_than)


def label_set_counts(df: DataFrame, entity: str, label: str) -> DataFrame:
    """How many entities have each set of labels.

    Labels are a small vocabulary, so an entity's set is small however many
    rows it has; repeats go before the shuffle.
    """
    sets = df.groupBy(entity).agg(F.sort_array(F.collect_set(label)).alias("labels"))
    return count_by(sets, "labels")


def pivot_counts(df: DataFrame, keys: Sequence[str], by: str, values: Sequence[str]) -> DataFrame:
    """Rows per group with a column for each value; the values are named by the
    caller, which saves the pass that would look for them."""
    return df.groupBy(*keys).agg(
        *[F.count_if(F.col(by) == value).alias(value) for value in values]
    )


def flag_crosstab(df: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """Keys counted by which conditions hold for any of their rows."""
    held = [F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in flags.items()]
    return count_by(df.groupBy(key).agg(*held), *flags)


def percent_filled(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Per group, the percentage of rows with a value in each column, rounded up."""
    share = [F.ceil(F.count(c) * 100.0 / F.count(F.lit(1))).alias(f"pct_{c}") for c in columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *share)


def percent_of_entities(df: DataFrame, entity: str, label: str) -> DataFrame:
    """Entities per label, and their percentage of all entities.

    The total is a scalar subquery, one number computed once.
    """
    per_label = df.groupBy(label).agg(F.count_distinct(entity).alias("n"))
    total = df.agg(F.count_distinct(entity)).scalar()
    return per_label.withColumn("pct", F.bround(F.col("n") * 100.0 / total, 2))


def describe_by(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def bucket_of(value: Column, splits: Sequence[float]) -> Column:
    """Index of the half-open interval a value falls in, the last one closed.

    NULL outside the splits.
    """
    case = F.when(value < splits[0], None).when(value > splits[-1], None)
    for index, bound in enumerate(splits[1:]):
        case = case.when(value < bound, index)
    return case.when(value == splits[-1], len(splits) - 2).cast("int")


def histogram(
    df: DataFrame, value: str, splits: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Rows per bucket of a value."""
    return df.groupBy(*keys, bucket_of(F.col(value), splits).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def decile(percent: Column) -> Column:
    """A percentage rounded up to the next ten."""
    return F.ceil(percent / 10) * 10


def interval_coverage(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    per_slice: int = PER_SLICE,
    sample: int = SAMPLE,
) -> DataFrame:
    """Number of distinct positions that the closed integer intervals of a group cover.

    Intervals are merged in the order of their starts: each adds what lies beyond
    the furthest end before it. An interval is one row whatever its length, and
    large groups are cut into slices by start and end (`cut_groups`), which get the
    furthest end of the slices before; so neither a long interval nor a hot group
    makes a task large. An interval that ends before it starts covers nothing.
    """
    first, last = F.col(start).cast("bigint"), F.col(end).cast("bigint")
    spans = df.select(*keys, first.alias("__s"), last.alias("__e"))
    spans = spans.filter("__s <= __e").distinct()
    order = [F.col("__s"), F.col("__e")]
    sliced, large = cut_groups(spans, keys, order, per_slice, sample)
    ends = large.groupBy(*keys, "__slice").agg(F.max("__e").alias("__end"))
    before = before_slices(ends, keys, F.max("__end"), "__before")
    earlier = Window.partitionBy(*keys, "__slice").orderBy(*order)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    sliced = sliced.withColumn("__reach", F.max("__e").over(earlier))
    merged = with_slices_before(sliced, before, keys)
    # Not coalesced: the greatest value leaves out NULLs, where nothing came before.
    covered_to = F.greatest(F.col("__s") - 1, "__reach", "__before")
    return merged.groupBy(*keys).agg(
        F.sum(F.greatest(F.col("__e") - covered_to, F.lit(0))).alias("covered")
    )


def example_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """One row of each group."""
    return first_per_key(df, keys, order)


def pivot_examples(
    df: DataFrame, keys: Sequence[str], by: str, value: str, values: Sequence[str]
) -> DataFrame:
    """One value of each group and label, with the labels as columns."""
    return df.groupBy(*keys).agg(
        *[F.min(F.when(F.col(by) == v, F.col(value))).alias(v) for v in values]
    )


def ambiguous_keys(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value, with their number."""
    return (
        df.groupBy(key)
        .agg(F.count_distinct(value).alias("n_values"))
        .filter(F.col("n_values") > 1)
    )


def ambiguity_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """How many keys have more than one value and how many do not."""
    per_key = df.groupBy(key).agg((F.count_distinct(value) > 1).alias("has_multiple"))
    return count_by(per_key, "has_multiple")


def affected_rows(
    rows: DataFrame, row_key: str, lookup: DataFrame, key: str, value: str, by: Sequence[str]
) -> DataFrame:
    """Rows that refer to an ambiguous key, counted."""
    keys = ambiguous_keys(lookup, key, value).select(F.col(key).alias(row_key))
    return count_by(keys_in(rows, keys, [row_key]), *by)


def unpivot_fields(df: DataFrame, keys: Sequence[str], struct: str) -> DataFrame:
    """A struct of doubles as rows of (key, value)."""
    fields = df.select(f"{struct}.*").columns
    pairs = F.array(
        *[
            F.struct(F.lit(f).alias("key"), F.col(f"{struct}.{f}").cast("double").alias("value"))
            for f in fields
        ]
    )
    return df.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.key", "p.value")


def tagged_union(frames: dict[str, DataFrame], tag: str = "step") -> DataFrame:
    """Frames of the same columns, each marked with its name, as one."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    first, *rest = tagged
    for df in rest:
        first = first.unionByName(df)
    return first


def error_report(summaries: DataFrame) -> DataFrame:
    """Counts of rejected and valid records by step, source and reason."""
    none = F.lit("none")
    return (
        summaries.groupBy(
            "step",
            F.coalesce("sourceID", none).alias("sourceID"),
            F.coalesce("reason", none).alias("reason"),
        )
        .agg(F.sum("count").alias("count"))
        .orderBy("step", "reason", F.col("count").desc(), "sourceID")
    )
