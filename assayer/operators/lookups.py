"""Joins of a big frame with lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.config import BROADCAST_BYTES
from assayer.operators.ranking import first_per_key
from assayer.session import scratch_path
from assayer.sources.writers import save_and_read, size_of

# Partitions that facts without a key are dealt to.
KEYLESS = 256


def settled(df: DataFrame) -> tuple[DataFrame, int]:
    """A frame computed once, in one job, and its size in bytes.

    It is written to the shared folder as it is, without compression or
    dictionaries, so that the size of the files is that of the values.
    """
    path = scratch_path(df.sparkSession, "lookup")
    plain = {"compression": "none", "parquet.enable.dictionary": "false"}
    return save_and_read(df, path, **plain), size_of(df.sparkSession, path)


def bounded(df: DataFrame, max_bytes: int) -> DataFrame:
    """A frame computed once, marked for broadcast if its size is within the bound."""
    found, size = settled(df)
    return F.broadcast(found) if size <= max_bytes else found


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: Column,
    lookup_key: str,
    how: str = "left",
    unique: bool = False,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a lookup on its key, made unique first so that no row multiplies.

    `unique` says that it is already. The lookup is computed once (`settled`).

    Only left-sided joins (left, inner, left_semi, left_anti) are allowed: in
    those a hot key of the facts can be split over tasks, which adaptive execution
    does. Facts without a key match nothing and are dealt over many tasks.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"not a left-sided join: {how}")
    if not unique:
        lookup = first_per_key(lookup, [lookup_key])
    right, size = settled(lookup)
    same = fact_key == F.col(f"`{lookup_key}`")
    if size <= max_bytes:
        return facts.join(F.broadcast(right), same, how)
    some = F.pmod(F.monotonically_increasing_id(), F.lit(KEYLESS))
    left = facts.withColumn("__dealt_to", F.when(fact_key.isNull(), some).otherwise(0))
    right = right.withColumn("__dealt", F.lit(0).cast("bigint"))
    found = left.join(right, same & (F.col("__dealt_to") == F.col("__dealt")), how)
    return found.drop("__dealt", "__dealt_to")


def keys_in(
    df: DataFrame, keys: DataFrame, on: list[str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows whose keys occur in another frame (a semi-join, nothing collected).

    The keys may take a pass over big tables to find, so they are written to the
    shared folder: measuring and joining them reads that table.
    """
    return df.join(bounded(keys.select(*on).distinct(), max_bytes), on, "left_semi")


def match_rate(
    df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """How many rows and how many distinct keys a lookup matches.

    Keys are counted first, so the join sees one row per key.
    """
    counted = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = lookup.select(F.col(lookup_key).alias("known")).filter("known IS NOT NULL").distinct()
    joined = counted.join(bounded(known, max_bytes), F.col("key") == F.col("known"), "left")
    return joined.groupBy(F.col("known").isNotNull().alias("matched")).agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows")
    )
