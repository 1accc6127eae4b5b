"""Extraction of small, stratified data sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from assayer.operators.lookups import keys_in
from assayer.operators.ranking import top_k


def extract_fixture(
    df: DataFrame,
    wanted: DataFrame,
    on: list[str],
    strata: Sequence[str],
    order: Sequence[Column],
    per_stratum: int = 10,
) -> DataFrame:
    """The first rows of each stratum among the rows whose keys are wanted."""
    return top_k(keys_in(df, wanted, on), strata, order, per_stratum, rank="__rid").drop("__rid")


def referenced(table: DataFrame, key: str, rows: DataFrame, row_key: Column) -> DataFrame:
    """Rows of a reference table that an extract refers to."""
    return keys_in(table, rows.select(row_key.alias(key)), [key])
