"""Profile of protein entries, nested records as read from XML.

All sections of the report come from one pass: an entry gives one array of facts,
each a section, a label and whether a text was there, and facts are counted by
section and label in one aggregation with partial sums. Whatever needs the whole
of an entry (sets of types, positions its features cover) is computed within its
row, from its own lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.operators.profile import decile

FACT = "array<struct<section:string,label:string,filled:boolean>>"


def covered_positions(begins_ends: Column) -> Column:
    """Positions that closed intervals of one record cover, given as structs (begin, end)."""
    known = F.filter(begins_ends, lambda x: x["begin"] <= x["end"])
    start = F.struct(F.lit(None).cast("bigint").alias("reach"), F.lit(0).cast("bigint").alias("n"))

    def merge(state: Column, x: Column) -> Column:
        first = F.greatest(x["begin"], state["reach"] + 1)
        more = F.greatest(x["end"] - first + 1, F.lit(0).cast("bigint"))
        return F.struct(F.greatest(state["reach"], x["end"]).alias("reach"), (state["n"] + more).alias("n"))

    return F.aggregate(F.sort_array(known), start, merge, lambda state: state["n"])


def feature_spans(features: Column) -> Column:
    """Where features lie: from begin to end, or at one position."""
    def span(f: Column) -> Column:
        one = f["location"]["position"]["_position"]
        ends = {
            side: F.coalesce(f["location"][side]["_position"], one).cast("bigint").alias(side)
            for side in ("begin", "end")
        }
        return F.struct(ends["begin"], ends["end"])

    return F.transform(features, span)


def _facts(section: str, labels: Column, filled: Column | None = None) -> Column:
    """Facts of a section from an array of labels, and one of flags beside it."""
    none = F.array().cast("array<string>")
    if filled is None:
        fact = lambda label: F.struct(F.lit(section), label, F.lit(True))
        return F.transform(F.coalesce(labels, none), fact).cast(FACT)
    pairs = F.arrays_zip(labels.alias("label"), filled.alias("filled"))
    found = F.transform(pairs, lambda p: F.struct(F.lit(section), p["label"], p["filled"]))
    return F.coalesce(found, F.array()).cast(FACT)


def entry_report(entries: DataFrame, decimals: int = 2) -> DataFrame:
    """Counts by section and label, with the share of all entries and of filled texts.

    Sections: `entries`; `accessions` (how many an entry has); `comment_type` (entries
    with such a comment); `comment_text` (comments of a type, and those with a text);
    `comment_types` (the set of an entry's types); `feature_type` (features);
    `coverage` (percentage of the sequence that features cover, in tens rounded up).
    Missing lists are empty; entries without a length have no coverage.
    """
    types = F.array_compact(F.col("comment._type"))
    own = F.array_sort(F.array_distinct(types))
    length = F.col("sequence._length").cast("double")
    covered = covered_positions(feature_spans(F.col("feature")))
    percent = decile(F.lit(100.0) * F.coalesce(covered, F.lit(0)) / length).cast("bigint").cast("string")
    facts: Sequence[Column] = (
        _facts("entries", F.array(F.lit("all"))),
        _facts("accessions", F.array(F.coalesce(F.size(F.col("accession")), F.lit(0)).cast("string"))),
        _facts("comment_type", own),
        _facts(
            "comment_text",
            F.transform("comment", lambda c: c["_type"]),
            F.transform("comment", lambda c: c["text"]["_VALUE"].isNotNull()),
        ),
        _facts("comment_types", F.array(F.coalesce(F.array_join(own, ","), F.lit("")))),
        _facts("feature_type", F.transform("feature", lambda f: f["_type"])),
        _facts("coverage", F.when(length > 0, F.array(percent))),
    )
    rows = entries.select(F.explode(F.concat(*facts)).alias("f"))
    counts = rows.groupBy("f.section", "f.label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("f.filled").alias("n_filled")
    )
    # A window over the few rows of the report.
    total = F.max(F.when(F.col("section") == "entries", F.col("n"))).over(Window.partitionBy())
    return counts.select(
        "section",
        "label",
        "n",
        F.bround(F.col("n") * 100.0 / total, decimals).alias("pct_entries"),
        F.ceil(F.col("n_filled") * 100.0 / F.col("n")).alias("pct_filled"),
    )
