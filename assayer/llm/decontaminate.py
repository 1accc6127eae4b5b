"""Benchmark decontamination by spaced seeds.

Texts become words: lower case, runs of letters and digits. A document holds an
item if 15 aligned words of both, in a row, differ in two words at most. To find
such places, six fixed masks over 12 words each look at two of four blocks of
three words and ignore the others: two substitutions spoil two blocks at most,
so one mask always fits. Documents are sampled at every fourth word and items at
every one, which still finds each such place, as every 15 words hold 12 from a
sampled one on. A hit fixes the alignment; the words around it are compared then.

Items shorter than 15 words must occur whole and unchanged, and those shorter
than `min_words` cannot identify a text and match nothing.

Everything is Spark expressions. Hits come from a broadcast join of the items'
seeds, in as many blocks of bounded size as the benchmark needs, each a pass over
the documents; no document is shuffled, only the rows of what was found.

NULL and empty texts match nothing. Items of one id count as that item, repeated
rows of a document give one result, and a document without an id is
reported under NULL. Extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm import common

WINDOW, SPAN, BLOCK_WORDS, SUBSTITUTIONS = 15, 12, 3, 2
STEP = WINDOW - SPAN + 1
MASKS = tuple(
    tuple(BLOCK_WORDS * b + w for b in kept for w in range(BLOCK_WORDS))
    for kept in combinations(range(SPAN // BLOCK_WORDS), SPAN // BLOCK_WORDS - SUBSTITUTIONS)
)
MIN_WORDS = 6
# Seeds that are broadcast at once.
SEEDS = 1_000_000


def words(text: Column) -> Column:
    """The words of a text."""
    parts = F.split(F.lower(text), "[^\\p{L}\\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _seed(hashes: Column, at: Column, offsets, tag: int) -> Column:
    return F.xxhash64(F.lit(tag), *[F.get(hashes, at + o) for o in offsets])


def _item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item key, place in the item) of all items."""
    size = F.size("item")
    long = items.filter(size >= WINDOW).select(
        "key", "item", F.explode(F.sequence(F.lit(0), size - SPAN)).alias("item_at")
    )
    seeds = F.array(*[_seed(F.col("item"), F.col("item_at"), m, i) for i, m in enumerate(MASKS)])
    return long.select(F.explode(seeds).alias("seed"), "key", "item_at")


def _hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents' words with an item's and the place where the item's first word belongs.

    The items are a block of bounded size, and so are their seeds.
    """
    at = F.explode(F.sequence(F.lit(0), F.size("doc") - SPAN, F.lit(STEP))).alias("at")
    places = docs.filter(F.size("doc") >= SPAN).select("doc_id", "doc", at)
    probe = F.array(*[_seed(F.col("doc"), F.col("at"), m, i) for i, m in enumerate(MASKS)])
    probes = places.select("doc_id", "doc", "at", F.explode(probe).alias("seed"))
    found = probes.join(F.broadcast(_item_seeds(items)), "seed")
    return found.join(F.broadcast(items), "key").select(
        "doc_id", "doc", "item_id", "item", (F.col("at") - F.col("item_at")).alias("start")
    )


def _compared(hits: DataFrame) -> DataFrame:
    """The words in common along the alignment, and the most in a window of it.

    Places outside the document spoil every window that holds them.
    """
    outside = -WINDOW
    same = F.transform(
        F.col("item"),
        lambda w, i: F.when(F.get("doc", F.col("start") + i).isNull(), outside)
        .when(F.get("doc", F.col("start") + i) == w, 1)
        .otherwise(0),
    )
    rows = hits.select("doc_id", "item_id", "start", same.alias("same"))
    best = F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.size("same") - WINDOW + 1),
            lambda k: F.aggregate(F.slice("same", k, F.lit(WINDOW)), F.lit(0), lambda s, x: s + x),
        )
    )
    total = F.size(F.filter("same", lambda x: x > 0))
    return rows.select(
        "doc_id", "item_id", "start", total.alias("n_same"), best.alias("best_window")
    )


def _whole(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Occurrences of whole items of one number of words."""
    every = range(size)
    seeds = items.filter(F.size("item") == size).select(
        "item_id", _seed(F.col("item"), F.lit(0), every, size).alias("seed"), "item"
    )
    at = F.explode(F.sequence(F.lit(0), F.size("doc") - size)).alias("start")
    places = docs.filter(F.size("doc") >= size).select("doc_id", "doc", at)
    found = places.withColumn("seed", _seed(F.col("doc"), F.col("start"), every, size))
    found = found.join(F.broadcast(seeds), "seed")
    equal = F.slice("doc", F.col("start") + 1, F.lit(size)) == F.col("item")
    return found.filter(equal).select(
        "doc_id", "item_id", "start", F.lit(size).alias("n_same"), F.lit(size).alias("best_window")
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_words: int = MIN_WORDS,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """Documents and the items they hold, with the best alignment of each pair.

    `n_same` counts its equal words, `best_window` those of its best 15 in a row
    (of all words, for shorter items), `start` is the document's word where the
    item's first belongs.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), _hashes(F.col(text)).alias("doc"))
    items = common.settle(
        benchmark.select(F.col(item_id).alias("item_id"), _hashes(F.col(text)).alias("item"))
        .filter(F.size("item") >= min_words)
        .distinct()
        .withColumn("key", F.xxhash64("item_id", "item"))
    )
    sizes = items.groupBy(F.size("item").alias("n")).count().collect()
    total = sum(r["count"] * (r["n"] - SPAN + 1) * len(MASKS) for r in sizes if r["n"] >= WINDOW)
    blocks = max(1, math.ceil(total / SEEDS))
    found = []
    for block in range(blocks):
        part = items.filter(F.pmod("key", F.lit(blocks)) == block)
        hits = _compared(_hits(rows, part))
        found.append(hits.filter(F.col("best_window") >= WINDOW - SUBSTITUTIONS))
    found += [_whole(rows, items, r["n"]) for r in sizes if r["n"] < WINDOW]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = F.max(F.struct("n_same", "best_window", (-F.col("start")).alias("back"))).alias("best")
    return every.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id",
        "item_id",
        F.col("best.n_same").alias("n_same"),
        F.col("best.best_window").alias("best_window"),
        (-F.col("best.back")).alias("start"),
    )


#: The result by comparing all aligned words, for documents of any number.
SQL = r"""
WITH doc_words AS (
  SELECT DISTINCT doc_id, list_filter(
    regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words
  FROM documents),
item_words AS (
  SELECT item_id, list_filter(
    regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words
  FROM benchmark),
d AS (SELECT doc_id, len(words) AS n_doc,
        unnest(words) AS w, unnest(range(len(words))) AS p FROM doc_words),
i AS (SELECT item_id, len(words) AS n,
        unnest(words) AS w, unnest(range(len(words))) AS q FROM item_words
      WHERE len(words) >= 6),
m AS (SELECT doc_id, item_id, n, n_doc, p - q AS start, q FROM d JOIN i USING (w)),
lines AS (SELECT doc_id, item_id, n, n_doc, start, count(*) AS n_same, list(q) AS qs
  FROM m GROUP BY ALL HAVING count(*) >= least(n, 13)),
windows AS (
  SELECT *, unnest(CASE WHEN n < 15 THEN [0] ELSE range(n - 14) END) AS k FROM lines),
counted AS (
  SELECT doc_id, item_id, n, start, n_same,
    len(list_filter(qs, lambda x: x >= k AND x < k + least(n, 15))) AS in_window
  FROM windows WHERE start + k >= 0 AND start + k + least(n, 15) <= n_doc),
best AS (SELECT doc_id, item_id, n, start, n_same, max(in_window) AS best_window
  FROM counted GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id
    ORDER BY n_same DESC, best_window DESC, start) AS r
  FROM best WHERE best_window >= CASE WHEN n < 15 THEN n ELSE 13 END)
SELECT doc_id, item_id, CAST(n_same AS INTEGER) AS n_same,
  CAST(best_window AS INTEGER) AS best_window, CAST(start AS INTEGER) AS start
FROM ranked WHERE r = 1
"""
