"""Ranks within groups, for groups of any size.

A group may hold a large share of all rows, so no operator here sends a whole
group to one task:

* `top_k` keeps the first k rows of a group. Spark trims each group to k rows
  per input partition before the shuffle (WindowGroupLimit), so a reducer gets
  at most k rows per group and input partition. For a k beyond the one Spark
  trims for, all rows are ranked as below.
* `rank_rows` numbers all rows. A large group is cut into slices by its order, at
  points taken from a sample of bounded size; slices are numbered one by one and
  get the number of rows before them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Above this k Spark does not trim groups before the shuffle by itself.
GROUP_LIMIT = 1000
# Rows sampled to find where large groups are cut, and sampled rows of a slice.
SAMPLE, PER_SLICE = 1 << 16, 1 << 6


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rid",
    fan_in: int = 1,
) -> DataFrame:
    """The first k rows of each group, with their rank from 1.

    With `fan_in` above 1 the rows of a group first meet in that many reducers
    by input partition, and only the k survivors of each go on to the last one.
    It costs a second shuffle of all survivors, which pays only where so many
    input partitions (hundreds of thousands) feed one group that k rows of each
    are too many for one task. The result is the same.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > min(threshold, GROUP_LIMIT):
        ranked = rank_rows(df, keys, order, rank)
        return ranked.withColumn(rank, F.col(rank).cast("int")).filter(F.col(rank) <= k)
    if fan_in > 1:
        part = "__input_part"
        # A row's reducer may depend on its input partition: the first k rows of
        # a group are among the first k of each part, however it is split.
        split = df.withColumn(part, F.spark_partition_id() % fan_in)
        df = _limit(split, [*keys, part], order, k, rank).drop(part, rank)
    return _limit(df, keys, order, k, rank)


def _limit(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str
) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


class _Term:
    """One column of an order: its value and which of two values comes first."""

    def __init__(self, column: Column) -> None:
        text = re.fullmatch(r"Column<'(.*)'>", str(column), re.DOTALL)[1]
        # How Spark writes an order: expression, direction, place of NULLs.
        found = re.fullmatch(r"(.*?)(?: (ASC|DESC) NULLS (FIRST|LAST))?", text, re.DOTALL)
        self.desc = found[2] == "DESC"
        self.nulls_first = found[3] == "FIRST" if found[2] else True
        self.value = F.expr(found[1]) if found[2] else column

    def before(self, a: Column, b: Column) -> Column:
        """Whether a comes before b, for values that are not the same."""
        first = a > b if self.desc else a < b
        null = F.lit(self.nulls_first)
        return F.when(a.isNull(), null).when(b.isNull(), ~null).otherwise(first)


def _not_after(terms: Sequence[_Term], a: Callable[[int], Column], b: Callable[[int], Column]) -> Column:
    """Whether row a comes before row b or is at its place, given their values by term."""
    result = F.lit(True)
    for i, term in reversed(list(enumerate(terms))):
        result = F.when(a(i).eqNullSafe(b(i)), result).otherwise(term.before(a(i), b(i)))
    return result


def _cuts(
    df: DataFrame, keys: Sequence[str], terms: Sequence[_Term], per_slice: int, sample: int
) -> DataFrame:
    """Where groups are cut: per large group the first rows of its slices but one.

    A sample of some `sample` rows, chosen by their hash, is ranked in each group,
    and every so many of its rows is a cut. Rows at the same place count once. So
    there are no more than sample / per_slice cuts in all, whatever the size of
    the frame.
    """
    places = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    places += [t.value.alias(f"__o{i}") for i, t in enumerate(terms)]
    narrow = df.select(*places)
    total = df.agg(F.count(F.lit(1))).scalar()
    one_in = F.greatest(F.lit(1).cast("bigint"), F.floor(total / sample))
    chosen = narrow.filter(F.pmod(F.xxhash64(*narrow.columns), one_in) == 0).distinct()
    own = [f"__k{i}" for i in range(len(keys))]
    sort = [_directed(t, F.col(f"__o{i}")) for i, t in enumerate(terms)]
    number = F.row_number().over(Window.partitionBy(*own).orderBy(*sort))
    cuts = chosen.withColumn("__n", number).filter(F.col("__n") % per_slice == 0)
    row = F.struct("__n", *[f"__o{i}" for i in range(len(terms))])
    return cuts.groupBy(*own).agg(F.sort_array(F.collect_list(row)).alias("__cuts"))


def _directed(term: _Term, column: Column) -> Column:
    if term.desc:
        return column.desc_nulls_first() if term.nulls_first else column.desc_nulls_last()
    return column.asc_nulls_first() if term.nulls_first else column.asc_nulls_last()


def cut_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    per_slice: int = PER_SLICE,
    sample: int = SAMPLE,
) -> tuple[DataFrame, DataFrame]:
    """The frame with a column `__slice`, and the same for large groups alone.

    Slices follow each other in the order, and those of the largest groups have
    about 1 / (sample / per_slice) of all rows; groups much smaller than that are
    one slice, 0. Rows at the same place of the order stay in one slice. Passes over keys
    and order alone find the cuts, which are broadcast, being at most
    sample / per_slice in number. The frame must have the same rows each time it is
    computed.
    """
    terms = [_Term(c) for c in order]
    cuts = F.broadcast(_cuts(df, keys, terms, per_slice, sample))
    own = [f"__k{i}" for i in range(len(keys))]
    steps = [F.lit(1 << b) for b in range(max(sample // per_slice, 1).bit_length(), -1, -1)]

    def step(at: Column, size: Column) -> Column:
        cut = F.get("__cuts", at + size - 1)
        reached = _not_after(terms, lambda i: cut[f"__o{i}"], lambda i: terms[i].value)
        return F.when((at + size <= F.size("__cuts")) & reached, at + size).otherwise(at)

    # The number of cuts not after a row, by halving.
    place = F.aggregate(F.array(*steps), F.lit(0), step)
    place = F.when(F.col("__cuts").isNull(), 0).otherwise(place)

    def cut(how: str) -> DataFrame:
        joined = df.join(cuts, same_keys(keys), how)
        return joined.withColumn("__slice", place).drop("__cuts", *own)

    return cut("left"), cut("inner")


def same_keys(keys: Sequence[str]) -> Column:
    """Keys equal those renamed to `__k0`, ...; NULL keys, which `=` would not match, too."""
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return reduce(Column.__and__, on, F.lit(True))


def before_slices(sizes: DataFrame, keys: Sequence[str], total: Column, name: str) -> DataFrame:
    """For each slice (`__at`, with its group as `__k0`, ...) a total over the slices before.

    There are about as many rows as cuts, so the result can be broadcast.
    """
    earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    renamed = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    return F.broadcast(
        sizes.select(*renamed, F.col("__slice").alias("__at"), total.over(earlier).alias(name))
    )


def with_slices_before(sliced: DataFrame, before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of slices with the totals of `before_slices`; NULL for whole groups."""
    on = same_keys(keys) & (F.col("__slice") == F.col("__at"))
    return sliced.join(before, on, "left")


def rank_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank: str = "rid",
    per_slice: int = PER_SLICE,
    sample: int = SAMPLE,
) -> DataFrame:
    """Number all rows of each group from 1; `order` should be a total order.

    Without keys the frame is numbered as a whole. Full rows are shuffled once, by
    group and slice (`cut_groups`); the rows of the slices of large groups are counted
    before that.
    """
    sliced, large = cut_groups(df, keys, order, per_slice, sample)
    sizes = large.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__size"))
    before = before_slices(sizes, keys, F.sum("__size"), "__before")
    local = Window.partitionBy(*keys, "__slice").orderBy(*order)
    ranked = sliced.withColumn("__own", F.row_number().over(local).cast("bigint"))
    total = F.col("__own") + F.coalesce(F.col("__before"), F.lit(0))
    found = with_slices_before(ranked, before, keys)
    return found.select(*[F.col(c) for c in df.columns], total.alias(rank))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key, the first by `order`.

    Without an order it is the one with the smallest hash of all its columns and
    of which of them are NULL, ties broken by its JSON text: an arbitrary choice,
    but the same one in every run.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashed = F.xxhash64(*columns, *[c.isNull() for c in columns])
    chosen = list(order) or [hashed, F.to_json(F.struct(*columns))]
    return top_k(df, keys, chosen, 1, rank="__rank").drop("__rank")


def harmonic_term(score: Column, rank: Column) -> Column:
    """Share of a score in a harmonic sum, by its rank."""
    return score / F.pow(rank.cast("double"), F.lit(2.0))
