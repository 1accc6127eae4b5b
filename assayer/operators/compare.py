"""Comparison of two frames that should hold the same records.

How often a key occurs on either side is counted first: two numbers per key, of
fixed width, added up before and after one shuffle of the keys. Only keys that
need more are then joined: those found once on both sides for their values, and
none at all where frames are equal (`differences`). Keys that repeat are counted
as such, never paired with each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.operators.ranking import first_per_key, rank_rows, same_keys
from assayer.session import scratch_path
from assayer.sources.writers import save_and_read

TOLERANCE = 1e-6
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
# Numbers that may be near each other and yet not be equal.
REALS = ("float", "double", "decimal")
# Parts of the keys whose digests are compared.
SLICES = 4096


def key_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key (`__k0`, ...) with how often it occurs on each side, `__l` and `__r`."""

    def side(df: DataFrame, l: int, r: int) -> DataFrame:
        named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
        return df.select(*named, F.lit(l).alias("__l"), F.lit(r).alias("__r"))

    both = side(left, 1, 0).unionByName(side(right, 0, 1))
    return both.groupBy(*_own(keys)).agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))


def _own(keys: Sequence[str]) -> list[str]:
    return [f"__k{i}" for i in range(len(keys))]


def repeated_between(
    left: DataFrame, right: DataFrame, keys: Sequence[str], names: tuple[str, str] = ("v1", "v2")
) -> DataFrame:
    """Keys that both frames have and at least one repeats, with their numbers on each side."""
    counts = key_counts(left, right, keys).filter("__l > 0 AND __r > 0 AND (__l > 1 OR __r > 1)")
    named = [F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)]
    return counts.select(*named, F.col("__l").alias(f"n_{names[0]}"), F.col("__r").alias(f"n_{names[1]}"))


def presence(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str] = (),
    names: tuple[str, str] = ("v1", "v2"),
) -> DataFrame:
    """Each key with `status`: in the left frame only, the right only, or both.

    Columns to carry are taken from the right frame, else from the left; of a key
    that repeats there, from one of its records, the same one in every run.
    """
    status = (
        F.when(F.col("__l") == 0, f"{names[1]}_only")
        .when(F.col("__r") == 0, f"{names[0]}_only")
        .otherwise("both")
        .alias("status")
    )
    counts = key_counts(left, right, keys)
    if not carry:
        return counts.select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], status)

    def side(df: DataFrame, number: str, where: str) -> DataFrame:
        found = df.select(*keys, *carry).join(counts.filter(where), same_keys(keys))
        return found.select(*keys, *carry, status, F.col(number).alias("__n"))

    found = side(right, "__r", "__r > 0").unionByName(side(left, "__l", "__r = 0"))
    repeats = first_per_key(found.filter("__n > 1"), keys)
    return found.filter("__n = 1").unionByName(repeats).drop("__n")


def equal_values(a: Column, b: Column, kind: str, tolerance: float) -> Column:
    """Equality of two values; NULL equals NULL, NaN equals NaN, numbers within tolerance."""
    if not kind.startswith(NUMBERS):
        return a.eqNullSafe(b)
    near = F.abs(a.cast("double") - b.cast("double")) < tolerance
    return F.coalesce(a.eqNullSafe(b) | near, F.lit(False))


def field_report(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    group: Sequence[str] = (),
    tolerance: float = 0.0,
    names: tuple[str, str] = ("v1", "v2"),
) -> DataFrame:
    """Over keys found in both frames, how often each field is NULL and equal.

    One pass for all fields: every pair of records gives one row per field, counted
    by `group` (columns of the left frame), field, status and equality. Keys that
    repeat have no pairs of records; they are counted in rows of the field
    `__repeated`, with the side or sides that repeat them as status and no group
    (`repeated_between` lists them).
    """
    kinds = dict(left.dtypes)
    repeated = key_counts(left, right, keys).filter("__l > 0 AND __r > 0 AND (__l > 1 OR __r > 1)")
    wanted = [*dict.fromkeys([*group, *fields])]
    ours = left.select(*keys, F.struct(*wanted).alias("l"))
    theirs = right.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*fields).alias("r")
    )
    matched = ours.join(repeated, same_keys(keys), "left_anti").join(theirs, same_keys(keys))

    def row(field: str) -> Column:
        a, b = F.col(f"l.{field}"), F.col(f"r.{field}")
        status = (
            F.when(a.isNull() & b.isNull(), "both_null")
            .when(b.isNull(), f"{names[1]}_null")
            .when(a.isNull(), f"{names[0]}_null")
            .otherwise("not_null")
        )
        equal = equal_values(a, b, kinds[field], tolerance)
        return F.struct(
            F.lit(field).alias("field"), status.alias("status"), equal.alias("equal")
        )

    rows = matched.select(
        *[F.col(f"l.{c}").alias(c) for c in group],
        F.explode(F.array(*[row(f) for f in fields])).alias("f"),
    )
    found = rows.groupBy(*group, "f.field", "f.status", "f.equal").count()
    sides = (
        F.when(F.col("__r") == 1, f"{names[0]}_repeated")
        .when(F.col("__l") == 1, f"{names[1]}_repeated")
        .otherwise("both_repeated")
    )
    counted = repeated.groupBy(sides.alias("status")).count()
    return found.unionByName(
        counted.select(
            *[F.lit(None).cast(kinds[c]).alias(c) for c in group],
            F.lit("__repeated").alias("field"),
            "status",
            F.lit(False).alias("equal"),
            "count",
        )
    )


def score_report(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    score: str = "score",
    group: Sequence[str] = (),
    tolerance: float = TOLERANCE,
    names: tuple[str, str] = ("v1", "v2"),
) -> DataFrame:
    """Counts of keys by presence on each side and equality of their scores.

    `group` are some of the keys. Of a key that repeats, the number of scores and
    the smallest, the largest and the mean one must agree.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.col(score).cast("double").alias(name))

    both = side(left, "__l").unionByName(side(right, "__r"), allowMissingColumns=True)
    kinds = {"least": F.min, "most": F.max, "mean": F.avg, "n": F.count}
    found = both.groupBy(*keys).agg(
        *[f(s).alias(f"{s}_{kind}") for kind, f in kinds.items() for s in ("__l", "__r")]
    )
    a, b = ({k: F.col(f"{s}_{k}") for k in kinds} for s in ("__l", "__r"))
    near = [F.abs(a[k] - b[k]) < tolerance for k in ("least", "most", "mean")]
    equal = near[0] & near[1] & near[2] & (a["n"] == b["n"])
    null = [x["least"].isNull().alias(f"{n}_null") for x, n in zip((a, b), names, strict=True)]
    return (
        found.select(*group, *null, F.when(a["least"].isNotNull() & b["least"].isNotNull(), equal).alias("is_equal"))
        .groupBy(*group, f"{names[0]}_null", f"{names[1]}_null", "is_equal")
        .count()
    )


def _digests(df: DataFrame, keys: Sequence[str], slices: int) -> DataFrame:
    """Number, sums and xor of the hashes of the records of each slice of the keys."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashed = F.xxhash64(*columns, *[c.isNull() for c in columns])
    narrow = df.select(F.pmod(F.xxhash64(*keys), F.lit(slices)).alias("slice"), hashed.alias("h"))
    # Halves, so that sums stay within a long.
    return narrow.groupBy("slice").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor("h").alias("x"),
        F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)).alias("low"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("high"),
    )


def unequal_records(left: DataFrame, right: DataFrame, keys: Sequence[str], slices: int = SLICES) -> DataFrame:
    """Records that one frame has more often than the other, with the surplus `__n` of the left.

    Both frames are first reduced to a digest for each slice of the keys. Slices
    with the same digests hold the same records; only the others are grouped. So of
    equal frames nothing but digests is shuffled.
    """
    one, two = (_digests(df, keys, slices) for df in (left, right))
    columns = ("n", "x", "low", "high")
    same = [one[c] == two[c] for c in columns]
    alike = one.join(two, [one["slice"] == two["slice"], *same]).select(one["slice"])
    # One row for each slice at most.
    unlike = F.broadcast(alike.withColumnRenamed("slice", "__same"))
    at = F.pmod(F.xxhash64(*keys), F.lit(slices)) == F.col("__same")
    both = left.withColumn("__n", F.lit(1)).unionByName(right.withColumn("__n", F.lit(-1)))
    left_over = both.join(unlike, at, "left_anti")
    return left_over.groupBy(*left.columns).agg(F.sum("__n").alias("__n")).filter("__n <> 0")


def _without_near(df: DataFrame, keys: Sequence[str], kinds: dict[str, str], tolerance: float) -> DataFrame:
    """Unequal records without those that have a partner within the tolerance.

    Records alike in all but real numbers are cut into intervals of values, one number
    after the other, where the next value is not near. In an interval narrower than
    the tolerance any record can stand for any other, so the numbers of both sides
    cancel out whatever their order.
    """
    reals = [c for c in df.columns if c in kinds and kinds[c].startswith(REALS) and c not in keys]
    by = [c for c in df.columns if c not in (*reals, "__n")]
    for i, real in enumerate(reals):
        ordered = Window.partitionBy(*by).orderBy(real)
        first = F.row_number().over(ordered) == 1
        previous = F.lag(real).over(ordered)
        new = first | ~equal_values(F.col(real), previous, kinds[real], tolerance)
        df = df.withColumn("__new", new.cast("int"))
        df = df.withColumn(f"__at{i}", F.sum("__new").over(ordered)).drop("__new")
        by.append(f"__at{i}")
    whole = Window.partitionBy(*by)
    wide = F.lit(False)
    for real in reals:
        low, high = F.min(real).over(whole), F.max(real).over(whole)
        wide |= ~equal_values(low, high, kinds[real], tolerance)
    balance = F.sum("__n").over(whole)
    df = df.withColumns({"__wide": wide, "__balance": balance})
    # What remains of an interval are as many of its records as one side has more.
    side = F.signum("__n") == F.signum("__balance")
    before = Window.partitionBy(*by, F.signum("__n")).orderBy(*reals)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.abs("__n")).over(before), F.lit(0))
    left = F.least(F.abs("__n"), F.abs("__balance") - taken) * F.signum("__n").cast("bigint")
    n = F.when(F.col("__wide"), F.col("__n")).when(side & (F.abs("__balance") > taken), left)
    return df.withColumn("__n", n).filter("__n IS NOT NULL").drop(
        "__wide", "__balance", *[f"__at{i}" for i in range(len(reals))]
    )


def differences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Keys whose records differ, with the names of the fields that do.

    A key found on one side only differs in `__missing_left` or `__missing_right`.
    Records that both sides have equally often, equal or within the tolerance, are
    no difference, in whatever order they come. What is left of a key on both sides
    is numbered by all fields and compared one by one, so a record too many on one
    side is missing on the other. The unequal records are written to the shared
    folder once, as a rule a small part of the frames, and so is what is left of them.
    """
    if left.schema.simpleString() != right.schema.simpleString():
        raise AssertionError(
            f"schemas differ:\n{left.schema.treeString()}\n{right.schema.treeString()}"
        )
    fields = [c for c in left.columns if c not in keys]
    kinds = dict(left.dtypes)
    path = scratch_path(left.sparkSession, "unequal")
    unequal = save_and_read(unequal_records(left, right, keys), path)
    near = any(kinds[f].startswith(REALS) for f in fields) and tolerance > 0
    # Each side is read several times to be numbered, which must not match it anew.
    rest = unequal
    if near:
        path = scratch_path(left.sparkSession, "rest")
        rest = save_and_read(_without_near(unequal, keys, kinds, tolerance), path)

    def side(where: str, name: str) -> DataFrame:
        one = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("__n"))).alias("__copy")
        found = rest.filter(where).select(*keys, *fields, one)
        # Fields that are equal or not come first, those that may be near last.
        exact = [f for f in fields if not kinds[f].startswith(REALS)]
        order = [F.col(f) for f in [*exact, *[f for f in fields if f not in exact], "__copy"]]
        ranked = rank_rows(found, keys, order, "__repeat")
        record = F.struct(F.lit(True).alias("found"), *[F.col(f) for f in fields])
        named = [F.col(k).alias(f"{name}_{k}") for k in keys]
        return ranked.select(*named, F.col("__repeat").alias(f"{name}__repeat"), record.alias(name))

    one, two = side("__n > 0", "l"), side("__n < 0", "r")
    on = [F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}")) for k in keys]
    both = one.join(two, [*on, F.col("l__repeat") == F.col("r__repeat")], "full")
    own = [F.when(F.col("l").isNull(), F.col(f"r_{k}")).otherwise(F.col(f"l_{k}")).alias(k) for k in keys]
    off = [
        F.when(~equal_values(F.col(f"l.{f}"), F.col(f"r.{f}"), kinds[f], tolerance), F.lit(f))
        for f in fields
    ]
    none = F.array().cast("array<string>")
    found = (
        F.when(F.col("l").isNull(), F.array(F.lit("__missing_left")))
        .when(F.col("r").isNull(), F.array(F.lit("__missing_right")))
        .otherwise(F.array_compact(F.array(*off)) if off else none)
    )
    return both.select(*own, found.alias("fields")).filter(F.size("fields") > 0)


def ordered_differences(
    left: DataFrame,
    right: DataFrame,
    order: Sequence[str],
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Compare two frames row by row after sorting both, for frames without a key."""
    by = [F.col(c) for c in order]
    position = "position"
    return differences(
        rank_rows(left, [], by, position), rank_rows(right, [], by, position), [position], tolerance
    )


def repeated_ids(
    df: DataFrame, present_in: DataFrame, pair: Sequence[str], group: Sequence[str], key: str = "id"
) -> DataFrame:
    """Ids that repeat within a group and occur in another frame.

    For each group: how many such ids and records there are, and for how many
    of them all records have different pairs (so that they likely differ in
    more than the id says).
    """
    per_id = df.groupBy(*group, key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(F.concat_ws(":", *[F.col(c) for c in pair])).alias("n_pairs"),
    )
    repeated = per_id.filter(F.col("n") > 1).select(key).distinct()
    known = present_in.select(key).distinct()
    differ = F.col("n") == F.col("n_pairs")
    return (
        per_id.join(repeated, key, "left_semi")
        .join(known, key, "left_semi")
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("n_ids"),
            F.sum("n").alias("n_records"),
            F.count_if(differ).alias("n_ids_all_different"),
            F.coalesce(F.sum(F.when(differ, F.col("n"))), F.lit(0)).alias(
                "n_records_all_different"
            ),
        )
    )
