import random
import re

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.operators import compare, lookups, nested, profile, ranking


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- nested ------------------------------------------------------------------


def nested_frame(spark):
    return spark.createDataFrame(
        [(1, ("x/y", (5, [(1, "p")]))), (2, None)],
        "k int, s struct<a:string,b:struct<c:int,d:array<struct<e:int,f:string>>>>",
    )


def test_mutate_keeps_schema_and_null_structs(spark):
    df = nested_frame(spark)
    changed = nested.mutate(
        df,
        {
            "s.a": F.upper,
            "s.b.c": lambda c: c * 10,
            "s.b.d": lambda d: F.transform(d, lambda x: x.withField("e", x["e"] + 1)),
            "k": F.col("k") + 100,
        },
    )
    assert changed.schema.simpleString() == df.schema.simpleString()
    first, second = changed.orderBy("k").collect()
    assert first.s == Row(a="X/Y", b=Row(c=50, d=[Row(e=2, f="p")])) and first.k == 101
    assert second.s is None


def test_mutate_without_changes_is_the_same_frame(spark):
    df = nested_frame(spark)
    assert rows(nested.mutate(df, {"s.b.c": lambda c: c})) == rows(df)


def test_mutate_refuses_unknown_paths(spark):
    for path in ("s.zz", "zz.a", "s.b.zz"):
        with pytest.raises(KeyError):
            nested.mutate(nested_frame(spark), {path: F.lit(1)})


def test_append_struct_creates_then_merges(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    one = nested.append_struct(df, "s", "b")
    assert one.columns == ["a", "c", "d", "s"]
    two = nested.append_struct(one.select("s", "a", "c", "d"), "s", "c", "d")
    assert two.columns == ["s", "a"]
    assert two.first().s == Row(b=2, c=3, d=4)


def test_prefixes(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert nested.add_prefix(df, "x:").columns == ["x:a", "x:b"]
    assert nested.add_prefix(df, "x:", ["b"]).columns == ["a", "x:b"]
    assert nested.drop_prefix(nested.add_prefix(df, "x:", ["b"]), "x:").columns == ["a"]


def test_same_schema(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert df.withColumn("a", F.lit(3)).transform(nested.same_schema(df)) is not None
    with pytest.raises(AssertionError, match="no change"):
        df.select("a").transform(nested.same_schema(df, "no change"))


# --- ranking -----------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one group, many ties."""
    rng = random.Random(7)
    data = [
        ("hot" if i % 3 else f"g{i % 11}", rng.randint(0, 40) / 40, i) for i in range(3000)
    ]
    data += [(None, 0.5, 5000 + i) for i in range(20)]
    return spark.createDataFrame(data, "g string, v double, i int").repartition(8)


def by_window(df, keys, order, name="rid"):
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


@pytest.mark.parametrize("fan_in", [1, 3])
def test_top_k(skewed, fan_in):
    order = [F.col("v").desc(), F.col("i")]
    expected = by_window(skewed, ["g"], order).filter("rid <= 7")
    assert rows(ranking.top_k(skewed, ["g"], order, 7, fan_in=fan_in)) == rows(expected)


def test_top_k_trims_before_the_shuffle(skewed, plan):
    text = plan(ranking.top_k(skewed, ["g"], [F.col("v")], 7))
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.index("Final") < physical.index("hashpartitioning(g") < physical.index("Partial")


def test_top_k_beyond_what_spark_trims(skewed):
    order = [F.col("v").desc(), F.col("i")]
    expected = by_window(skewed, ["g"], order).filter("rid <= 1500")
    assert rows(ranking.top_k(skewed, ["g"], order, 1500)) == rows(expected)


def test_first_per_key_tells_nulls_apart(spark):
    records = [(1, None, 0.5), (1, 0.5, None)]
    found = [
        ranking.first_per_key(spark.createDataFrame(r, "k int, a double, b double"), ["k"]).collect()
        for r in (records, records[::-1])
    ]
    assert found[0] == found[1]


def test_differences_count_repeats(spark):
    left = spark.createDataFrame([(1, "A"), (1, "B"), (2, "C")], "k int, v string")
    right = spark.createDataFrame([(1, "A"), (2, "C"), (2, "C")], "k int, v string")
    found = compare.differences(left, right, ["k"]).collect()
    assert sorted((r.k, r.fields) for r in found) == [(1, ["__missing_right"]), (2, ["__missing_left"])]
    assert compare.differences(left, left, ["k"]).isEmpty()


def test_differences_match_repeats_within_the_tolerance(spark):
    """Records that agree within the tolerance, whatever the order of their values."""
    schema = "k int, v double, u double, w string"
    left = [(1, 1.0, 2.0, "x"), (1, 1.0000001, 2.0, "y"), (2, 5.0, 1.0, "z"), (2, 5.0000001, 7.0, "z")]
    right = [(1, 1.0000001, 2.0, "x"), (1, 1.0, 2.0, "y"), (2, 5.0000001, 1.0, "z"), (2, 5.0, 7.0, "z")]
    one, two = (spark.createDataFrame(r, schema) for r in (left, right))
    assert compare.differences(one, two, ["k"]).isEmpty()
    assert compare.differences(two, one, ["k"]).isEmpty()
    more = spark.createDataFrame([*right, (1, 1.0000002, 2.0, "x"), (3, float("nan"), None, None)], schema)
    found = sorted((r.k, r.fields) for r in compare.differences(one, more, ["k"]).collect())
    assert found == [(1, ["__missing_left"]), (3, ["__missing_left"])]
    # A chain of near values is not one value.
    chain = spark.createDataFrame([(1, 0.0, 0.0, "a"), (1, 9e-7, 0.0, "a")], schema)
    other = spark.createDataFrame([(1, 9e-7, 0.0, "a"), (1, 1.8e-6, 0.0, "a")], schema)
    found = [(r.k, r.fields) for r in compare.differences(chain, other, ["k"]).collect()]
    assert found == [(1, ["v"])]


def test_equal_frames_move_digests_only(spark, plan):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), F.uuid().alias("body"), "id")
    text = plan(compare.unequal_records(df, df, ["k"]))
    physical = text[text.index("== Physical Plan ==") :]
    assert "Window" not in physical and "SortAggregate" not in physical


def test_repeated_ids_are_named(spark):
    left = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 1.0), (4, 1.0), (4, 1.0)], "id int, v double")
    right = spark.createDataFrame([(1, 1.0), (2, 1.5), (3, 1.0), (3, 1.0)], "id int, v double")
    assert rows(compare.repeated_between(left, right, ["id"])) == [(1, 2, 1)]
    assert rows(compare.field_report(left, right, ["id"], ["v"])) == [
        ("__repeated", "v1_repeated", False, 1), ("v", "not_null", False, 1),
    ]
    found = rows(compare.score_report(left, right, ["id"], "v"))
    assert sorted(map(str, found)) == sorted(
        map(str, [(False, False, False, 2), (False, True, None, 1), (True, False, None, 1)])
    )


@pytest.mark.parametrize("report", ["presence", "carry", "fields", "scores"])
def test_reports_aggregate_in_fixed_width(spark, plan, report):
    left = spark.createDataFrame([(1, "a", 1.0)], "id int, s string, v double")
    found = {
        "presence": lambda: compare.presence(left, left, ["id"]),
        "carry": lambda: compare.presence(left, left, ["id"], ["s"]),
        "fields": lambda: compare.field_report(left, left, ["id"], ["s", "v"], ["s"]),
        "scores": lambda: compare.score_report(left, left, ["id"], "v"),
    }[report]()
    assert "SortAggregate" not in plan(found)


def test_rank_rows_splits_groups(skewed):
    order = [F.col("v").desc(), F.col("i")]
    assert rows(ranking.rank_rows(skewed, ["g"], order)) == rows(by_window(skewed, ["g"], order))


def test_rank_rows_without_keys(skewed):
    ranked = ranking.rank_rows(skewed, [], [F.col("i")], "n")
    expected = {r.i: n for n, r in enumerate(skewed.orderBy("i").collect(), start=1)}
    assert {r.i: r.n for r in ranked.collect()} == expected


def test_first_per_key_is_repeatable(skewed):
    one = rows(ranking.first_per_key(skewed, ["g"]))
    assert one == rows(ranking.first_per_key(skewed.repartition(3), ["g"]))
    assert len(one) == skewed.select("g").distinct().count()


# --- lookups -----------------------------------------------------------------


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_lookup_join_never_multiplies(spark, skewed, max_bytes, plan):
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("g0", 3)], "k string, x int")
    joined = lookups.lookup_join(skewed, lookup, F.col("g"), "k", max_bytes=max_bytes)
    assert joined.count() == skewed.count()
    assert joined.filter("k is null").count() == skewed.filter("g is null or g not in ('hot','g0')").count()
    assert ("ResolvedHint (strategy=broadcast)" in plan(joined)) == (max_bytes > 0)


def test_lookup_join_refuses_other_sides(skewed):
    with pytest.raises(ValueError):
        lookups.lookup_join(skewed, skewed, F.col("g"), "g", how="full")


def test_match_rate(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    lookup = spark.createDataFrame([("a",), ("z",)], "x string")
    assert rows(lookups.match_rate(df, lookup, "k", "x")) == [(False, 2, 2), (True, 1, 2)]


# --- compare -----------------------------------------------------------------


def test_presence_does_not_pair_repeats(spark):
    left = spark.createDataFrame([(1,)] * 50 + [(2,)], "id int")
    right = spark.createDataFrame([(1,)] * 50 + [(3,)], "id int")
    assert rows(compare.presence(left, right, ["id"])) == [
        (1, "both"), (2, "v1_only"), (3, "v2_only"),
    ]


def test_differences_match_near_records_once(spark, plan):
    rows = spark.createDataFrame([(1, 1.0), (1, 1.0000001), (2, 3.0)], "k int, v double")
    found = compare.differences(rows, rows.withColumn("v", F.col("v") + 1e-8), ["k"])
    # What numbers the sides reads what is left, and windows on nothing else.
    assert "__at0" not in plan(found) and found.isEmpty()


def test_differences(spark):
    schema = "id int, v double, w array<string>, n double"
    left = spark.createDataFrame(
        [(1, 1.0, ["a"], float("nan")), (2, 2.0, None, None), (3, 3.0, ["c"], 1.0), (5, 1.0, [], 0.0)],
        schema,
    )
    right = spark.createDataFrame(
        [(1, 1.0 + 1e-9, ["a"], float("nan")), (2, 2.1, None, None), (3, 3.0, ["d"], None), (6, 1.0, [], 0.0)],
        schema,
    )
    found = {r.id: r.fields for r in compare.differences(left, right, ["id"]).collect()}
    assert found == {
        2: ["v"], 3: ["w", "n"], 5: ["__missing_right"], 6: ["__missing_left"],
    }
    assert compare.differences(left, left, ["id"]).count() == 0


def test_differences_refuses_other_schemas(spark):
    left = spark.createDataFrame([(1, 1)], "id int, v int")
    with pytest.raises(AssertionError):
        compare.differences(left, left.withColumn("v", F.lit("x")), ["id"])


def test_ordered_differences(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert compare.ordered_differences(left, left.repartition(2), ["k", "v"]).count() == 0
    other = spark.createDataFrame([(1, "a"), (1, "x"), (2, "c")], "k int, v string")
    found = compare.ordered_differences(left, other, ["k", "v"]).collect()
    assert [(r.position, r.fields) for r in found] == [(2, ["v"])]


# --- profile -----------------------------------------------------------------


@pytest.mark.parametrize("per_slice", [1, 4, 4096])
def test_interval_coverage_by_brute_force(spark, per_slice):
    rng = random.Random(3)
    data = [
        ("hot" if i % 3 else f"g{i % 5}", s := rng.randint(-30, 60), s + rng.randint(-4, 25))
        for i in range(300)
    ]
    covered = {}
    for g, s, e in data:
        covered.setdefault(g, set()).update(range(s, e + 1))
    df = spark.createDataFrame(data, "g string, s int, e int")
    found = dict(rows(profile.interval_coverage(df, ["g"], "s", "e", per_slice)))
    assert found == {g: len(p) for g, p in covered.items() if p}


def test_buckets(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.5, 1.0, 2.0, 3.0, None)], "v double")
    found = [r.b for r in df.select(profile.bucket_of(F.col("v"), [0, 1, 2]).alias("b")).collect()]
    assert found == [None, 0, 0, 1, 1, None, None]


def test_percent_of_entities(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "b")], "e int, l string")
    assert rows(profile.percent_of_entities(df, "e", "l")) == [("a", 2, 66.67), ("b", 1, 33.33)]


@pytest.mark.parametrize(("per_slice", "sample"), [(1, 1 << 16), (3, 64), (8, 500)])
def test_rank_rows_cuts_groups_by_every_column_of_the_order(spark, per_slice, sample):
    """One key with most rows, one score for most of them, NULLs in keys and order."""
    records = [
        (None if i % 7 == 0 else "hot" if i % 7 < 6 else f"g{i}", None if i % 11 == 0 else float("nan") if i % 13 == 0 else float(i % 5 // 4), i % 2 == 0, f"id{i:04}")
        for i in range(3000)
    ]
    df = spark.createDataFrame(records, "g string, score double, direct boolean, id string").repartition(5)
    order = [F.col("score").desc(), F.col("direct").asc_nulls_last(), F.col("id").desc_nulls_first()]
    for keys in (["g"], []):
        found = ranking.rank_rows(df, keys, order, per_slice=per_slice, sample=sample)
        expected = by_window(df.withColumn("one", F.lit(1)), keys or ["one"], order).drop("one")
        # As texts, since NaN is not equal to itself.
        assert sorted(map(str, rows(found))) == sorted(map(str, rows(expected)))


def test_rank_rows_moves_full_rows_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id", F.uuid().alias("body"))
    ranked = ranking.rank_rows(df, ["g"], [F.col("id")])
    plan = ranked._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert len(re.findall(r"\) Exchange\nInput \[\d+\]: \[[^\]]*body#", plan)) == 1


def test_lookups_are_computed_once(spark):
    """The lookup is read from the table that was written to measure it."""
    lookup = spark.range(50).select(F.col("id").cast("string").alias("k"), F.uuid().alias("x"))
    facts = spark.createDataFrame([("1",), (None,), ("99",), ("1",)], "g string")
    for max_bytes in (0, 1 << 20):
        joined = lookups.lookup_join(facts, lookup, F.col("g"), "k", max_bytes=max_bytes)
        assert "uuid" not in joined._jdf.queryExecution().toString()
        assert sorted(str(r.k) for r in joined.collect()) == ["1", "1", "None", "None"]


def test_aligned_type_keeps_both(spark):
    found = T.DataType.fromDDL("a BIGINT, s STRUCT<x: STRING, y: BIGINT>, l ARRAY<STRUCT<p: STRING>>")
    needed = T.DataType.fromDDL("s STRUCT<y: DOUBLE, z: STRING>, l ARRAY<STRUCT<q: INT>>, t STRING")
    assert nested.aligned_type(found, needed).simpleString() == (
        "struct<a:bigint,s:struct<x:string,y:double,z:string>,l:array<struct<p:string,q:int>>,t:string>"
    )
