"""Nested columns, joins of lookups, sorting and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.functions.scores import flat_name
from assayer.functions.text import url_basename
from assayer.operators import lookups, nested, ranking
from catalog.registry import query
from catalog.views import table, text


def orders_nested(spark, sf_dir):
    """Orders with a struct two levels deep, NULL for the urgent ones."""
    money = F.struct(
        F.col("o_totalprice").alias("total"), text("x/", F.col("o_orderstatus")).alias("status")
    )
    who = F.struct(F.col("o_custkey").alias("cust"), money.alias("money"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        "o_orderdate",
        F.when(F.col("o_orderpriority") != "1-URGENT", who).alias("who"),
    )


@query(
    "create_struct",
    """SELECT o_orderkey, o_orderstatus AS status, o_custkey AS cust, o_orderpriority
    FROM orders""",
)
def create_struct(spark, sf_dir):
    df = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")
    df = nested.create_struct(df, "s", "o_orderstatus", "o_custkey")
    return df.select(
        "o_orderkey", F.col("s.o_orderstatus").alias("status"), F.col("s.o_custkey").alias("cust"),
        "o_orderpriority",
    )


@query(
    "append_struct",
    """SELECT o_orderkey, 'o_orderkey,s' AS columns, 'o_orderstatus,o_custkey,o_orderpriority'
      AS fields, o_orderstatus, o_custkey, o_orderpriority FROM orders""",
)
def append_struct(spark, sf_dir):
    df = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")
    df = nested.append_struct(df, "s", "o_orderstatus")
    df = nested.append_struct(df, "s", "o_custkey", "o_orderpriority")
    return df.select(
        "o_orderkey",
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(",".join(df.schema["s"].dataType.fieldNames())).alias("fields"),
        "s.*",
    )


@query(
    "mutate_nested",
    """SELECT o_orderkey, o_orderpriority, o_orderpriority <> '1-URGENT' AS found,
      CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey * 10 END AS cust,
      CASE WHEN o_orderpriority <> '1-URGENT' THEN round(o_totalprice, 2) END AS total,
      CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS status FROM orders""",
)
def mutate_nested(spark, sf_dir):
    """Rewrites at two depths; a NULL struct stays NULL, the schema stays the same."""
    before = orders_nested(spark, sf_dir)
    after = nested.mutate(
        before, {"who.cust": lambda c: c * 10, "who.money.status": url_basename}
    )
    after = after.transform(nested.same_schema(before))
    return after.select(
        "o_orderkey",
        "o_orderpriority",
        F.col("who").isNotNull().alias("found"),
        "who.cust",
        F.round("who.money.total", 2).alias("total"),
        "who.money.status",
    )


@query(
    "mutate_columns",
    """SELECT p_partkey, upper(p_name) AS name, upper(p_brand) AS brand, upper(p_type) AS type
    FROM part""",
)
def mutate_columns(spark, sf_dir):
    df = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("brand")).alias("a"),
        F.col("p_type").alias("type"),
    )
    df = nested.mutate_columns(df, ["a.name", "a.brand", "type"], F.upper)
    return df.select("p_partkey", "a.*", "type")


@query(
    "add_prefix",
    """SELECT n_nationkey AS "x:n_nationkey", n_name AS "x:n_name", n_regionkey FROM nation""",
)
def add_prefix(spark, sf_dir):
    df = table(spark, sf_dir, "nation")
    return nested.add_prefix(df, "x:", ["n_nationkey", "n_name"])


@query("drop_prefix", "SELECT r_regionkey, r_name FROM region")
def drop_prefix(spark, sf_dir):
    regions = table(spark, sf_dir, "region")
    nations = nested.add_prefix(table(spark, sf_dir, "nation"), "nation:")
    df = regions.join(nations, F.col("r_regionkey") == F.col("`nation:n_regionkey`"), "left")
    return nested.drop_prefix(df, "nation:").distinct()


@query(
    "flatten_paths",
    """SELECT o_orderkey,
      CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS who_cust,
      CASE WHEN o_orderpriority <> '1-URGENT' THEN 'x/' || o_orderstatus END AS who_money_status,
      o_orderpriority <> '1-URGENT' AS who_money_exists FROM orders""",
)
def flatten_paths(spark, sf_dir):
    paths = ("who.cust", "who.money.status")
    assert flat_name(paths[1]) == "who_money_status"
    return orders_nested(spark, sf_dir).select(
        "o_orderkey", *nested.flat_columns(paths, presence=("who.money",))
    )


@query(
    "dedupe_by_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_extendedprice DESC, l_partkey, l_suppkey) AS n FROM lineitem) WHERE n = 1""",
)
def dedupe_by_key(spark, sf_dir):
    order = [F.col("l_extendedprice").desc(), F.col("l_partkey"), F.col("l_suppkey")]
    df = ranking.first_per_key(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order
    )
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem", "l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query(
    "topk_per_group",
    """SELECT l_suppkey, l_returnflag, l_orderkey, l_partkey, l_linenumber, rid FROM (
      SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY
        l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber) AS rid FROM lineitem)
    WHERE rid <= 10""",
)
def topk_per_group(spark, sf_dir):
    order = [F.col("l_extendedprice").desc(), *map(F.col, ("l_orderkey", "l_partkey", "l_linenumber"))]
    df = ranking.top_k(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag"], order, 10)
    return df.select(
        "l_suppkey", "l_returnflag", "l_orderkey", "l_partkey", "l_linenumber",
        F.col("rid").cast("bigint").alias("rid"),
    )


@query(
    "rank_rows",
    """SELECT l_returnflag, l_orderkey, l_partkey, l_linenumber, row_number() OVER (
      PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_partkey,
      l_linenumber) AS rid FROM lineitem""",
)
def rank_rows(spark, sf_dir):
    """All rows of three big groups numbered without one task per group."""
    order = [F.col("l_extendedprice").desc(), *map(F.col, ("l_orderkey", "l_partkey", "l_linenumber"))]
    df = table(
        spark, sf_dir, "lineitem",
        "l_returnflag", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice",
    )
    return ranking.rank_rows(df, ["l_returnflag"], order).drop("l_extendedprice")


@query(
    "row_index",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS position
    FROM orders""",
)
def row_index(spark, sf_dir):
    df = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    df = ranking.rank_rows(df, [], [F.col("o_totalprice"), F.col("o_orderkey")], "position")
    return df.select("o_orderkey", "position")


@query(
    "global_top",
    """SELECT o_orderkey, round(o_totalprice, 2) AS total FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
)
def global_top(spark, sf_dir):
    df = table(spark, sf_dir, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return df.limit(25).select("o_orderkey", F.round("o_totalprice", 2).alias("total"))


@query(
    "lookup_join",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer
      ON o_custkey + 100 = c_custkey""",
)
def lookup_join(spark, sf_dir):
    """A broadcast after a check of the lookup's size."""
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    df = lookups.lookup_join(
        table(spark, sf_dir, "orders"), customers, F.col("o_custkey") + 100, "c_custkey"
    )
    return df.select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "lookup_join_shuffled",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer
      ON o_custkey + 100 = c_custkey""",
)
def lookup_join_shuffled(spark, sf_dir):
    """The same with a lookup over the size bound."""
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    df = lookups.lookup_join(
        table(spark, sf_dir, "orders"), customers, F.col("o_custkey") + 100, "c_custkey",
        max_bytes=0,
    )
    return df.select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "semi_join",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (
      SELECT o_orderkey FROM orders WHERE o_totalprice > 400000)""",
)
def semi_join(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 400000)
    keys = keys.select(F.col("o_orderkey").alias("l_orderkey"))
    df = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    return lookups.keys_in(df, keys, ["l_orderkey"])


@query(
    "match_rate",
    """SELECT c_custkey IS NOT NULL AS matched, count(DISTINCT o_custkey) AS n_keys,
      count(*) AS n_rows FROM orders LEFT JOIN customer
      ON o_custkey = c_custkey AND c_mktsegment <> 'MACHINERY' GROUP BY ALL""",
)
def match_rate(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'")
    orders = table(spark, sf_dir, "orders", "o_custkey")
    df = lookups.match_rate(orders, customers, "o_custkey", "c_custkey")
    return df.withColumn("n_rows", F.col("n_rows").cast("bigint"))


@query(
    "explode_codes",
    """SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""",
)
def explode_codes(spark, sf_dir):
    words = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(words).alias("word"))


@query(
    "explode_outer_codes",
    """SELECT p_partkey, w.word FROM part LEFT JOIN (
      SELECT p_partkey AS k, unnest(string_split(p_name, ' ')) AS word FROM part
      WHERE p_size % 2 = 0) w ON p_partkey = k""",
)
def explode_outer_codes(spark, sf_dir):
    words = F.when(F.col("p_size") % 2 == 0, F.split("p_name", " "))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode_outer(words).alias("word"))


@query(
    "topk_large_k",
    """SELECT l_returnflag, l_orderkey, l_partkey, l_linenumber, rid FROM (
      SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY
        l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber) AS rid FROM lineitem)
    WHERE rid <= 5000""",
)
def topk_large_k(spark, sf_dir):
    """A k beyond the one Spark trims groups for."""
    order = [F.col("l_extendedprice").desc(), *map(F.col, ("l_orderkey", "l_partkey", "l_linenumber"))]
    df = ranking.top_k(table(spark, sf_dir, "lineitem"), ["l_returnflag"], order, 5000)
    return df.select(
        "l_returnflag", "l_orderkey", "l_partkey", "l_linenumber", F.col("rid").cast("bigint").alias("rid")
    )


@query(
    "dedupe_nulls",
    "SELECT l_suppkey, CAST(1 AS BIGINT) AS picks FROM lineitem GROUP BY l_suppkey",
)
def dedupe_nulls(spark, sf_dir):
    """Records that differ only in which column is NULL: one pick, whatever their order."""
    df = table(spark, sf_dir, "lineitem", "l_suppkey", "l_discount", "l_linenumber")
    even = F.col("l_linenumber") % 2 == 0
    df = df.select(
        "l_suppkey",
        F.when(even, F.col("l_discount")).alias("a"),
        F.when(~even, F.col("l_discount")).alias("b"),
    )
    picks = [
        ranking.first_per_key(d, ["l_suppkey"]) for d in (df.sort("a", "b"), df.sort(F.desc("a"), "b"))
    ]
    return picks[0].union(picks[1]).distinct().groupBy("l_suppkey").agg(F.count("*").alias("picks"))
