"""Comparison of two releases of the same records."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.operators import compare
from catalog.registry import query
from catalog.views import table, text

# Two releases of the orders: each lacks some, some fields differ.
RELEASES_SQL = """
v1 AS (
  SELECT o_orderkey AS id, o_orderpriority AS source, o_custkey AS cust, o_totalprice AS score,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS status
  FROM orders WHERE o_orderkey % 10 <> 1
),
v2 AS (
  SELECT o_orderkey AS id, o_orderpriority AS source,
    CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END AS cust,
    CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice + 1
         WHEN o_orderkey % 9 = 1 THEN o_totalprice + 0.0000001 ELSE o_totalprice END AS score,
    CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS status
  FROM orders WHERE o_orderkey % 10 <> 2
)"""


def releases(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_orderkey": "id", "o_orderpriority": "source"}
    )
    key, cust, price = F.col("id"), F.col("o_custkey"), F.col("o_totalprice")
    status = F.col("o_orderstatus")
    v1 = orders.filter(key % 10 != 1).select(
        "id", "source", cust.alias("cust"), price.alias("score"),
        F.when(key % 4 != 0, status).alias("status"),
    )
    v2 = orders.filter(key % 10 != 2).select(
        "id",
        "source",
        F.when(key % 7 == 0, cust + 1).otherwise(cust).alias("cust"),
        F.when(key % 9 == 0, price + 1)
        .when(key % 9 == 1, price + 0.0000001)
        .otherwise(price)
        .alias("score"),
        F.when(key % 6 != 0, status).alias("status"),
    )
    return v1, v2


PRESENCE = """SELECT coalesce(v2.id, v1.id) AS id, coalesce(v2.source, v1.source) AS source,
  CASE WHEN v1.id IS NULL THEN 'v2_only' WHEN v2.id IS NULL THEN 'v1_only' ELSE 'both' END
  AS status FROM v1 FULL JOIN v2 ON v1.id = v2.id"""


@query("presence_diff", f"WITH {RELEASES_SQL} {PRESENCE}")
def presence_diff(spark, sf_dir):
    return compare.presence(*releases(spark, sf_dir), ["id"], ["source"])


@query(
    "presence_counts",
    f"WITH {RELEASES_SQL}, p AS ({PRESENCE}) "
    "SELECT source, status, count(*) AS n FROM p GROUP BY ALL",
)
def presence_counts(spark, sf_dir):
    found = compare.presence(*releases(spark, sf_dir), ["id"], ["source"])
    return found.groupBy("source", "status").agg(F.count(F.lit(1)).alias("n"))


def field_sql(field: str, equal: str) -> str:
    return f"""SELECT a.source, '{field}' AS field,
      CASE WHEN a.{field} IS NULL AND b.{field} IS NULL THEN 'both_null'
        WHEN b.{field} IS NULL THEN 'v2_null' WHEN a.{field} IS NULL THEN 'v1_null'
        ELSE 'not_null' END AS status, coalesce({equal}, false) AS equal
      FROM v1 a JOIN v2 b ON a.id = b.id"""


FIELDS_SQL = " UNION ALL ".join(
    [
        field_sql("source", "a.source IS NOT DISTINCT FROM b.source"),
        field_sql("cust", "a.cust = b.cust"),
        field_sql("score", "abs(a.score - b.score) < 1e-6"),
        field_sql("status", "a.status IS NOT DISTINCT FROM b.status"),
    ]
)


@query(
    "field_diff",
    f"""WITH {RELEASES_SQL}, f AS ({FIELDS_SQL})
    SELECT source, field, status, equal, count(*) AS count FROM f GROUP BY ALL""",
)
def field_diff(spark, sf_dir):
    """All fields compared in one pass."""
    fields = ["source", "cust", "score", "status"]
    return compare.field_report(
        *releases(spark, sf_dir), ["id"], fields, ["source"], tolerance=compare.TOLERANCE
    )


@query(
    "field_diff_totals",
    f"""WITH {RELEASES_SQL}, f AS ({FIELDS_SQL})
    SELECT field, status, equal, count(*) AS n FROM f GROUP BY ALL""",
)
def field_diff_totals(spark, sf_dir):
    """Counts by source added up over sources."""
    fields = ["source", "cust", "score", "status"]
    report = compare.field_report(
        *releases(spark, sf_dir), ["id"], fields, ["source"], tolerance=compare.TOLERANCE
    )
    return report.groupBy("field", "status", "equal").agg(F.sum("count").alias("n"))


@query(
    "score_diff",
    f"""WITH {RELEASES_SQL}, b AS (
      SELECT coalesce(v1.source, v2.source) AS source, v1.score AS a, v2.score AS b
      FROM v1 FULL JOIN v2 ON v1.id = v2.id)
    SELECT source, a IS NULL AS v1_null, b IS NULL AS v2_null,
      CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN abs(a - b) < 1e-6 END AS is_equal,
      count(*) AS count FROM b GROUP BY ALL""",
)
def score_diff(spark, sf_dir):
    v1, v2 = releases(spark, sf_dir)
    return compare.score_report(v1, v2, ["id", "source"], group=["source"])


@query(
    "frame_diff",
    f"""WITH {RELEASES_SQL}
    SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN '__missing_left'
      WHEN b.id IS NULL THEN '__missing_right'
      ELSE concat_ws(',', CASE WHEN a.cust <> b.cust THEN 'cust' END,
        CASE WHEN abs(a.score - b.score) >= 1e-6 THEN 'score' END,
        CASE WHEN a.status IS DISTINCT FROM b.status THEN 'status' END) END AS fields
    FROM v1 a FULL JOIN v2 b ON a.id = b.id
    WHERE a.id IS NULL OR b.id IS NULL OR a.cust <> b.cust OR abs(a.score - b.score) >= 1e-6
      OR a.status IS DISTINCT FROM b.status""",
)
def frame_diff(spark, sf_dir):
    found = compare.differences(*releases(spark, sf_dir), ["id"])
    return found.withColumn("fields", F.array_join("fields", ","))


@query(
    "frame_diff_ordered",
    """WITH a AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS position FROM orders),
    b AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS position FROM orders
          WHERE o_orderkey > 0)
    SELECT coalesce(a.position, b.position) AS position FROM a
    FULL JOIN b ON a.position = b.position
    WHERE a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_orderkey IS DISTINCT FROM b.o_orderkey""",
)
def frame_diff_ordered(spark, sf_dir):
    """Row by row after sorting: one row missing at the front shifts all others."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    shifted = orders.filter("o_orderkey > 0")
    return compare.ordered_differences(orders, shifted, ["o_orderkey"]).select("position")


@query(
    "dup_ids",
    """WITH l AS (SELECT l_orderkey || '-' || l_linenumber AS id, l_returnflag AS grp,
        l_partkey || ':' || l_suppkey AS pair FROM lineitem),
    p AS (SELECT grp, id, count(*) AS n, count(DISTINCT pair) AS n_pairs FROM l GROUP BY ALL),
    k AS (SELECT DISTINCT id FROM p WHERE n > 1)
    SELECT grp, count(*) AS n_ids, CAST(sum(n) AS BIGINT) AS n_records,
      count(*) FILTER (WHERE n = n_pairs) AS n_ids_all_different,
      CAST(coalesce(sum(n) FILTER (WHERE n = n_pairs), 0) AS BIGINT) AS n_records_all_different
    FROM p WHERE id IN (SELECT id FROM k)
      AND id IN (SELECT o_orderkey || '-' || 2 FROM orders
                 UNION ALL SELECT o_orderkey || '-' || 3 FROM orders)
    GROUP BY ALL""",
)
def dup_ids(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        text(F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("id"),
        F.col("l_returnflag").alias("grp"),
        "l_partkey",
        "l_suppkey",
    )
    other = table(spark, sf_dir, "orders").select(
        F.explode(
            F.array(text(F.col("o_orderkey"), "-2"), text(F.col("o_orderkey"), "-3"))
        ).alias("id")
    )
    return compare.repeated_ids(lines, other, ["l_partkey", "l_suppkey"], ["grp"])


def repeats_sql(fields: dict[str, str]) -> str:
    """Differences of `a` and `b` by order and line, from what one of both has more often.

    `fields` has the condition for a difference in each.
    """
    names = ", ".join(fields)
    keys = "l_orderkey, l_linenumber"
    number = f"row_number() OVER (PARTITION BY {keys} ORDER BY {names}) AS n"
    off = ", ".join(f"CASE WHEN {c} THEN '{f}' END" for f, c in fields.items())
    return f"""
    lo AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b),
    ro AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a),
    x AS (SELECT *, {number} FROM lo),
    y AS (SELECT *, {number} FROM ro)
    SELECT * FROM (
      SELECT coalesce(x.l_orderkey, y.l_orderkey) AS l_orderkey,
        coalesce(x.l_linenumber, y.l_linenumber) AS l_linenumber,
        CASE WHEN x.n IS NULL THEN '__missing_left' WHEN y.n IS NULL THEN '__missing_right'
          ELSE concat_ws(',', {off}) END AS fields
      FROM x FULL JOIN y USING ({keys}, n)) WHERE fields <> ''"""


@query(
    "frame_diff_repeats",
    """WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem),
    b AS (SELECT l_orderkey, l_linenumber,
        l_partkey + CASE WHEN l_partkey % 97 = 5 THEN 1 ELSE 0 END AS l_partkey, l_suppkey
      FROM lineitem WHERE l_suppkey % 50 <> 3
      UNION ALL SELECT * FROM a WHERE l_partkey % 101 = 7),"""
    + repeats_sql({f: f"x.{f} <> y.{f}" for f in ("l_partkey", "l_suppkey")}),
)
def frame_diff_repeats(spark, sf_dir):
    """Equality by a key that repeats: changed, missing and doubled records."""
    left = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = F.col("l_partkey")
    changed = part + F.when(part % 97 == 5, 1).otherwise(0)
    right = left.filter("l_suppkey % 50 <> 3").withColumn("l_partkey", changed.cast(left.schema["l_partkey"].dataType))
    right = right.unionByName(left.filter(part % 101 == 7))
    found = compare.differences(left, right, ["l_orderkey", "l_linenumber"])
    return found.withColumn("fields", F.array_join("fields", ","))


# Of each record two copies a little apart; the other frame has the small
# differences the other way round, and some prices and flags are changed for good.
NEAR_SQL = """WITH a AS (
  SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE + CASE WHEN c = 1 THEN 0 ELSE 0.0000001 END AS qty,
    l_returnflag || c AS flag FROM lineitem, (VALUES (1), (2)) t(c)),
b AS (
  SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE + CASE WHEN c = 1 THEN 0.0000001 ELSE 0 END
      + CASE WHEN l_partkey % 89 = 3 THEN 0.5 ELSE 0 END AS qty,
    CASE WHEN l_suppkey % 41 = 2 THEN 'Q' || c ELSE l_returnflag || c END AS flag
  FROM lineitem, (VALUES (1), (2)) t(c) WHERE l_suppkey % 43 <> 5),"""


@query(
    "frame_diff_tolerance_repeats",
    NEAR_SQL
    + """
    -- Values are tenths apart at least, or less than the tolerance.
    s AS (SELECT l_orderkey, l_linenumber, flag, round(qty, 3) AS near, 1 AS side, qty FROM a
      UNION ALL SELECT l_orderkey, l_linenumber, flag, round(qty, 3) AS near, -1 AS side, qty FROM b),
    m AS (SELECT l_orderkey, l_linenumber, flag, near, sum(side) AS n FROM s GROUP BY ALL HAVING n <> 0),
    o AS (SELECT l_orderkey, l_linenumber, flag, near, n > 0 AS mine, unnest(generate_series(1, abs(n)::INT)) AS c FROM m),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, mine ORDER BY flag, near, c) AS k FROM o),
    x AS (SELECT * FROM r WHERE mine), y AS (SELECT * FROM r WHERE NOT mine)
    SELECT * FROM (SELECT coalesce(x.l_orderkey, y.l_orderkey) AS l_orderkey,
        coalesce(x.l_linenumber, y.l_linenumber) AS l_linenumber,
        CASE WHEN x.k IS NULL THEN '__missing_left' WHEN y.k IS NULL THEN '__missing_right'
          ELSE concat_ws(',', CASE WHEN x.near <> y.near THEN 'qty' END,
            CASE WHEN x.flag <> y.flag THEN 'flag' END) END AS fields
      FROM x FULL JOIN y USING (l_orderkey, l_linenumber, k)) WHERE fields <> ''""",
)
def frame_diff_tolerance_repeats(spark, sf_dir):
    """Repeats of a key whose order turns around within the tolerance."""
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.withColumn("c", F.explode(F.array(F.lit(1), F.lit(2))))
    qty, flag, first = F.col("l_quantity").cast("double"), text(F.col("l_returnflag"), F.col("c")), F.col("c") == 1
    keys = ["l_orderkey", "l_linenumber"]
    left = lines.select(*keys, (qty + F.when(first, 0.0).otherwise(1e-7)).alias("qty"), flag.alias("flag"))
    more = F.when(F.col("l_partkey") % 89 == 3, 0.5).otherwise(0.0)
    other = F.when(F.col("l_suppkey") % 41 == 2, text(F.lit("Q"), F.col("c"))).otherwise(flag)
    right = lines.filter("l_suppkey % 43 <> 5").select(
        *keys, (qty + F.when(first, 1e-7).otherwise(0.0) + more).alias("qty"), other.alias("flag")
    )
    found = compare.differences(left, right, keys)
    return found.withColumn("fields", F.array_join("fields", ","))


@query(
    "field_diff_repeats",
    """WITH a AS (SELECT l_orderkey AS id, l_returnflag AS flag, l_partkey AS part FROM lineitem WHERE l_linenumber <= 2),
    b AS (SELECT l_orderkey AS id, l_returnflag AS flag, l_partkey + l_partkey % 2 AS part FROM lineitem
      WHERE l_linenumber <= 1 OR l_linenumber = 4),
    n AS (SELECT id, sum(l) AS l, sum(r) AS r FROM (SELECT id, 1 AS l, 0 AS r FROM a
      UNION ALL SELECT id, 0, 1 FROM b) GROUP BY id HAVING sum(l) > 0 AND sum(r) > 0),
    p AS (SELECT a.flag AS grp, a.flag AS aflag, b.flag AS bflag, a.part AS apart, b.part AS bpart
      FROM n JOIN a USING (id) JOIN b USING (id) WHERE n.l = 1 AND n.r = 1)
    SELECT grp AS flag, 'flag' AS field, 'not_null' AS status, aflag = bflag AS equal, count(*) AS count
    FROM p GROUP BY ALL
    UNION ALL SELECT grp, 'part', 'not_null', apart = bpart, count(*) FROM p GROUP BY ALL
    UNION ALL SELECT NULL, '__repeated', CASE WHEN r = 1 THEN 'v1_repeated' WHEN l = 1 THEN 'v2_repeated'
      ELSE 'both_repeated' END, false, count(*) FROM n WHERE l > 1 OR r > 1 GROUP BY ALL""",
)
def field_diff_repeats(spark, sf_dir):
    """Ids that repeat on one side or both are counted as such."""
    lines = table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_orderkey": "id", "l_returnflag": "flag"})
    part = F.col("l_partkey")
    left = lines.filter("l_linenumber <= 2").select("id", "flag", part.alias("part"))
    right = lines.filter("l_linenumber IN (0, 1, 4)").select("id", "flag", (part + part % 2).alias("part"))
    return compare.field_report(left, right, ["id"], ["flag", "part"], ["flag"])
