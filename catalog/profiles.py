"""Profiling reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.operators import profile
from assayer.operators.extract import extract_fixture, referenced
from assayer.operators.lookups import keys_in
from assayer.operators.ranking import top_k
from assayer.plans.jobs import counted
from assayer.session import scratch_path
from assayer.sources.writers import save
from catalog.registry import query
from catalog.views import rounded, table, text


@query(
    "count_by",
    """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL
    ORDER BY n DESC""",
)
def count_by(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.count_by(lines, "l_returnflag", "l_linestatus").orderBy(F.col("n").desc())


@query(
    "count_of_counts",
    """SELECT times, count(*) AS n_keys FROM (SELECT count(*) AS times FROM lineitem
      GROUP BY l_orderkey, l_linenumber) GROUP BY ALL""",
)
def count_of_counts(spark, sf_dir):
    return profile.count_of_counts(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "count_distinct_by",
    """SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_l_suppkey,
      count(DISTINCT l_partkey) AS n_l_partkey FROM lineitem GROUP BY ALL""",
)
def count_distinct_by(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.distinct_by(lines, ["l_returnflag"], "l_suppkey", "l_partkey")


@query(
    "count_distinct_all",
    "SELECT count(DISTINCT user_id) AS n_user_id FROM events",
)
def count_distinct_all(spark, sf_dir):
    return profile.distinct_by(table(spark, sf_dir, "events"), [], "user_id")


@query(
    "having_filter",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL
    HAVING count(*) > 2""",
)
def having_filter(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.repeated_keys(lines, "l_orderkey", "l_linenumber", more_than=2)


@query(
    "set_key_counts",
    """SELECT labels, count(*) AS n FROM (
      SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS labels
      FROM lineitem GROUP BY l_orderkey) GROUP BY ALL""",
)
def set_key_counts(spark, sf_dir):
    df = profile.label_set_counts(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag")
    return df.withColumn("labels", F.array_join("labels", ","))


@query(
    "pivot_count",
    """SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS "F",
      count(*) FILTER (WHERE l_linestatus = 'O') AS "O" FROM lineitem GROUP BY ALL""",
)
def pivot_count(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.pivot_counts(lines, ["l_returnflag"], "l_linestatus", ["F", "O"])


@query(
    "flag_crosstab",
    """SELECT returned, discounted, count(*) AS n FROM (
      SELECT l_orderkey, bool_or(l_returnflag = 'R') AS returned,
        bool_or(l_discount > 0.08) AS discounted
      FROM lineitem GROUP BY l_orderkey) GROUP BY ALL""",
)
def flag_crosstab(spark, sf_dir):
    flags = {"returned": F.col("l_returnflag") == "R", "discounted": F.col("l_discount") > 0.08}
    return profile.flag_crosstab(table(spark, sf_dir, "lineitem"), "l_orderkey", flags)


@query(
    "pct_non_null",
    """SELECT lang, count(*) AS n,
      CAST(ceil(count(CASE WHEN n_chars > 2000 THEN text END) * 100.0 / count(*)) AS BIGINT)
        AS pct_long,
      CAST(ceil(count(CASE WHEN doc_id % 3 = 0 THEN source END) * 100.0 / count(*)) AS BIGINT)
        AS pct_third FROM documents GROUP BY ALL""",
)
def pct_non_null(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select(
        "lang",
        F.when(F.col("n_chars") > 2000, F.col("text")).alias("long"),
        F.when(F.col("doc_id") % 3 == 0, F.col("source")).alias("third"),
    )
    return profile.percent_filled(df, ["lang"], ["long", "third"])


@query(
    "pct_of_total",
    """WITH t AS (SELECT count(DISTINCT user_id) AS total FROM events),
    e AS (SELECT event_type, count(DISTINCT user_id) AS n FROM events GROUP BY ALL)
    SELECT event_type, n, round(n * 100.0 / total, 2) AS pct FROM e, t""",
)
def pct_of_total(spark, sf_dir):
    return profile.percent_of_entities(table(spark, sf_dir, "events"), "user_id", "event_type")


@query(
    "describe_stats",
    """SELECT event_type, count(value) AS count, round(avg(value) + 1e-9, 6) AS mean,
      round(stddev_samp(value) + 1e-9, 6) AS stddev, round(min(value) + 1e-9, 6) AS min,
      round(max(value) + 1e-9, 6) AS max FROM events GROUP BY ALL""",
)
def describe_stats(spark, sf_dir):
    return rounded(profile.describe_by(table(spark, sf_dir, "events"), "value", "event_type"))


@query(
    "global_min_max",
    "SELECT min(l_quantity) AS lowest, max(l_quantity) AS highest FROM lineitem",
)
def global_min_max(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(
        F.min("l_quantity").alias("lowest"), F.max("l_quantity").alias("highest")
    )


@query(
    "histogram",
    """SELECT CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 1000 THEN 1
      WHEN c_acctbal < 5000 THEN 2 WHEN c_acctbal <= 9000 THEN 3 END AS bucket,
      count(*) AS n FROM customer WHERE c_acctbal >= -1000 AND c_acctbal <= 9000 GROUP BY ALL
    UNION ALL SELECT NULL AS bucket, count(*) AS n FROM customer
      WHERE c_acctbal < -1000 OR c_acctbal > 9000 HAVING count(*) > 0""",
)
def histogram(spark, sf_dir):
    splits = [-1000.0, 0.0, 1000.0, 5000.0, 9000.0]
    return profile.histogram(table(spark, sf_dir, "customer"), "c_acctbal", splits)


@query(
    "decile_histogram",
    """SELECT CAST(ceil(l_quantity / 10) * 10 AS BIGINT) AS bucket, count(*) AS n
    FROM lineitem GROUP BY ALL""",
)
def decile_histogram(spark, sf_dir):
    bucket = profile.decile(F.col("l_quantity")).cast("bigint").alias("bucket")
    return table(spark, sf_dir, "lineitem").groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))


COVERAGE_SQL = """WITH spans AS (
  SELECT l_suppkey AS grp, l_orderkey AS s, l_orderkey + l_linenumber * {step} - 3 AS e
  FROM lineitem),
positions AS (SELECT DISTINCT grp, unnest(generate_series(s, e)) AS pos FROM spans WHERE s <= e),
keys AS (SELECT DISTINCT grp FROM spans WHERE s <= e)
SELECT keys.grp, count(pos) AS covered FROM keys JOIN positions ON keys.grp = positions.grp
GROUP BY ALL"""


def spans(spark, sf_dir, step):
    start = F.col("l_orderkey")
    end = start + F.col("l_linenumber") * step - 3
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("grp"), start.alias("s"), end.alias("e")
    )


@query("interval_coverage", COVERAGE_SQL.format(step=2))
def interval_coverage(spark, sf_dir):
    """Some intervals are empty (end before start)."""
    return profile.interval_coverage(spans(spark, sf_dir, 2), ["grp"], "s", "e")


@query("interval_coverage_blocks", COVERAGE_SQL.format(step=9))
def interval_coverage_blocks(spark, sf_dir):
    """Groups cut into many slices."""
    return profile.interval_coverage(spans(spark, sf_dir, 9), ["grp"], "s", "e", per_slice=16)


@query(
    "interval_coverage_long",
    """WITH spans AS (
      SELECT l_returnflag AS grp, l_orderkey * 7000003 AS s,
        l_orderkey * 7000003 + CASE WHEN l_linenumber = 1 THEN 1000000000 ELSE l_partkey * 10 END AS e
      FROM lineitem),
    ordered AS (SELECT grp, s, e, max(e) OVER (PARTITION BY grp ORDER BY s, e
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
    islands AS (SELECT grp, s, e, sum(CASE WHEN s <= reach THEN 0 ELSE 1 END) OVER (
      PARTITION BY grp ORDER BY s, e) AS island FROM ordered),
    merged AS (SELECT grp, max(e) - min(s) + 1 AS covered FROM islands GROUP BY grp, island)
    SELECT grp, CAST(sum(covered) AS BIGINT) AS covered FROM merged GROUP BY grp""",
)
def interval_coverage_long(spark, sf_dir):
    """Intervals of 10^9 positions, in three groups of very many intervals."""
    lines = table(spark, sf_dir, "lineitem")
    start = F.col("l_orderkey") * 7000003
    length = F.when(F.col("l_linenumber") == 1, 1000000000).otherwise(F.col("l_partkey") * 10)
    df = lines.select(F.col("l_returnflag").alias("grp"), start.alias("s"), (start + length).alias("e"))
    return profile.interval_coverage(df, ["grp"], "s", "e")


@query(
    "coverage_percent",
    """WITH spans AS (
      SELECT l_partkey AS grp, CAST(l_quantity AS BIGINT) * 10 AS s,
        CAST(l_quantity AS BIGINT) * 10 + l_linenumber * 2 AS e FROM lineitem),
    p AS (SELECT DISTINCT grp, unnest(generate_series(s, e)) AS pos FROM spans),
    c AS (SELECT grp, count(*) AS covered FROM p GROUP BY ALL),
    l AS (SELECT grp, max(e) + 1 AS len FROM spans GROUP BY ALL)
    SELECT CAST(ceil(ceil(100.0 * covered / len) / 10) * 10 AS BIGINT) AS decile,
      count(*) AS n FROM c JOIN l ON c.grp = l.grp GROUP BY ALL""",
)
def coverage_percent(spark, sf_dir):
    """Share of each group's length that its intervals cover, by decile."""
    df = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("grp"),
        (F.col("l_quantity").cast("bigint") * 10).alias("s"),
        (F.col("l_quantity").cast("bigint") * 10 + F.col("l_linenumber") * 2).alias("e"),
    )
    covered = profile.interval_coverage(df, ["grp"], "s", "e")
    lengths = df.groupBy("grp").agg((F.max("e") + 1).alias("len"))
    percent = F.ceil(F.lit(100.0) * F.col("covered") / F.col("len"))
    return (
        covered.join(lengths, "grp")
        .groupBy(profile.decile(percent).cast("bigint").alias("decile"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "ambiguous_keys",
    """SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_values FROM lineitem GROUP BY ALL
    HAVING count(DISTINCT l_suppkey) > 1""",
)
def ambiguous_keys(spark, sf_dir):
    return profile.ambiguous_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@query(
    "ambiguity_counts",
    """SELECT has_multiple, count(*) AS n FROM (
      SELECT count(DISTINCT l_suppkey) > 1 AS has_multiple FROM lineitem GROUP BY l_orderkey)
    GROUP BY ALL""",
)
def ambiguity_counts(spark, sf_dir):
    return profile.ambiguity_counts(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@query(
    "affected_rows",
    """SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderkey IN (
      SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) > 1)
    GROUP BY ALL ORDER BY n DESC""",
)
def affected_rows(spark, sf_dir):
    """Orders that an ambiguous key occurs in, by priority."""
    return profile.affected_rows(
        table(spark, sf_dir, "orders"), "o_orderkey",
        table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", ["o_orderpriority"],
    ).orderBy(F.col("n").desc())


@query(
    "example_per_group",
    """SELECT l_suppkey, l_orderkey, l_partkey FROM (
      SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_partkey,
        l_linenumber) AS n FROM lineitem) WHERE n = 1""",
)
def example_per_group(spark, sf_dir):
    order = [F.col("l_orderkey").desc(), F.col("l_partkey"), F.col("l_linenumber")]
    df = profile.example_per_group(table(spark, sf_dir, "lineitem"), ["l_suppkey"], order)
    return df.select("l_suppkey", "l_orderkey", "l_partkey")


@query(
    "pivot_examples",
    """SELECT l_suppkey, min(l_orderkey) FILTER (WHERE l_returnflag = 'A') AS "A",
      min(l_orderkey) FILTER (WHERE l_returnflag = 'N') AS "N",
      min(l_orderkey) FILTER (WHERE l_returnflag = 'R') AS "R" FROM lineitem GROUP BY ALL""",
)
def pivot_examples(spark, sf_dir):
    return profile.pivot_examples(
        table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_returnflag", "l_orderkey",
        ["A", "N", "R"],
    )


@query(
    "struct_to_rows",
    """SELECT l_orderkey, l_partkey, l_linenumber, 'price' AS key, l_extendedprice AS value
      FROM lineitem UNION ALL
    SELECT l_orderkey, l_partkey, l_linenumber, 'qty', l_quantity FROM lineitem UNION ALL
    SELECT l_orderkey, l_partkey, l_linenumber, 'tax', l_tax FROM lineitem""",
)
def struct_to_rows(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.struct(
            F.col("l_quantity").alias("qty"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_tax").alias("tax"),
        ).alias("s"),
    )
    return profile.unpivot_fields(df, ["l_orderkey", "l_partkey", "l_linenumber"], "s")


@query(
    "union_tagged",
    """SELECT l_returnflag AS k, count(*) AS n, 'flag' AS step FROM lineitem GROUP BY ALL
    UNION ALL SELECT l_linestatus, count(*), 'status' FROM lineitem GROUP BY ALL
    UNION ALL SELECT o_orderpriority, count(*), 'priority' FROM orders GROUP BY ALL""",
)
def union_tagged(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return profile.tagged_union(
        {
            "flag": profile.count_by(lines, "l_returnflag").withColumnRenamed("l_returnflag", "k"),
            "status": profile.count_by(lines, "l_linestatus").withColumnRenamed(
                "l_linestatus", "k"
            ),
            "priority": profile.count_by(orders, "o_orderpriority").withColumnRenamed(
                "o_orderpriority", "k"
            ),
        }
    )


@query(
    "class_samples",
    """SELECT * FROM (SELECT p_type, p_partkey, row_number() OVER (
      PARTITION BY p_type ORDER BY p_partkey) AS rid FROM part) WHERE rid <= 5""",
)
def class_samples(spark, sf_dir):
    """A few rows of every class."""
    df = top_k(table(spark, sf_dir, "part", "p_type", "p_partkey"), ["p_type"], [F.col("p_partkey")], 5)
    return df.withColumn("rid", F.col("rid").cast("bigint"))


@query(
    "stratified_extract",
    """WITH hit AS (SELECT * FROM lineitem WHERE l_suppkey IN (
        SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag
        ORDER BY l_orderkey, l_partkey, l_linenumber) AS rid FROM hit)
    SELECT l_suppkey, l_returnflag, l_orderkey, l_partkey, l_linenumber FROM r WHERE rid <= 10""",
)
def stratified_extract(spark, sf_dir):
    """The first rows of each target and type among the targets asked for."""
    wanted = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000")
    wanted = wanted.select(F.col("s_suppkey").alias("l_suppkey"))
    order = [F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")]
    df = extract_fixture(
        table(spark, sf_dir, "lineitem"), wanted, ["l_suppkey"], ["l_suppkey", "l_returnflag"],
        order, 10,
    )
    return df.select("l_suppkey", "l_returnflag", "l_orderkey", "l_partkey", "l_linenumber")


@query(
    "extract_references",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
      SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""",
)
def extract_references(spark, sf_dir):
    """Rows of a reference table that an extract refers to."""
    rows = table(spark, sf_dir, "orders").filter("o_totalprice > 450000")
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    return referenced(customers, "c_custkey", rows, F.col("o_custkey"))


@query(
    "step_row_counts",
    """SELECT 'read' AS step, count(*) AS n FROM orders
    UNION ALL SELECT 'filtered', count(*) FROM orders WHERE o_totalprice > 100000
    UNION ALL SELECT 'distinct', count(DISTINCT o_custkey) FROM orders
      WHERE o_totalprice > 100000""",
)
def step_row_counts(spark, sf_dir):
    """Rows after each step, counted by the one job that runs them all."""
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_totalprice")
    df, read = counted(orders, "read")
    df, filtered = counted(df.filter("o_totalprice > 100000").select("o_custkey"), "filtered")
    df, distinct = counted(df.distinct(), "distinct")
    save(df, scratch_path(spark, "counted"))
    seen = {"read": read, "filtered": filtered, "distinct": distinct}
    rows = [(step, observation.get["rows"]) for step, observation in seen.items()]
    return spark.createDataFrame(rows, "step string, n bigint")


# --- entries with nested lists, as profiled from XML ------------------------


def entries(spark, sf_dir):
    """A part as an entry: accessions, comments and features in lists of structs."""
    key, size = F.col("p_partkey"), F.col("p_size")
    accessions = F.array(text("P", key), text("Q", key % 97))
    comments = F.array(
        F.struct(F.lit("function").alias("_type"), F.col("p_name").alias("text")),
        F.struct(
            F.when(size % 2 == 0, "domain").otherwise("pathway").alias("_type"),
            F.when(size % 3 == 0, F.col("p_brand")).alias("text"),
        ),
    )
    features = F.array(
        F.struct(F.lit(1).alias("begin"), size.alias("end")),
        F.struct((key % 40).cast("int").alias("begin"), (key % 40 + 5).cast("int").alias("end")),
    )
    return table(spark, sf_dir, "part").select(
        F.slice(accessions, 1, F.when(size % 5 == 0, 2).otherwise(1)).alias("accession"),
        F.col("p_type").alias("name"),
        comments.alias("comment"),
        features.alias("feature"),
        F.lit(60).alias("length"),
    )


@query(
    "entry_accession_counts",
    """SELECT CASE WHEN p_size % 5 = 0 THEN 2 ELSE 1 END AS accession_count, count(*) AS n
    FROM part GROUP BY ALL""",
)
def entry_accession_counts(spark, sf_dir):
    df = entries(spark, sf_dir).select(F.size("accession").alias("accession_count"))
    return profile.count_by(df, "accession_count")


@query(
    "entry_comment_types",
    """WITH c AS (SELECT 'function' AS type, p_partkey FROM part UNION ALL
      SELECT CASE WHEN p_size % 2 = 0 THEN 'domain' ELSE 'pathway' END, p_partkey FROM part),
    t AS (SELECT count(DISTINCT p_partkey) AS total FROM part)
    SELECT type, count(DISTINCT p_partkey) AS n,
      round(count(DISTINCT p_partkey) * 100.0 / max(total), 2) AS pct FROM c, t GROUP BY type""",
)
def entry_comment_types(spark, sf_dir):
    df = entries(spark, sf_dir).select(
        F.col("accession")[0].alias("id"), F.explode("comment").alias("c")
    )
    return profile.percent_of_entities(df.select("id", F.col("c._type").alias("type")), "id", "type")


@query(
    "entry_comment_fields",
    """SELECT type, count(*) AS n,
      CAST(ceil(count(t) * 100.0 / count(*)) AS BIGINT) AS pct_text FROM (
        SELECT 'function' AS type, p_name AS t FROM part UNION ALL
        SELECT CASE WHEN p_size % 2 = 0 THEN 'domain' ELSE 'pathway' END,
          CASE WHEN p_size % 3 = 0 THEN p_brand END FROM part) GROUP BY ALL""",
)
def entry_comment_fields(spark, sf_dir):
    df = entries(spark, sf_dir).select(F.explode("comment").alias("c"))
    df = df.select(F.col("c._type").alias("type"), F.col("c.text").alias("text"))
    return profile.percent_filled(df, ["type"], ["text"])


@query(
    "entry_type_sets",
    """SELECT CASE WHEN p_size % 2 = 0 THEN 'domain,function' ELSE 'function,pathway' END
      AS labels, count(*) AS n FROM part GROUP BY ALL""",
)
def entry_type_sets(spark, sf_dir):
    """Sets of comment types, from each entry's own list."""
    labels = F.array_join(F.sort_array(F.array_distinct(F.col("comment._type"))), ",")
    return profile.count_by(entries(spark, sf_dir).select(labels.alias("labels")), "labels")


@query(
    "entry_contains",
    """SELECT count(*) FILTER (WHERE p_size % 2 = 0 AND p_size % 3 = 0) AS n FROM part""",
)
def entry_contains(spark, sf_dir):
    """Entries with a given struct in their list."""
    comments = F.col("comment")
    found = F.exists(comments, lambda c: (c["_type"] == "domain") & c["text"].isNotNull())
    alike = F.array_contains(F.col("comment._type"), "domain")
    return entries(spark, sf_dir).agg(F.count_if(found & alike).alias("n"))


@query(
    "entry_coverage",
    """WITH f AS (SELECT p_partkey, 1 AS b, p_size AS e FROM part UNION ALL
      SELECT p_partkey, p_partkey % 40, p_partkey % 40 + 5 FROM part),
    p AS (SELECT DISTINCT p_partkey, unnest(generate_series(b, e)) AS pos FROM f),
    c AS (SELECT p_partkey, count(*) AS covered FROM p GROUP BY ALL)
    SELECT 'P' || p_partkey AS id, covered, CAST(ceil(100.0 * covered / 60) AS BIGINT) AS pct
    FROM c""",
)
def entry_coverage(spark, sf_dir):
    """Positions of an entry that any of its features covers."""
    df = entries(spark, sf_dir).select(
        F.col("accession")[0].alias("id"), F.explode("feature").alias("f")
    )
    df = df.select("id", "f.begin", "f.end")
    covered = profile.interval_coverage(df, ["id"], "begin", "end")
    return covered.withColumn("pct", F.ceil(F.lit(100.0) * F.col("covered") / 60))


@query(
    "entry_shared_accessions",
    """WITH a AS (SELECT p_type, 'P' || p_partkey AS acc FROM part UNION ALL
      SELECT p_type, 'Q' || (p_partkey % 97) FROM part WHERE p_size % 5 = 0),
    m AS (SELECT acc FROM a GROUP BY acc HAVING count(DISTINCT p_type) > 1)
    SELECT p_type AS name, count(*) AS n FROM a WHERE acc IN (SELECT acc FROM m) GROUP BY ALL""",
)
def entry_shared_accessions(spark, sf_dir):
    """Rows of accessions that stand for more than one name."""
    df = entries(spark, sf_dir).select("name", F.explode("accession").alias("acc"))
    shared = profile.ambiguous_keys(df, "acc", "name").select("acc")
    return profile.count_by(keys_in(df, shared, ["acc"]), "name")


@query(
    "profile_suppliers",
    """SELECT s_nationkey, count(*) AS n, count(DISTINCT s_suppkey) AS n_suppliers,
      round(sum(s_acctbal), 2) AS balance FROM supplier GROUP BY ALL
    ORDER BY n DESC, s_nationkey LIMIT 10""",
)
def profile_suppliers(spark, sf_dir):
    """Top groups of a grouped count, ties by key."""
    return (
        table(spark, sf_dir, "supplier")
        .groupBy("s_nationkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("s_suppkey").alias("n_suppliers"),
            F.round(F.sum("s_acctbal"), 2).alias("balance"),
        )
        .orderBy(F.col("n").desc(), "s_nationkey")
        .limit(10)
    )
