"""Sources and sinks: what is written is what is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.operators import profile
from assayer.operators.entries import entry_report
from assayer.session import scratch_path
from assayer.sources import readers, schemas, writers
from catalog.registry import query
from catalog.views import CODE_PREFIX, table, text


def path(spark, name):
    return scratch_path(spark, name)


@query("text_source", "SELECT CAST(event_id AS VARCHAR) || ' ' || props AS value FROM events")
def text_source(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select(text(F.col("event_id"), " ", F.col("props")))
    out = path(spark, "lines")
    writers.save(lines.toDF("value"), out, fmt="text")
    return readers.read_lines(spark, out)


@query(
    "json_roundtrip",
    """SELECT 'G' || s_suppkey AS id, s_name AS approved_symbol,
      CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'P' || s_suppkey END AS uniprot_id,
      'Q' || s_suppkey || ',R' || s_suppkey AS accessions FROM supplier""",
)
def json_roundtrip(spark, sf_dir):
    key = F.col("s_suppkey")
    genes = table(spark, sf_dir, "supplier").select(
        text("G", key).alias("id"),
        F.col("s_name").alias("approved_symbol"),
        F.when(key % 3 != 0, text("P", key)).alias("uniprot_id"),
        F.array(text("Q", key), text("R", key)).alias("uniprot_accessions"),
        F.lit("not in the schema").alias("surplus"),
    )
    out = path(spark, "genes")
    writers.save(genes, out, fmt="json")
    return readers.read_genes(spark, out).select(
        "id", "approved_symbol", "uniprot_id",
        F.array_join("uniprot_accessions", ",").alias("accessions"),
    )


@query(
    "json_diseases",
    """SELECT 'N' || n_nationkey AS id, 'R' || n_regionkey || '>N' || n_nationkey AS first_path
    FROM nation""",
)
def json_diseases(spark, sf_dir):
    node, region = text("N", F.col("n_nationkey")), text("R", F.col("n_regionkey"))
    diseases = table(spark, sf_dir, "nation").select(
        node.alias("id"), F.array(F.array(region, node), F.array(region)).alias("path_codes")
    )
    out = path(spark, "diseases")
    writers.save(diseases, out, fmt="json")
    first = F.array_join(F.get(F.col("path_codes"), F.lit(0)), ">")
    return readers.read_diseases(spark, out).select("id", first.alias("first_path"))


@query(
    "json_single_gzip",
    "SELECT n_nationkey, n_name FROM nation",
)
def json_single_gzip(spark, sf_dir):
    out = path(spark, "nations")
    writers.save_single_json(table(spark, sf_dir, "nation"), out)
    return readers.read_json(spark, out, "n_nationkey INT, n_name STRING")


@query(
    "rows_as_json",
    """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"'
      || CASE WHEN n_nationkey % 2 = 0 THEN ',"even":true' ELSE '' END || '}' AS value
    FROM nation""",
)
def rows_as_json(spark, sf_dir):
    df = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return readers.rows_as_json(
        df.withColumn("even", F.when(F.col("n_nationkey") % 2 == 0, F.lit(True)))
    )


@query(
    "drop_empty_fields",
    "SELECT o_orderkey, o_orderstatus FROM orders",
)
def drop_empty_fields(spark, sf_dir):
    """A field that is NULL in every row is gone after the pass through JSON."""
    df = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    return readers.drop_empty_fields(df.withColumn("nothing", F.lit(None).cast("string")))


@query(
    "csv_roundtrip",
    """SELECT 'G' || (s_suppkey + 1) AS reference, 'G' || s_suppkey AS alternate
    FROM supplier""",
)
def csv_roundtrip(spark, sf_dir):
    key = F.col("s_suppkey")
    pairs = table(spark, sf_dir, "supplier").select(
        text("S", key).alias("gene_symbol"),
        text("G", key + 1).alias("reference"),
        text("G", key).alias("alternate"),
    )
    out = path(spark, "pairs")
    writers.save_single_csv(pairs, out)
    return readers.read_non_reference_genes(spark, out)


@query(
    "tsv_eco_scores",
    f"""SELECT '{CODE_PREFIX}SO_' || p_partkey AS uri, p_name AS code,
      p_size / 10.0 AS score FROM part""",
)
def tsv_eco_scores(spark, sf_dir):
    df = table(spark, sf_dir, "part").select(
        text(CODE_PREFIX + "SO_", F.col("p_partkey")).alias("uri"),
        F.col("p_name").alias("code"),
        (F.col("p_size") / 10.0).alias("score"),
    )
    out = path(spark, "eco")
    writers.save(df, out, fmt="csv", sep="\t", header="false")
    return readers.read_eco_scores(spark, out)


@query(
    "tsv_inferred",
    "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
)
def tsv_inferred(spark, sf_dir):
    df = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    out = path(spark, "customers")
    writers.save(df, out, fmt="csv", sep="\t", header="true")
    read = readers.read_delimited(spark, out, sep="\t")
    return read.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(
    "parquet_roundtrip",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_returnflag = 'R'""",
)
def parquet_roundtrip(spark, sf_dir):
    """Written by flag, so the filter reads one folder only."""
    df = table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag",
    )
    read = writers.save_and_read(df, path(spark, "items"), partition_by=("l_returnflag",))
    return read.filter(F.col("l_returnflag") == "R").drop("l_returnflag")


@query(
    "save_once",
    "SELECT o_orderkey, o_custkey FROM orders",
)
def save_once(spark, sf_dir):
    """A second write to the same place changes nothing."""
    out = path(spark, "once")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    writers.save_once(orders, out)
    return writers.save_once(orders.withColumn("o_custkey", F.col("o_custkey") + 1), out)


@query(
    "xml_source",
    """SELECT 'ENTRY' || p_partkey AS name, p_type AS organism,
      'P' || p_partkey || CASE WHEN p_size % 2 = 0 THEN ',Q' || p_partkey ELSE '' END
        AS accessions, p_size AS begin FROM part""",
)
def xml_source(spark, sf_dir):
    """Entries written as XML elements with attributes and lists."""
    key, size = F.col("p_partkey"), F.col("p_size")
    both = F.array(text("P", key), text("Q", key))
    df = readers.spread(table(spark, sf_dir, "part")).select(
        F.slice(both, 1, F.when(size % 2 == 0, 2).otherwise(1)).alias("accession"),
        text("ENTRY", key).alias("name"),
        F.struct(F.col("p_type").alias("_VALUE"), F.lit("scientific").alias("_type")).alias(
            "organism"
        ),
        F.struct(size.alias("_position")).alias("begin"),
    )
    out = path(spark, "entries")
    writers.save_xml(df, out, "entry", "entries")
    schema = """accession ARRAY<STRING>, name STRING,
      organism STRUCT<_VALUE: STRING, _type: STRING>, begin STRUCT<_position: INT>"""
    read = readers.read_xml(spark, out, "entry", schema)
    return read.select(
        "name",
        F.col("organism._VALUE").alias("organism"),
        F.array_join("accession", ",").alias("accessions"),
        F.col("begin._position").alias("begin"),
    )


@query(
    "xml_entry_report",
    """WITH c AS (
      SELECT p_partkey AS k, 'function' AS type, p_name AS t FROM part UNION ALL
      SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'domain' ELSE 'pathway' END,
        CASE WHEN p_size % 3 = 0 THEN p_brand END FROM part WHERE p_partkey % 6 <> 5),
    f AS (SELECT p_partkey AS k, 'chain' AS type, 1 AS b, p_size AS e FROM part UNION ALL
      SELECT p_partkey, 'site', 20 + p_partkey % 40, 20 + p_partkey % 40 FROM part WHERE p_size % 4 = 0),
    covered AS (SELECT k, count(DISTINCT pos) AS n FROM (
      SELECT k, unnest(generate_series(b, e)) AS pos FROM f) GROUP BY k),
    facts AS (
      SELECT 'entries' AS section, 'all' AS label, true AS filled FROM part
      UNION ALL SELECT 'accessions', CASE WHEN p_size % 5 = 0 THEN '2' ELSE '1' END, true FROM part
      UNION ALL SELECT DISTINCT ON (k, type) 'comment_type', type, true FROM c
      UNION ALL SELECT 'comment_text', type, t IS NOT NULL FROM c
      UNION ALL SELECT 'comment_types', string_agg(DISTINCT type, ',' ORDER BY type), true FROM c GROUP BY k
      UNION ALL SELECT 'feature_type', type, true FROM f
      UNION ALL SELECT 'coverage', CAST(CAST(ceil((100.0 * n / 60) / 10) * 10 AS BIGINT) AS VARCHAR), true FROM covered),
    g AS (SELECT section, label, count(*) AS n, count(*) FILTER (WHERE filled) AS m FROM facts GROUP BY ALL)
    SELECT section, label, n, round(n * 100.0 / (SELECT count(*) FROM part), 2)::DOUBLE AS pct_entries,
      CAST(ceil(m * 100.0 / n) AS BIGINT) AS pct_filled FROM g""",
)
def xml_entry_report(spark, sf_dir):
    """All sections of the profile of entries that come as XML files."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("bigint")

    def position(value):
        return F.struct(value.cast("bigint").alias("_position"))

    def comment(kind, body):
        said = F.when(body.isNotNull(), F.struct(body.alias("_VALUE"), F.lit("1").alias("_evidence")))
        return F.struct(kind.alias("_type"), said.alias("text"))

    def feature(kind, begin, end, at):
        none = F.lit(None).cast("struct<_position:bigint>")
        where = F.struct(*[(none if c is None else position(c)).alias(n) for n, c in (("begin", begin), ("end", end), ("position", at))])
        return F.struct(F.lit(kind).alias("_type"), F.lit("made").alias("_description"), where.alias("location"))

    second = F.when(size % 2 == 0, "domain").otherwise("pathway")
    comments = F.array(comment(F.lit("function"), F.col("p_name")), comment(second, F.when(size % 3 == 0, F.col("p_brand"))))
    features = F.array(feature("chain", F.lit(1), size, None), feature("site", None, None, 20 + key % 40))
    df = readers.spread(table(spark, sf_dir, "part")).select(
        F.slice(F.array(text("P", key), text("Q", key)), 1, F.when(size % 5 == 0, 2).otherwise(1)).alias("accession"),
        F.array(F.col("p_type")).alias("name"),
        F.slice(comments, 1, F.when(key % 6 == 5, 1).otherwise(2)).alias("comment"),
        F.slice(features, 1, F.when(size % 4 == 0, 2).otherwise(1)).alias("feature"),
        F.struct(F.lit("MKV").alias("_VALUE"), F.lit(60).cast("bigint").alias("_length")).alias("sequence"),
    )
    out = path(spark, "protein-entries")
    writers.save_xml(df, out, "entry", "entries")
    return entry_report(readers.read_xml(spark, out, "entry", schemas.ENTRY))


@query(
    "xml_inferred",
    "SELECT n_nationkey AS key, n_name AS name FROM nation",
)
def xml_inferred(spark, sf_dir):
    df = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("_key"), F.col("n_name").alias("name")
    )
    out = path(spark, "nations-xml")
    writers.save(df, out, fmt="xml", rowTag="nation", rootTag="nations")
    read = readers.read_xml(spark, out, "nation")
    return read.select(F.col("_key").cast("int").alias("key"), "name")


SUMMARIES_SQL = """
  SELECT 'target_id' AS step, o_orderpriority AS "sourceID", o_orderstatus AS reason,
    count(*) AS count FROM orders GROUP BY ALL
  UNION ALL SELECT 'disease_id', o_orderpriority,
    CASE WHEN o_orderstatus = 'F' THEN 'none' ELSE o_orderstatus END, count(*)
  FROM orders GROUP BY ALL"""


@query(
    "step_summaries",
    SUMMARIES_SQL,
)
def step_summaries(spark, sf_dir):
    """Tables of all steps in a folder read at once, then reported."""
    out = path(spark, "errors")
    orders = table(spark, sf_dir, "orders").withColumn("sourceID", F.col("o_orderpriority"))
    status = F.col("o_orderstatus")
    reasons = {"target_id": status, "disease_id": F.when(status != "F", status)}
    each = [F.struct(F.lit(s).alias("step"), r.alias("reason")) for s, r in reasons.items()]
    rows = orders.select("sourceID", F.explode(F.array(*each)).alias("c")).select("sourceID", "c.*")
    counts = rows.groupBy("step", "sourceID", "reason").count()
    writers.save(counts, readers.step_summaries_path(out), partition_by=("step",))
    return profile.error_report(readers.read_step_summaries(spark, out))


@query(
    "evidence_schema_scan",
    """SELECT doc_id, 'europepmc' AS source, md5(text) AS digest, length(text) AS n
    FROM documents""",
)
def evidence_schema_scan(spark, sf_dir):
    """Whole texts through JSON lines and the full evidence schema."""
    sentence = F.struct(F.col("text"))
    df = table(spark, sf_dir, "documents").select(
        F.lit("europepmc").alias("sourceID"),
        F.struct(F.col("doc_id").cast("string").alias("id")).alias("target"),
        F.struct(
            F.struct(F.array(sentence).alias("mined_sentences")).alias("literature_ref")
        ).alias("evidence"),
    )
    out = path(spark, "texts")
    writers.save(readers.rows_as_json(df), out, fmt="text")
    parsed = readers.parse_json(readers.read_lines(spark, out), schemas.EVIDENCE)
    text_ = F.get(F.col("evidence.literature_ref.mined_sentences"), F.lit(0))["text"]
    return parsed.select(
        F.col("target.id").cast("bigint").alias("doc_id"),
        F.col("sourceID").alias("source"),
        F.md5(text_.cast("binary")).alias("digest"),
        F.length(text_).cast("bigint").alias("n"),
    )
