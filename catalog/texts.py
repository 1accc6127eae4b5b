"""Identifier, URL, date and JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.functions import text as fn
from assayer.functions.jsonrules import first_violation
from assayer.operators import checks
from assayer.plans import jobs
from assayer.sources.readers import infer_json_type, parse_json
from catalog.registry import query
from catalog.views import (
    CODE_PREFIX,
    ECO_PREFIX,
    RECORD_SCHEMA,
    RECORDS_SQL,
    record_lines,
    records,
    rounded,
    table,
    text,
)


@query(
    "url_basename",
    """SELECT page_id, string_split(url, '/')[-1] AS base,
      string_split(url || '/', '/')[-1] AS trailing, 'page' || page_id AS no_slash FROM pages""",
)
def url_basename(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages", "page_id", "url").select(
        "page_id",
        fn.url_basename(url).alias("base"),
        fn.url_basename(text(url, "/")).alias("trailing"),
        fn.url_basename(text("page", F.col("page_id"))).alias("no_slash"),
    )


@query(
    "url_parts",
    """SELECT page_id, string_split(url, '/')[3] AS domain, string_split(url, '/')[4] AS dir,
      string_split(url, '/')[5] AS id FROM pages""",
)
def url_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages", "page_id", "url").select(
        "page_id",
        fn.url_part(url, 2).alias("domain"),
        fn.url_part(url, 3).alias("dir"),
        fn.url_part(url, 4).alias("id"),
    )


@query(
    "url_domain_counts",
    """SELECT string_split(url, '/')[3] AS domain, string_split(url, '/')[4] AS dir,
      count(*) AS n FROM pages GROUP BY ALL""",
)
def url_domain_counts(spark, sf_dir):
    url = F.col("url")
    return (
        table(spark, sf_dir, "pages", "url")
        .groupBy(fn.url_part(url, 2).alias("domain"), fn.url_part(url, 3).alias("dir"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "disease_code",
    """SELECT o_orderkey, 'EFO_' || o_custkey AS code FROM orders""",
)
def disease_code(spark, sf_dir):
    url = text("http://www.ebi.ac.uk/efo/EFO_", F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.disease_code(url).alias("code"))


@query(
    "evidence_codes",
    f"""WITH urls AS (
      SELECT l_orderkey, l_linenumber, l_partkey,
        [CASE WHEN l_linenumber % 2 = 0 THEN '{ECO_PREFIX}ECO:' ELSE '{CODE_PREFIX}ECO:' END
           || l_partkey, '{CODE_PREFIX}SO_' || l_suppkey] AS urls FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(list_transform(urls, lambda u:
      CASE WHEN u LIKE '%/identifiers.org/eco/%'
        THEN replace(string_split(u, '/')[-1], 'ECO:', 'ECO_')
        ELSE string_split(u, '/')[-1] END), ',') AS codes FROM urls""",
)
def evidence_codes(spark, sf_dir):
    prefix = F.when(F.col("l_linenumber") % 2 == 0, ECO_PREFIX).otherwise(CODE_PREFIX)
    urls = F.array(
        text(prefix, "ECO:", F.col("l_partkey")), text(CODE_PREFIX + "SO_", F.col("l_suppkey"))
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.array_join(fn.evidence_codes(urls), ",").alias("codes"),
    )


@query(
    "record_id",
    """WITH j AS (
      SELECT p_partkey, p_name, '{"brand":"' || p_brand || '"'
        || CASE WHEN p_size % 2 = 0 THEN ',"name":"' || p_name || '"' ELSE '' END
        || ',"datasource":"' || p_type || '","study":"' || p_partkey || '"}' AS fields FROM part)
    SELECT p_partkey, fields, md5(fields) AS id FROM j""",
)
def record_id(spark, sf_dir):
    """Fields in code point order, NULL left out, the source under its own name's place."""
    fields = F.struct(
        F.col("p_partkey").cast("string").alias("study"),
        F.lit("old").alias("datasource"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("name"),
        F.col("p_brand").alias("brand"),
    )
    df = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("sourceID"), fields.alias("unique_association_fields")
    )
    return fn.add_record_id(df).select(
        "p_partkey", F.to_json("unique_association_fields").alias("fields"), "id"
    )


@query(
    "record_id_evidence",
    f"""WITH {RECORDS_SQL}
    SELECT l_orderkey || '-' || l_linenumber AS target_name, id FROM identified""",
)
def record_id_evidence(spark, sf_dir):
    return records(spark, sf_dir).select("target.target_name", "id")


DATE_VARIANTS = """CASE event_id % 8 WHEN 0 THEN d WHEN 1 THEN d || 'T' || t
    WHEN 2 THEN d || 'T' || t || 'Z' WHEN 3 THEN d || 'T' || t || '.123+02:00'
    WHEN 4 THEN d || ' ' || t WHEN 5 THEN d || 'T' WHEN 6 THEN substr(d || 'T' || t, 1, 18)
    ELSE replace(d, '-', '/') END"""


@query(
    "iso_datetime_valid",
    f"""WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS d,
        strftime(ts, '%H:%M:%S') AS t FROM events), v AS (
      SELECT event_id, {DATE_VARIANTS} AS written FROM e)
    SELECT event_id, written, event_id % 8 IN (0, 1, 2, 3) AS valid FROM v""",
)
def iso_datetime_valid(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("d"),
        F.date_format("ts", "HH:mm:ss").alias("t"),
    )
    df = df.select("event_id", F.expr(DATE_VARIANTS).alias("written"))
    return df.select("event_id", "written", fn.is_iso_datetime(F.col("written")).alias("valid"))


@query(
    "uri_valid",
    "SELECT page_id, page_id % 3 = 0 AS valid FROM pages",
)
def uri_valid(spark, sf_dir):
    uri = (
        F.when(F.col("page_id") % 3 == 0, F.col("url"))
        .when(F.col("page_id") % 3 == 1, " \t")
        .otherwise("")
    )
    return table(spark, sf_dir, "pages").select("page_id", fn.is_nonblank_uri(uri).alias("valid"))


@query(
    "json_validate",
    f"""WITH {RECORDS_SQL}
    SELECT schema_reason AS reason, schema_reason IS NULL AS is_valid,
      CASE WHEN fault IN (0, 1) THEN NULL ELSE source_id END AS source_id,
      CASE WHEN fault IN (0, 2) THEN NULL ELSE raw_type END AS data_type,
      CASE WHEN fault IN (0, 3) THEN NULL ELSE target_url END AS target_id,
      CASE WHEN fault IN (0, 4) THEN NULL ELSE disease_url END AS disease_id,
      CASE fault WHEN 0 THEN 'the text is not a JSON object'
        WHEN 5 THEN '{{"pointer": "#/evidence/date_asserted", "keyword": "format"}}'
        END AS error
    FROM reasoned""",
)
def json_validate(spark, sf_dir):
    return checks.classify_lines(record_lines(spark, sf_dir), RECORD_SCHEMA).drop("value")


@query(
    "json_validate_summary",
    f"""WITH {RECORDS_SQL}
    SELECT CASE WHEN fault IN (0, 1) THEN NULL ELSE source_id END AS "sourceID",
      schema_reason AS reason, count(*) AS count FROM reasoned GROUP BY ALL""",
)
def json_validate_summary(spark, sf_dir):
    checked = checks.classify_lines(record_lines(spark, sf_dir), RECORD_SCHEMA)
    return checks.reason_counts(checked, "source_id")


PROPS_SCHEMA = {
    "type": "object",
    "required": ["k"],
    "properties": {"k": {"type": "integer", "minimum": 20, "maximum": 80}},
    "additionalProperties": False,
}


@query(
    "json_schema_rules",
    """WITH p AS (SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events)
    SELECT event_id, CASE WHEN event_id % 5 = 0
        THEN '{"pointer": "#/k", "keyword": "type"}'
      WHEN event_id % 7 = 0 THEN '{"pointer": "#", "keyword": "additionalProperties"}'
      WHEN k < 20 THEN '{"pointer": "#/k", "keyword": "minimum"}'
      WHEN k > 80 THEN '{"pointer": "#/k", "keyword": "maximum"}' END AS violation
    FROM p WHERE NOT (event_id % 7 = 0 AND (k < 20 OR k > 80) AND event_id % 5 <> 0)
    UNION ALL
    SELECT event_id, CASE WHEN k < 20 THEN '{"pointer": "#/k", "keyword": "minimum"}'
      ELSE '{"pointer": "#/k", "keyword": "maximum"}' END AS violation
    FROM p WHERE event_id % 7 = 0 AND (k < 20 OR k > 80) AND event_id % 5 <> 0""",
)
def json_schema_rules(spark, sf_dir):
    """The properties of every event against a schema, some texts made to break it."""
    key = F.col("event_id")
    props = (
        F.when(key % 5 == 0, F.regexp_replace("props", r'"k": (\d+)', '"k": "$1"'))
        .when(key % 7 == 0, F.regexp_replace("props", r"\}$", ', "extra": 1}'))
        .otherwise(F.col("props"))
    )
    df = table(spark, sf_dir, "events", "event_id", "props")
    df = df.select("event_id", F.try_parse_json(props).alias("parsed"))
    violation = first_violation(PROPS_SCHEMA, F.col("parsed"))
    return df.select("event_id", violation.alias("violation"))


TREE_SCHEMA = {
    "properties": {
        "kind": {"const": "event"},
        "k": {"not": {"multipleOf": 10}},
        "tags": {"maxItems": 3, "uniqueItems": True},
        "child": {"$ref": "#/definitions/node"},
    },
    "patternProperties": {"^x_": {"type": "string"}},
    "additionalProperties": {"type": "string"},
    "definitions": {
        "node": {
            "type": "object",
            "properties": {"n": {"maximum": 4}, "child": {"$ref": "#/definitions/node"}},
        }
    },
}


@query(
    "json_schema_keywords",
    """WITH p AS (SELECT event_id AS i, json_extract(props, '$.k')::BIGINT AS k FROM events)
    SELECT i AS event_id, CASE WHEN i % 11 = 0 THEN '{"pointer": "#/kind", "keyword": "const"}'
      WHEN k % 10 = 0 THEN '{"pointer": "#/k", "keyword": "not"}'
      WHEN i % 5 = 0 THEN '{"pointer": "#/tags", "keyword": "maxItems"}'
      WHEN i % 3 = 0 THEN '{"pointer": "#/tags", "keyword": "uniqueItems"}'
      WHEN i % 13 = 0 THEN '{"pointer": "#", "keyword": "patternProperties"}'
      WHEN i % 17 = 0 THEN '{"pointer": "#", "keyword": "additionalProperties"}'
      WHEN i % 7 > 4 OR i % 6 > 4 OR i % 8 > 4
        THEN '{"pointer": "#/definitions/node/n", "keyword": "maximum"}' END AS violation
    FROM p""",
)
def json_schema_keywords(spark, sf_dir):
    """Constants, negation, sets, patterns of names and a definition that refers to itself."""
    key = F.col("event_id")

    def when(divisor: int, yes: str, no: str):
        return F.when(key % divisor == 0, yes).otherwise(no)

    document = F.concat(
        F.lit('{"kind": "'), when(11, "other", "event"),
        F.lit('", "k": '), F.get_json_object("props", "$.k"),
        F.lit(', "tags": ["a"'), when(3, ', "a"', ', "b"'), when(5, ', "c", "d"', ""),
        F.lit('], "x_1": '), when(13, "5", '"5"'), F.lit(', "extra": '), when(17, "5", '"5"'),
        F.lit(', "child": {"n": '), key % 7, F.lit(', "child": {"n": '), key % 6,
        F.lit(', "child": {"n": '), key % 8, F.lit("}}}}"),
    )
    df = table(spark, sf_dir, "events", "event_id", "props")
    violation = first_violation(TREE_SCHEMA, F.try_parse_json(document))
    return df.select("event_id", violation.alias("violation"))


@query(
    "json_parse",
    f"""WITH {RECORDS_SQL}
    SELECT raw_type AS type, source_id, disease_url, CASE WHEN raw_type = 'known_drug'
        THEN l_linenumber % 2 END AS target2drug,
      CASE WHEN raw_type IN ('known_drug') THEN round(prob + 1e-9, 6) END AS drug2clinic,
      CASE WHEN raw_type = 'genetic_association' THEN 200 * q END AS sample_size
    FROM parsed""",
)
def json_parse(spark, sf_dir):
    paths = {
        "type": "type",
        "source_id": "sourceID",
        "disease_url": "disease.id",
        "target2drug": "evidence.target2drug.resource_score.value",
        "drug2clinic": "evidence.drug2clinic.resource_score.value",
        "sample_size": "evidence.variant2disease.gwas_sample_size",
    }
    df = records(spark, sf_dir, *paths.values())
    return rounded(df.select(*[F.col(path).alias(name) for name, path in paths.items()]))


@query(
    "json_infer",
    """SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice
    FROM orders""",
)
def json_infer(spark, sf_dir):
    """Texts parsed by the type found in all of them."""
    orders = table(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    parsed = parse_json(orders.select(F.to_json(F.struct("*")).alias("value")))
    return parsed.withColumn("o_totalprice", F.round("o_totalprice", 2))


@query(
    "json_infer_props",
    "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events",
)
def json_infer_props(spark, sf_dir):
    """A type found in a column of texts, used next to other columns."""
    events = table(spark, sf_dir, "events", "event_id", "props")
    kind = infer_json_type(events, "props")
    return events.select("event_id", F.from_json("props", kind)["k"].alias("k"))


@query(
    "string_predicates",
    """SELECT p_partkey, starts_with(p_name, 'small') AS starts, contains(p_name, 'ring') AS has,
      regexp_matches(p_brand, '^Brand#[0-9]$') AS matches, p_type LIKE 'ECO%' AS is_like,
      p_type IN ('ECONOMY', 'STANDARD') AS is_in, length(p_name) AS len
    FROM part""",
)
def string_predicates(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").startswith("small").alias("starts"),
        F.col("p_name").contains("ring").alias("has"),
        F.col("p_brand").rlike("^Brand#[0-9]$").alias("matches"),
        F.col("p_type").like("ECO%").alias("is_like"),
        F.col("p_type").isin("ECONOMY", "STANDARD").alias("is_in"),
        F.length("p_name").cast("bigint").alias("len"),
    )


@query(
    "record_id_open_fields",
    """SELECT md5('{"experiment":"e' || l_partkey || '","lab":"' || (l_linenumber % 3) ||
      '","datasource":"s' || (l_suppkey % 3) || '","target":"t' || (l_orderkey % 5) || '"}') AS id,
      count(*) AS n FROM lineitem GROUP BY 1""",
)
def record_id_open_fields(spark, sf_dir):
    """Records that differ in identifying fields which the schema does not list."""
    df = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    own = F.struct(
        F.concat(F.lit("t"), F.col("l_orderkey") % 5).alias("target"),
        (F.col("l_linenumber") % 3).cast("string").alias("lab"),
        F.lit(None).cast("string").alias("missing"),
        F.concat(F.lit("e"), F.col("l_partkey")).alias("experiment"),
    ).alias("unique_association_fields")
    source = F.concat(F.lit("s"), F.col("l_suppkey") % 3).alias("sourceID")
    lines = df.select(F.to_json(F.struct(source, own)).alias("value"))
    return jobs.parse_evidence(lines).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "record_id_typed_fields",
    """SELECT md5('{"lab":"' || (l_linenumber % 3) || '","pmid":"' || l_partkey ||
      '","datasource":"s' || (l_suppkey % 3) || '"}') AS id, l_partkey AS pmid, count(*) AS n
    FROM lineitem GROUP BY ALL""",
)
def record_id_typed_fields(spark, sf_dir):
    """The same with a schema in DDL that lists a number among the identifying fields."""
    df = table(spark, sf_dir, "lineitem", "l_linenumber", "l_partkey", "l_suppkey")
    own = F.struct(
        F.col("l_partkey").alias("pmid"), (F.col("l_linenumber") % 3).cast("string").alias("lab")
    ).alias("unique_association_fields")
    source = F.concat(F.lit("s"), F.col("l_suppkey") % 3).alias("sourceID")
    lines = df.select(F.to_json(F.struct(source, own)).alias("value"))
    found = jobs.parse_evidence(lines, "sourceID STRING, unique_association_fields STRUCT<pmid: BIGINT>")
    key = F.col("unique_association_fields.pmid").alias("pmid")
    return found.groupBy("id", key).agg(F.count(F.lit(1)).alias("n"))
