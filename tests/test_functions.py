import hashlib
import json
import math
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions import jsonrules, text
from assayer.functions.jsonrules import first_violation
from assayer.functions.lookup import weight_of
from assayer.functions.numeric import clip, p_value_score, rescale
from assayer.operators import checks


def values(spark, *columns):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


@pytest.mark.parametrize(
    "value, current, new, expected",
    [
        (15, (10, 20), (0, 1), 0.5),
        (0.25, (0, 1), (2, 4), 2.5),
        (-3, (0, 1), (2, 4), 2.0),
        (9, (0, 1), (2, 4), 4.0),
        (0.3, (0.0, 0.9), (0.5, 1.0), 0.5 + 0.5 / 3),
    ],
)
def test_rescale(spark, value, current, new, expected):
    assert values(spark, rescale(F.lit(value), current, new))[0] == pytest.approx(expected, 1e-12)


@pytest.mark.parametrize("current, new", [((1, 0), (0, 1)), ((1, 1), (0, 1)), ((0, 1), (3, 2))])
def test_rescale_rejects_bad_ranges(spark, current, new):
    with pytest.raises(ValueError):
        rescale(F.lit(1), current, new)


def test_clip_keeps_null_and_nan(spark):
    low, high, null, nan = values(
        spark,
        clip(F.lit(-5.0), (0, 1)),
        clip(F.lit(5.0), (0, 1)),
        clip(F.lit(None).cast("double"), (0, 1)),
        clip(F.lit(float("nan")), (0, 1)),
    )
    assert (low, high, null) == (0.0, 1.0, None)
    assert math.isnan(nan)


@pytest.mark.parametrize(
    "p, rng, expected",
    [
        (1.0, (1e-10, 1.0), 0.0),
        (20.0, (1e-10, 1.0), 0.0),
        (1e-10, (1e-10, 1.0), 1.0),
        (1e-40, (1e-10, 1.0), 1.0),
        (0.0, (1e-10, 1.0), 1.0),
        (1e-5, (1e-10, 1.0), 0.5),
        (1e-3, (1e-6, 1e-2), 0.25),
        (-0.1, (1e-10, 1.0), None),
        (float("nan"), (1e-10, 1.0), None),
        (None, (1e-10, 1.0), None),
    ],
)
def test_p_value_score(spark, p, rng, expected):
    found = values(spark, p_value_score(F.lit(p).cast("double"), rng))[0]
    assert found == (expected if expected is None else pytest.approx(expected, abs=1e-12))


def test_url_functions(spark):
    assert values(
        spark,
        text.url_basename(F.lit("http://a.b/c/D_1")),
        text.url_basename(F.lit("plain")),
        text.url_basename(F.lit("http://a.b/c/")),
        text.url_basename(F.lit(None).cast("string")),
        text.url_part(F.lit("http://a.b/c/D_1"), 3),
        text.url_part(F.lit("http://a.b"), 7),
    ) == ["D_1", "plain", "", None, "c", None]


def test_evidence_codes(spark):
    urls = F.array(
        F.lit("http://identifiers.org/eco/ECO:0000179"),
        F.lit("http://purl.obolibrary.org/obo/ECO:7"),
        F.lit("bare"),
    )
    assert values(spark, text.evidence_codes(urls))[0] == ["ECO_0000179", "ECO:7", "bare"]


GOOD_DATES = [
    "1987-01-31",
    "2003-07-08t23:59",
    "2003-07-08T23:59:00z",
    "1999-12-01T06:07:08.9-03:30",
    "2024-02-09-11:00",
    "2016-06-15T20:20:20.123456789+05:45[Asia/Kathmandu]",
]
BAD_DATES = [
    "1987-13-01",
    "1987-00-31",
    "2003-07-32",
    "2003-07-08T24:00",
    "2003-07-08T23:60",
    "2003-W27-2",
    "2003-189",
    "03-07-08",
    "1999-12-01T06:07:08+0330",
    "1999-12-01T06:07,5",
    " 1987-01-31",
    "",
]


@pytest.mark.parametrize("date, valid", [(d, True) for d in GOOD_DATES] + [(d, False) for d in BAD_DATES])
def test_iso_datetime(spark, date, valid):
    assert values(spark, text.is_iso_datetime(F.lit(date)))[0] is valid


def test_uri(spark):
    assert values(spark, *[text.is_nonblank_uri(F.lit(u)) for u in ("http://x", "x", "", " \t")]) == [
        True, True, False, False,
    ]


def test_record_id_depends_on_present_fields_only(spark):
    schema = "sourceID string, unique_association_fields struct<zz:string,a:string,datasource:string>"
    rows = [("s", ("1", None, "x")), ("s", ("1", None, "other")), ("t", ("1", None, "x"))]
    df = text.add_record_id(spark.createDataFrame(rows, schema))
    ids = [r.id for r in df.collect()]
    assert ids[0] == ids[1] != ids[2]
    assert df.select(F.to_json("unique_association_fields").alias("j")).first().j == (
        '{"datasource":"s","zz":"1"}'
    )


def test_weight_of(spark):
    assert values(spark, *[weight_of(F.lit(s), {"a": 0.2}) for s in ("a", "b")]) == [0.2, 1.0]


SCHEMA = {
    "type": "object",
    "required": ["a"],
    "properties": {
        "a": {"type": ["integer", "null"], "minimum": 1, "exclusiveMinimum": True, "maximum": 9},
        "b": {"enum": ["x", 2, True]},
        "c": {"type": "array", "minItems": 1, "items": {"$ref": "#/definitions/code"}},
        "d": {"oneOf": [{"type": "string"}, {"type": "number", "maximum": 5}, {"enum": [3]}]},
        "e": {"anyOf": [{"type": "string", "maxLength": 2}, {"type": "boolean"}]},
        "f": {"type": "object", "properties": {"g": {"type": "number"}}, "additionalProperties": False},
    },
    "definitions": {"code": {"type": "string", "pattern": "^C", "minLength": 2}},
}


@pytest.mark.parametrize(
    "record, pointer, keyword",
    [
        ('{"a": 2}', None, None),
        ('{"a": null}', None, None),
        ('{"b": "x"}', "#/a", "required"),
        ('{"a": 1}', "#/a", "minimum"),
        ('{"a": 10}', "#/a", "maximum"),
        ('{"a": 2.5}', "#/a", "type"),
        ('{"a": "2"}', "#/a", "type"),
        ('{"a": 2, "b": 2}', None, None),
        ('{"a": 2, "b": true}', None, None),
        ('{"a": 2, "b": "y"}', "#/b", "enum"),
        ('{"a": 2, "c": ["C1", "C2"]}', None, None),
        ('{"a": 2, "c": []}', "#/c", "minItems"),
        ('{"a": 2, "c": ["C1", "D2"]}', "#/c", "items"),
        ('{"a": 2, "c": ["C1", 5]}', "#/c", "items"),
        ('{"a": 2, "c": "C1"}', "#/c", "type"),
        ('{"a": 2, "d": 4}', None, None),
        ('{"a": 2, "d": 3}', "#/d", "oneOf"),
        ('{"a": 2, "d": false}', "#/d", "oneOf"),
        ('{"a": 2, "e": "ok"}', None, None),
        ('{"a": 2, "e": "long"}', "#/e", "anyOf"),
        ('{"a": 2, "f": {"g": 1.5}}', None, None),
        ('{"a": 2, "f": {"h": 1}}', "#/f", "additionalProperties"),
        ('{"a": 2, "f": {"g": "1"}}', "#/f/g", "type"),
        ('{"a": 2, "f": 3}', "#/f", "type"),
        ("[1]", "#", "type"),
    ],
)
def test_schema_rules(spark, record, pointer, keyword):
    df = spark.createDataFrame([(record,)], "value string")
    df = df.select(F.try_parse_json("value").alias("v"))
    found = df.select(first_violation(SCHEMA, F.col("v")).alias("m")).first().m
    expected = None if pointer is None else f'{{"pointer": "{pointer}", "keyword": "{keyword}"}}'
    assert found == expected


def test_unsupported_schema_keyword(spark):
    with pytest.raises(ValueError, match="unsupported"):
        first_violation({"unevaluatedProperties": False}, F.col("v"))


KEYWORD_CASES = [
    ({"const": 2}, ["2", "2.0"], ["3", '"2"', "null"]),
    ({"const": {"b": 1, "a": [True]}}, ['{"a": [true], "b": 1}'], ['{"a": [true]}']),
    ({"not": {"type": "string"}}, ["1", "{}"], ['"x"']),
    ({"maxItems": 1}, ["[]", "[1]", '"text"', "{}"], ["[1, 2]"]),
    ({"uniqueItems": True}, ["[1, 2]", '["1", 1]', "[]"], ["[1, 2, 1]", '[{"a": 1, "b": 2}, {"b": 2, "a": 1}]']),
    ({"contains": {"const": 1}}, ["[0, 1]", '"x"'], ["[]", "[2]"]),
    ({"minProperties": 1, "maxProperties": 2}, ['{"a": 1}', "[]"], ["{}", '{"a": 1, "b": 1, "c": 1}']),
    ({"multipleOf": 0.1}, ["0.3", "7", '"x"'], ["0.35"]),
    ({"exclusiveMinimum": 1, "exclusiveMaximum": 3}, ["2"], ["1", "3"]),
    ({"minimum": 1, "exclusiveMinimum": False}, ["1"], ["0"]),
    ({"patternProperties": {"^n_": {"type": "number"}}}, ['{"n_a": 1, "b": "x"}', "3"], ['{"n_a": "x"}']),
    (
        {"properties": {"a": {}}, "patternProperties": {"^n_": {}}, "additionalProperties": {"type": "string"}},
        ['{"a": 1, "n_b": 2, "c": "x"}', "[]"],
        ['{"c": 1}'],
    ),
    ({"patternProperties": {"^n_": {}}, "additionalProperties": False}, ['{"n_b": 2}'], ['{"c": 1}']),
    ({"propertyNames": {"pattern": "^[a-z]+$"}}, ['{"ab": 1}', "1"], ['{"A": 1}']),
    ({"dependencies": {"a": ["b"]}}, ['{"a": 1, "b": 1}', '{"c": 1}'], ['{"a": 1}']),
    ({"dependentSchemas": {"a": {"required": ["b"]}}}, ['{"b": 1}'], ['{"a": 1}']),
    ({"if": {"type": "number"}, "then": {"minimum": 5}, "else": {"minLength": 2}}, ["5", '"ab"'], ["4", '"a"']),
    ({"items": [{"type": "string"}, {"type": "number"}], "additionalItems": False}, ['["a", 1]', '["a"]'], ["[1]", '["a", 1, 2]']),
    ({"prefixItems": [{"type": "string"}], "items": {"type": "number"}}, ['["a", 1]', "[]", '["a"]'], ['["a", "b"]']),
    ({"properties": {"a": False, "b": True}}, ['{"b": 1}', "{}"], ['{"a": 1}']),
    ({"properties": {"id": {"$ref": "#/$defs/a~1b"}}, "$defs": {"a/b": {"type": "string"}}}, ['{"id": "x"}'], ['{"id": 1}']),
]
TREE = {
    "properties": {"name": {"type": "string"}, "id": {"type": "integer"}, "more": {"items": {"$ref": "#"}}},
    "additionalProperties": {"allOf": [{"$ref": "#/definitions/pair"}]},
    "definitions": {
        "pair": {
            "required": ["left"],
            "properties": {"left": {"type": ["number", "object"]}, "tree": {"$ref": "#"}},
            "patternProperties": {"^p": {"$ref": "#/definitions/pair"}},
        }
    },
}
KEYWORD_CASES.append(
    (
        TREE,
        ['{"name": "a", "more": [{"name": "b", "more": [{"more": []}, {}]}]}', '{"x": {"left": 1, "tree": {"id": 1}}}'],
        [
            '{"more": [{"name": "b", "more": [{}, {"more": [{"name": 1}]}]}]}',
            '{"x": {"left": 1, "tree": {"id": "1"}}}',
            '{"x": {"left": 1, "p1": {"left": 2, "p2": {"right": 3}}}}',
            '{"more": [1, [{"more": 1}], {"more": [[], {"y": {}}]}]}',
        ],
    )
)


@pytest.mark.parametrize("schema, good, bad", KEYWORD_CASES)
def test_schema_keywords(spark, schema, good, bad):
    df = spark.createDataFrame([(t, t in good) for t in [*good, *bad]], "value string, good boolean")
    message = first_violation(schema, F.try_parse_json("value")).isNull()
    assert [r.value for r in df.filter(message != F.col("good")).collect()] == []


def test_recursion_below_a_choice_is_refused():
    schema = {"anyOf": [{"type": "string"}, {"items": {"$ref": "#"}}]}
    with pytest.raises(ValueError, match="recursion below anyOf"):
        first_violation(schema, F.col("v"))


RULES = {
    "type": "object",
    "required": ["type", "target", "evidence"],
    "properties": {
        "type": {"type": "string", "enum": ["a", "b\"c", 5]},
        "no": False,
        "target": {"type": "object", "required": ["id"], "properties": {"id": {"type": "string", "minLength": 2}}},
        "evidence": {
            "type": "object",
            "properties": {
                "codes": {"type": "array", "items": {"type": "string"}},
                "date": {"type": "string", "format": "date-time"},
                "score": {"type": "object", "properties": {"value": {"type": ["number", "null"], "minimum": 0}}},
            },
        },
    },
}
DOCUMENTS = [
    "", "null", "5", "[]", "{}", "{", '{"a":1,"a":2}', '{"type":"a"}',
    *[
        '{"sourceID":"s\\u00e9\\n","disease":{"id":%s},"type":%s,"target":%s,"evidence":%s}' % (disease, kind, target, evidence)
        for disease in ('"d"', "5", "null")
        for kind in ('"a"', '"b\\"c"', '"d"', "5", "null", '""', '"\\\\"')
        for target in ('{"id":"xy"}', '{"id":"x"}', '{"id":7}', "{}", "null", '"t"', "[]", '{"ID":"xy"}')
        for evidence in (
            "{}", "null", "[]", '{"codes":["a"]}', '{"codes":["a",1]}', '{"codes":"a"}', '{"date":"2019-10-30"}',
            '{"date":"no"}', '{"date":null}', '{"score":null}', '{"score":{"value":-1}}', '{"score":{"value":null}}',
            '{"score":{"value":"1"}}', '{"score":{"value":1.5}}',
        )
    ],
    '{"sourceID":"s","disease":{"id":"d"},"type":"a","target":{"id":"xy"},"evidence":{},"no":1}',
]


def test_outline_tells_what_all_rules_tell(spark):
    df = spark.createDataFrame([(t,) for t in DOCUMENTS], "value string")
    parsed = df.select("value", F.try_parse_json("value").alias("parsed"))
    for schema in (None, RULES, {**RULES, "minProperties": 4}, {"properties": {"target": True, "type": {"const": "a"}}}):
        at_once = F.transform(F.array("parsed"), partial(jsonrules.findings, schema))
        each = F.struct(
            jsonrules.is_object(F.col("parsed")).alias("is_object"),
            *[
                F.when(F.schema_of_variant(F.try_variant_get("parsed", path, "variant")) == "STRING",
                       F.try_variant_get("parsed", path, "string")).alias(name)
                for name, path, _ in jsonrules.REQUIRED_STRINGS
            ],
            (F.lit(None) if schema is None else jsonrules.first_violation(schema, F.col("parsed"))).alias("violation"),
        )
        for text, a, b in parsed.select("value", at_once[0], each).collect():
            assert a == b, (schema, text)


def test_parsed_text_stays_in_the_generator(spark, plan):
    checked = checks.classify_lines(spark.createDataFrame([("{}",)], "value string"), RULES)
    assert "variant" not in str(checked._jdf.queryExecution().optimizedPlan().output())
    assert "parsed#" not in plan(checked)


def test_lines_are_told_by_compiled_steps_as_by_all_rules(spark, plan):
    lines = spark.createDataFrame([(t,) for t in DOCUMENTS], "value string")
    schemas = (None, RULES, {**RULES, "minProperties": 4})
    for schema in schemas:
        found = F.transform(F.array(F.try_parse_json("value")), partial(jsonrules.findings, schema))
        each = {r.value: r for r in lines.select("value", F.inline(found)).collect()}
        for row in checks.classify_lines(lines, schema).collect():
            told, reason = each[row.value], None
            if not told.is_object:
                reason = jsonrules.CORRUPT
            elif told.violation is not None:
                reason = jsonrules.NONCOMPLIANT
            missing = [m for name, _, m in jsonrules.REQUIRED_STRINGS if told[name] is None]
            if told.is_object and missing:
                reason = missing[0]
            assert (row.reason, row.is_valid) == (reason, reason is None), (schema, row.value)
            assert [row[n] for n, _, _ in jsonrules.REQUIRED_STRINGS] == [told[n] for n, _, _ in jsonrules.REQUIRED_STRINGS]
            if reason == jsonrules.NONCOMPLIANT:
                assert row.error == told.violation
    # What is read of a text is no function of an array's element, which is interpreted.
    assert "inline(array(struct(at, try_variant_get(" in plan(checks.classify_lines(lines, RULES))


def test_id_counts_all_keys_whether_listed_or_not(spark, plan):
    maps = [
        {"b": "1", "a": "x\"y"}, {"b": "1", "zz": "2"}, {"b": None, "zz": "2"}, {"datasource": "old", "a": "1"},
        {"sourceID": "old", "b": "1"}, {}, None, {"b": None}, {"n": "07", "a": "\u00e9"},
    ]
    rows = [(i, source, m) for i, m in enumerate(maps) for source in ("s", None)]
    df = spark.createDataFrame(rows, "i int, sourceID string, unique_association_fields map<string,string>")
    kinds = {"datasource": T.StringType(), "b": T.StringType(), "a": T.StringType(), "n": T.IntegerType()}
    listed = text.add_record_id(df, listed=kinds)
    for row in listed.collect():
        own = {k: v for k, v in (maps[row.i] or {}).items() if v is not None and k not in ("sourceID", "datasource")}
        if row.sourceID is not None:
            own["sourceID"] = row.sourceID
        key = json.dumps(
            {"datasource" if k == "sourceID" else k: own[k] for k in sorted(own)}, ensure_ascii=False, separators=(",", ":")
        )
        assert row.id == hashlib.md5(key.encode()).hexdigest(), (maps[row.i], key)
        unique = row.unique_association_fields
        assert unique.datasource == row.sourceID and unique.n == (7 if "n" in own else None)
    assert "id:texts" in plan(listed)


def test_lists_and_objects_are_told_by_compiled_steps(spark):
    string, number = {"type": "string"}, {"type": "number", "minimum": 0, "exclusiveMaximum": 9}
    schema = {
        "type": "object",
        "properties": {
            "codes": {"type": "array", "items": string},
            "score": {"$ref": "#/definitions/score"},
            "size": {"type": "integer"},
        },
        "definitions": {"score": {"type": "object", "properties": {"value": number, "flag": {"type": "boolean"}}}},
    }
    outline = jsonrules.Outline(schema)
    df = spark.range(1).select(outline.read(F.try_parse_json(F.lit("{}"))).alias("at"))
    strings = {pointer: F.lit(None).cast("string") for pointer in outline.strings()}
    _, rest = outline.signs(F.col("at"), strings)
    # No rule is left to functions of an array's element, which are interpreted.
    assert df.select(rest.alias("rest")).first().rest is True and "exists" not in str(rest)
    codes = ["[]", '["a"]', '["a", null]', '["null"]', '["a", 1]', "[1]", "[null]", '"a"', "null", "{}", '[["a"]]']
    scores = ["{}", '{"value": 1}', '{"value": -1}', '{"value": 9}', '{"value": "1"}', '{"value": null}',
              '{"flag": true, "value": 1e0}', '{"flag": 1}', "[]", "5", "null", '{"other": "x"}']
    sizes = ["1", "1.5", "1e2", '"1"', "null"]
    found = [("codes", v) for v in codes] + [("score", v) for v in scores] + [("size", v) for v in sizes]
    base = '{"sourceID": "s", "type": "t", "target": {"id": "x"}, "disease": {"id": "y"}, '
    texts = [(f'{base}"{name}": {value}}}',) for name, value in found]
    lines = spark.createDataFrame(texts, "value string")
    told = {r.value: r.error for r in checks.classify_lines(lines, schema).collect()}
    every = lines.select("value", first_violation(schema, F.try_parse_json("value")).alias("error"))
    assert told == {r.value: r.error for r in every.collect()}
    assert sum(error is None for error in told.values()) == 9
