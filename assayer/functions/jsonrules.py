"""Validity of JSON texts, as column expressions.

A record is a JSON object with string values at four places and, if a schema is
given, conforms to it. The schema is a JSON-Schema document as a Python dict; its
keywords become predicates on the parsed text, so the check runs in the JVM and
nothing but the plan is shipped to executors.

A definition that refers to itself, directly or over others, is compiled once. The
values it applies to are found level by level: those in the document first, then
those that these refer to, for as many levels as the document can have.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.functions.text import is_iso_datetime, is_nonblank_uri

# --- fixed values: required strings and the reason if one is missing -------
REQUIRED_STRINGS = (
    ("source_id", "$.sourceID", "missing_data_source"),
    ("data_type", "$.type", "missing_data_type"),
    ("target_id", "$.target.id", "missing_target_id"),
    ("disease_id", "$.disease.id", "missing_disease_id"),
)
CORRUPT = "corrupt_json"
NONCOMPLIANT = "noncompliance_with_json_schema"

FORMATS = {"date-time": is_iso_datetime, "uri": is_nonblank_uri}

ANNOTATIONS = {
    "$schema", "$id", "$comment", "id", "title", "description", "default",
    "definitions", "$defs", "examples", "version", "readOnly", "writeOnly", "deprecated",
}

# Whether a rule is broken, and the text that says so.
Violation = tuple[Column, str | Column]


class Rules(dict):
    """A whole schema with the pointers to its recursive definitions."""

    def __init__(self, schema: Mapping) -> None:
        super().__init__(schema)
        self.recursive = _recursive(self)


@dataclass(frozen=True)
class Node:
    """A place in a parsed text: a variant column and a path below it.

    `string` is its JSON string, if that has been read already (NULL for others).
    """

    base: Column
    path: str = "$"
    pointer: str = "#"
    string: Column | None = None

    @property
    def value(self) -> Column:
        return self.base if self.path == "$" else self.get("variant")

    def get(self, kind: str) -> Column:
        return F.try_variant_get(self.base, self.path, kind)

    def child(self, name: str) -> Node:
        if "'" in name:
            raise ValueError(f"property name with a quote: {name}")
        return Node(self.base, f"{self.path}['{name}']", f"{self.pointer}/{name}")

    def item(self, index: int) -> Node:
        return Node(self.base, f"{self.path}[{index}]", f"{self.pointer}/{index}")

    @property
    def items(self) -> Column:
        return self.get("array<variant>")

    @property
    def entries(self) -> Column:
        """Keys and values of an object; NULL for anything else."""
        return F.map_entries(self.get("map<string,variant>"))

    @property
    def kind(self) -> Column:
        return F.schema_of_variant(self.value)

    @property
    def present(self) -> Column:
        return self.value.isNotNull()


# What `schema_of_variant` calls each JSON type.
TYPE_PATTERNS = {
    "string": "^STRING$",
    "boolean": "^BOOLEAN$",
    "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "null": "^VOID$",
    "object": "^OBJECT<",
    "array": None,
}


def is_type(node: Node, *names: str, hints: Iterable[str] = ()) -> Column:
    """Whether a value has one of some JSON types.

    `schema_of_variant` walks all of an object or array, so it comes last: a
    value with one of the hinted properties is an object without a look at it,
    and for an array it is enough that it can be read as one.
    """
    unknown = set(names) - set(TYPE_PATTERNS)
    if unknown:
        raise ValueError(f"unknown JSON types: {sorted(unknown)}")
    if node.string is not None and names == ("string",):
        return F.when(node.present, node.string.isNotNull())
    found = []
    if "object" in names:
        found += [node.child(hint).present for hint in hints]
    if "array" in names:
        is_array = F.when(node.get("array<variant>").isNotNull(), True).when(node.present, False)
        found.append(is_array)
    if "integer" in names:
        # However it is written: 1e2 is an integer, too.
        number = F.when(node.kind.rlike("^(DOUBLE|FLOAT)$"), node.get("double"))
        found.append(F.coalesce(number == F.floor(number), F.lit(False)))
    rest = [TYPE_PATTERNS[n] for n in names if n != "array"]
    if rest:
        found.append(node.kind.rlike("|".join(rest)))
    return reduce(lambda a, b: a | b, found)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is read once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def string_at(node: Node) -> Column:
    """The value if it is a JSON string; numbers are not turned into text.

    Without escapes it is what stands between the quotes of its JSON text, which is
    much cheaper to make than a cast of the value.
    """
    if node.string is not None:
        return node.string

    return bound(F.to_json(node.value), lambda text: string_of(text, node.value))


def violations(schema: Mapping | bool, node: Node, root: Rules | None = None) -> list[Violation]:
    """Conditions under which a value breaks a schema, in the order of its rules."""
    if isinstance(schema, bool):
        return [] if schema else [(node.present, _message(node, "false"))]
    root = Rules(schema) if root is None else root
    found: list[Violation] = []
    for keyword, rule in schema.items():
        if keyword in ANNOTATIONS:
            continue
        if keyword not in KEYWORDS:
            raise ValueError(f"unsupported schema keyword: {keyword}")
        found += KEYWORDS[keyword](rule, node, schema, root)
    return found


def complies(schema: Mapping, node: Node, root: Mapping) -> Column:
    """Whether a present value conforms to a schema."""
    broken = [F.coalesce(cond, F.lit(False)) for cond, _ in violations(schema, node, root)]
    return ~reduce(lambda a, b: a | b, broken, F.lit(False))


def _message(node: Node, keyword: str) -> str:
    return json.dumps({"pointer": node.pointer, "keyword": keyword})


# Conditions are NULL, i.e. not broken, for a value that is not there: every
# reading of it is NULL. So only rules that count need to ask for presence.


def resolved(schema: Mapping | bool, root: Mapping) -> Mapping:
    """A schema or what it refers to."""
    if isinstance(schema, bool):
        return {}
    if "$ref" not in schema:
        return schema
    return resolved(definition(schema["$ref"], root), root)


def definition(pointer: str, root: Mapping) -> Mapping:
    """What a pointer refers to; `#` is the whole schema."""
    if pointer != "#" and not pointer.startswith("#/"):
        raise ValueError(f"only references within the document are supported: {pointer}")
    parts = [p.replace("~1", "/").replace("~0", "~") for p in pointer.split("/")[1:]]
    return reduce(lambda doc, part: doc[int(part) if isinstance(doc, list) else part], parts, root)


def _references(rule) -> set[str]:
    """All pointers that a part of a schema mentions."""
    if isinstance(rule, Mapping):
        own = {rule["$ref"]} if isinstance(rule.get("$ref"), str) else set()
        return own.union(*[_references(v) for k, v in rule.items() if k not in ("definitions", "$defs")])
    return set().union(*[_references(v) for v in rule]) if isinstance(rule, list) else set()


def _recursive(root: Mapping) -> list[str]:
    """Pointers to definitions that refer to themselves, directly or over others."""
    after: dict[str, set[str]] = {}
    open_ = list(_references(root))
    while open_:
        pointer = open_.pop()
        if pointer not in after:
            after[pointer] = _references(definition(pointer, root))
            open_ += after[pointer]
    for _ in after:
        for reached in after.values():
            reached |= set().union(*[after[p] for p in reached])
    return sorted(p for p, reached in after.items() if p in reached)


def _none() -> Column:
    return F.array().cast("array<variant>")


def _all(found: list[Column]) -> Column:
    """Arrays of values as one, without missing values."""
    known = [F.coalesce(c, _none()) for c in found]
    return F.filter(F.concat(*known), lambda v: v.isNotNull()) if known else _none()


def referred(schema: Mapping | bool, node: Node, root: Mapping, pointer: str) -> list[Column]:
    """Arrays of the values of a document to which a recursive definition applies,
    as far as a schema says without going into recursive definitions.
    """
    if isinstance(schema, bool) or pointer not in _reach(schema, root):
        return []

    def each(values: Column, sub) -> list[Column]:
        if pointer not in _reach(sub, root):
            return []
        return [F.flatten(F.transform(values, lambda v: _all(referred(sub, Node(v), root, pointer))))]

    found: list[Column] = []
    for keyword, rule in schema.items():
        if keyword == "$ref":
            if rule == pointer:
                found.append(F.array(node.value))
            elif rule not in root.recursive:
                found += referred(definition(rule, root), node, root, pointer)
        elif keyword == "properties":
            found += [c for n, sub in rule.items() for c in referred(sub, node.child(n), root, pointer)]
        elif keyword == "allOf":
            found += [c for sub in rule for c in referred(sub, node, root, pointer)]
        elif keyword in ("items", "prefixItems") and isinstance(rule, list):
            found += [c for i, sub in enumerate(rule) for c in referred(sub, node.item(i), root, pointer)]
        elif keyword == "items":
            found += each(_rest(node.items, schema), rule)
        elif keyword == "patternProperties":
            for pattern, sub in rule.items():
                found += each(_values(node, _named_like(pattern)), sub)
        elif keyword == "additionalProperties":
            found += each(_values(node, _not_named(schema)), rule)
        elif keyword not in ANNOTATIONS and pointer in _reach(rule, root):
            raise ValueError(f"recursion below {keyword} is not supported")
    return found


def _reach(rule, root: Mapping) -> set[str]:
    """Recursive pointers that a part of a schema comes to without passing one."""
    recursive, found, open_ = root.recursive, set(), list(_references(rule))
    seen: set[str] = set()
    while open_:
        pointer = open_.pop()
        if pointer in recursive:
            found.add(pointer)
        elif pointer not in seen:
            seen.add(pointer)
            open_ += _references(definition(pointer, root))
    return found


def _named_like(pattern: str):
    return lambda key: key.rlike(pattern)


def _not_named(schema: Mapping):
    """Whether a key is additional: neither a property nor like a pattern."""
    names = [F.lit(n) for n in schema.get("properties", {})]
    patterns = list(schema.get("patternProperties", {}))
    known = F.array(*names).cast("array<string>")

    def test(key: Column) -> Column:
        like = [key.rlike(p) for p in patterns]
        return reduce(lambda a, b: a & ~b, like, ~F.array_contains(known, key))

    return test


def _values(node: Node, test) -> Column:
    """Values of an object whose keys pass a test."""
    return F.transform(F.filter(node.entries, lambda e: test(e["key"])), lambda e: e["value"])


def _rest(items: Column, schema: Mapping) -> Column:
    """Items behind those that `prefixItems` speaks of."""
    first = len(schema.get("prefixItems", []))
    return F.slice(items, first + 1, F.greatest(F.size(items), F.lit(1))) if first else items


def scalar_hints(schema: Mapping, root: Mapping) -> list[str]:
    """Properties of a schema that hold neither objects nor arrays.

    Reading a value copies it, so a small property is the cheap sign of the
    object around it.
    """
    small = []
    for name, sub in schema.get("properties", {}).items():
        if isinstance(sub, Mapping) and sub.get("$ref") in root.recursive:
            continue
        kinds = resolved(sub, root).get("type", "object")
        if not {"object", "array"} & set([kinds] if isinstance(kinds, str) else kinds):
            small.append(name)
    return small


def is_present(node: Node, schema: Mapping, root: Mapping) -> Column:
    """Whether there is a value, by its small properties before all of it."""
    recursive = isinstance(schema, Mapping) and schema.get("$ref") in root.recursive
    hints = [] if recursive else scalar_hints(resolved(schema, root), root)
    return reduce(lambda a, b: a | b, [*[node.child(h).present for h in hints], node.present])


def _type(rule, node, schema, root):
    names = [rule] if isinstance(rule, str) else list(rule)
    return [(~is_type(node, *names, hints=scalar_hints(schema, root)), _message(node, "type"))]


def _required(rule, node, schema, root):
    is_object = is_type(node, "object", hints=scalar_hints(schema, root))
    found = []
    for name in rule:
        child, sub = node.child(name), schema.get("properties", {}).get(name, {})
        found.append((~is_present(child, sub, root) & is_object, _message(child, "required")))
    return found


def _properties(rule, node, schema, root):
    small, found = scalar_hints(schema, root), []
    for name, sub in rule.items():
        child = node.child(name)
        found += [_at_once(sub, child, root)] if name in small else violations(sub, child, root)
    return found


def _at_once(rule, node, root) -> Violation:
    """The first violation of a small value, which is copied out once for all its rules."""
    first = bound(node.value, lambda v: _broken_rule(rule, v, node.pointer, root))
    return first.isNotNull(), first


def _broken_rule(rule, value: Column, pointer: str, root: Mapping, string: Column | None = None) -> Column:
    """Text of the first rule that a value, a lambda's variable, breaks; a string is
    read once for all rules.
    """
    if string is not None or resolved(rule, root).get("type") != "string":
        return _first(violations(rule, Node(value, "$", pointer, string), root))
    return bound(
        string_at(Node(value)), lambda text: _first(violations(rule, Node(value, "$", pointer, text), root))
    )


def _broken(values: Column, rule, root) -> Column:
    """Whether any of some values breaks a schema; NULL if there can be none."""
    return F.exists(values, lambda v: ~complies(rule, Node(v), root))


def _additional(rule, node, schema, root):
    # Anything but an object has no keys, which makes the condition NULL.
    extra = _broken(_values(node, _not_named(schema)), rule, root)
    return [(extra, _message(node, "additionalProperties"))]


def _pattern_properties(rule, node, schema, root):
    return [
        (_broken(_values(node, _named_like(p)), sub, root), _message(node, "patternProperties"))
        for p, sub in rule.items()
    ]


def _property_names(rule, node, schema, root):
    keys = F.transform(node.entries, lambda e: e["key"])
    # A name as a value of its own.
    named = F.transform(keys, lambda k: F.parse_json(F.to_json(F.array(k))))
    broken = F.exists(named, lambda v: ~complies(rule, Node(v, "$[0]"), root))
    return [(broken, _message(node, "propertyNames"))]


def _dependencies(rule, node, schema, root):
    found = []
    for name, needed in rule.items():
        here = node.child(name).present
        if isinstance(needed, list):
            found += [
                (here & ~node.child(n).present, _message(node, "dependencies")) for n in needed
            ]
        else:
            found.append((here & ~complies(needed, node, root), _message(node, "dependencies")))
    return found


def _size_rule(keyword, part, broken):
    def rule_violations(rule, node, schema, root):
        return [(broken(F.array_size(part(node)), rule), _message(node, keyword))]

    return rule_violations


def _texts(values) -> list[str]:
    """Values as a variant is written: objects with their keys in order."""
    return [json.dumps(v, ensure_ascii=False, separators=(",", ":"), sort_keys=True) for v in values]


def _equals(node: Node, values) -> Column:
    """Whether a value is one of some; numbers by value, however they are written."""
    numbers = [float(v) for v in values if isinstance(v, (int, float)) and not isinstance(v, bool)]
    same = F.to_json(node.value).isin(*_texts(values))
    if node.string is not None:
        texts = [v for v in values if isinstance(v, str)]
        same = F.when(node.string.isNotNull(), node.string.isin(*texts) if texts else False).otherwise(same)
    if numbers:
        number = F.when(is_type(node, "number"), node.get("double"))
        same |= F.coalesce(number.isin(*numbers), F.lit(False))
    return same


def _enum(rule, node, schema, root):
    return [(~_equals(node, rule), _message(node, "enum"))]


def _const(rule, node, schema, root):
    return [(~_equals(node, [rule]), _message(node, "const"))]


def _not(rule, node, schema, root):
    return [(complies(rule, node, root) & node.present, _message(node, "not"))]


def _if(rule, node, schema, root):
    holds = complies(rule, node, root)
    found = []
    for keyword, case in (("then", holds), ("else", ~holds)):
        if keyword in schema:
            broken = case & ~complies(schema[keyword], node, root) & node.present
            found.append((broken, _message(node, keyword)))
    return found


def _unique_items(rule, node, schema, root):
    texts = F.transform(node.items, lambda item: F.to_json(item))
    repeated = F.array_size(F.array_distinct(texts)) < F.array_size(texts)
    return [(repeated, _message(node, "uniqueItems"))] if rule else []


def _contains(rule, node, schema, root):
    some = F.exists(node.items, lambda item: complies(rule, Node(item), root))
    return [(~some, _message(node, "contains"))]


def _string_rule(keyword, broken):
    def rule_violations(rule, node, schema, root):
        return [(broken(string_at(node), rule), _message(node, keyword))]

    return rule_violations


def _number_rule(keyword, broken):
    def rule_violations(rule, node, schema, root):
        number = F.when(is_type(node, "number"), node.get("double"))
        return [(broken(number, rule, schema), _message(node, keyword))]

    return rule_violations


def _format(text: Column, name: str) -> Column:
    if name not in FORMATS:
        raise ValueError(f"unsupported format: {name}")
    return ~FORMATS[name](text)


def _minimum(number: Column, bound: float, schema: Mapping) -> Column:
    return number <= bound if schema.get("exclusiveMinimum") is True else number < bound


def _multiple_of(number: Column, step: float, schema: Mapping) -> Column:
    times = number / F.lit(float(step))
    return F.abs(times - F.rint(times)) > 1e-9


def _maximum(number: Column, bound: float, schema: Mapping) -> Column:
    return number >= bound if schema.get("exclusiveMaximum") is True else number > bound


def _exclusive(keyword, broken):
    """A bound of its own; true and false belong to `minimum` and `maximum`."""
    own = _number_rule(keyword, lambda number, bound, schema: broken(number, bound))

    def rule_violations(rule, node, schema, root):
        return [] if isinstance(rule, bool) else own(rule, node, schema, root)

    return rule_violations


def _items(rule, node, schema, root):
    if isinstance(rule, list):
        return _prefix_items(rule, node, schema, root)
    # Anything but an array reads as NULL, and so does the condition.
    return [(_broken(_rest(node.items, schema), rule, root), _message(node, "items"))]


def _prefix_items(rule, node, schema, root):
    return [v for i, sub in enumerate(rule) for v in violations(sub, node.item(i), root)]


def _additional_items(rule, node, schema, root):
    first = schema.get("items")
    if not isinstance(first, list):
        return []
    rest = F.slice(node.items, len(first) + 1, F.greatest(F.size(node.items), F.lit(1)))
    return [(_broken(rest, rule, root), _message(node, "additionalItems"))]


def _matches(rule, node, root) -> Column:
    return reduce(
        lambda a, b: a + b, [complies(sub, node, root).cast("int") for sub in rule], F.lit(0)
    )


def _all_of(rule, node, schema, root):
    return [v for sub in rule for v in violations(sub, node, root)]


def _any_of(rule, node, schema, root):
    broken = _matches(rule, node, root) < 1
    return [(broken & node.present, _message(node, "anyOf"))]


def _one_of(rule, node, schema, root):
    broken = _matches(rule, node, root) != 1
    return [(broken & node.present, _message(node, "oneOf"))]


def _ref(rule, node, schema, root):
    # Recursive definitions are checked apart, level by level.
    if rule in root.recursive:
        return []
    return violations(resolved({"$ref": rule}, root), node, root)


def _nothing(rule, node, schema, root):
    return []


KEYWORDS = {
    "type": _type,
    "required": _required,
    "properties": _properties,
    "additionalProperties": _additional,
    "enum": _enum,
    "pattern": _string_rule("pattern", lambda text, p: ~text.rlike(p)),
    "minLength": _string_rule("minLength", lambda text, n: F.length(text) < n),
    "maxLength": _string_rule("maxLength", lambda text, n: F.length(text) > n),
    "format": _string_rule("format", _format),
    "minimum": _number_rule("minimum", _minimum),
    "maximum": _number_rule("maximum", _maximum),
    "exclusiveMinimum": _exclusive("exclusiveMinimum", lambda number, bound: number <= bound),
    "exclusiveMaximum": _exclusive("exclusiveMaximum", lambda number, bound: number >= bound),
    "multipleOf": _number_rule("multipleOf", _multiple_of),
    "items": _items,
    "prefixItems": _prefix_items,
    "additionalItems": _additional_items,
    "minItems": _size_rule("minItems", lambda node: node.items, lambda size, n: size < n),
    "maxItems": _size_rule("maxItems", lambda node: node.items, lambda size, n: size > n),
    "uniqueItems": _unique_items,
    "contains": _contains,
    "minProperties": _size_rule("minProperties", lambda node: node.entries, lambda size, n: size < n),
    "maxProperties": _size_rule("maxProperties", lambda node: node.entries, lambda size, n: size > n),
    "patternProperties": _pattern_properties,
    "propertyNames": _property_names,
    "dependencies": _dependencies,
    "dependentRequired": _dependencies,
    "dependentSchemas": _dependencies,
    "const": _const,
    "not": _not,
    "if": _if,
    "then": _nothing,
    "else": _nothing,
    "allOf": _all_of,
    "anyOf": _any_of,
    "oneOf": _one_of,
    "$ref": _ref,
}


def _first(found: list[Violation]) -> Column:
    if not found:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(cond, F.lit(message)) for cond, message in found])


def first_violation(schema: Mapping, parsed: Column) -> Column:
    """Text of the first rule a parsed value breaks, NULL if it conforms.

    Rules of recursive definitions come after all others; their pointers start at
    the definition.
    """
    schema = Rules(schema)
    own = _first(violations(schema, Node(parsed), schema))
    pointers = schema.recursive
    if not pointers:
        return own
    levels = [f"level{i}" for i in range(len(pointers))]
    start = F.struct(
        F.lit(None).cast("string").alias("found"),
        *[_all(referred(schema, Node(parsed), schema, p)).alias(n) for p, n in zip(pointers, levels, strict=True)],
    )

    def check(pointer: str):
        rules = definition(pointer, schema)
        return lambda value: _first(violations(rules, Node(value, "$", pointer), schema))

    def below(pointer: str, other: str):
        rules = definition(pointer, schema)
        return lambda value: _all(referred(rules, Node(value), schema, other))

    def step(at: Column, _: Column) -> Column:
        found, deeper = [], {p: [] for p in pointers}
        for pointer, level in zip(pointers, levels, strict=True):
            broken = F.filter(F.transform(at[level], check(pointer)), lambda m: m.isNotNull())
            found.append(F.get(broken, F.lit(0)))
            for other in _reach(definition(pointer, schema), schema):
                deeper[other].append(F.flatten(F.transform(at[level], below(pointer, other))))
        return F.struct(
            F.coalesce(at["found"], *found).alias("found"),
            *[_all(deeper[p]).alias(n) for p, n in zip(pointers, levels, strict=True)],
        )

    # An object or array opens each level, so there are no more levels than those.
    opened = F.length(F.regexp_replace(F.to_json(parsed), r"[^\[{]", ""))
    steps = F.sequence(F.lit(0), F.coalesce(opened, F.lit(0)))
    return F.coalesce(own, F.aggregate(steps, start, step, lambda at: at["found"]))


# Keywords that need nothing of an object but which listed properties it has.
PLAIN = ANNOTATIONS | {"type", "required", "properties", "$ref"}


def _outline(schema: Mapping | bool, root: Rules, paths: Iterable[tuple[str, ...]] = ()) -> dict | None:
    """The listed and required properties of a schema and some paths, as nested
    dicts; None stands for a value that is read as it is. Objects that may be
    missing or be something else are read as they are, but for those on a path.
    """
    below: dict[str, list[tuple[str, ...]]] = {}
    for first, *rest in paths:
        below.setdefault(first, []).extend([tuple(rest)] if rest else [])
    schema = {} if isinstance(schema, bool) or schema.get("$ref") in root.recursive else resolved(schema, root)
    required, found = schema.get("required", []), {}
    for name in [*schema.get("properties", {}), *required, *below]:
        sub = schema.get("properties", {}).get(name, {})
        nested = name in required and _is_plain(sub, root)
        found[name] = _outline(sub, root, below.get(name, [])) if below.get(name) or nested else None
    return found


def _is_plain(schema: Mapping | bool, root: Rules) -> bool:
    """Whether all rules of a schema are told by the properties of an object."""
    if isinstance(schema, bool) or schema.get("$ref") in root.recursive:
        return False
    if "$ref" in schema and set(schema) - ANNOTATIONS - {"$ref"}:
        return False
    rules = resolved(schema, root)
    kind = rules.get("type")
    return kind in ("object", ["object"]) and "properties" in rules and not set(rules) - PLAIN


def _outline_type(outline: dict) -> str:
    fields = [f"`{n}`: {'variant' if sub is None else _outline_type(sub)}" for n, sub in outline.items()]
    return f"struct<{', '.join(fields)}>"


def _readable(outline: dict) -> bool:
    """Whether the names can be those of a struct's fields."""
    names = [n.lower() for n in outline]
    return len(set(names)) == len(names) and all(
        "`" not in n and n and (sub is None or _readable(sub)) for n, sub in outline.items()
    )


# Rules of a string that take no function of an array's element, which is interpreted.
COMPILED = ANNOTATIONS | {"type", "enum", "const", "pattern", "minLength", "maxLength", "format"}


def _signs(
    schema: Mapping, at: Column, outline: dict, root: Rules, strings: Mapping[str, Column], pointer: str = "#"
) -> list[tuple[bool, Column]]:
    """Signs that, all together, tell that an outlined object conforms for certain; if
    not, all rules must tell. Each comes with whether all of it can be compiled.

    `strings` are those read already, by pointer.
    """
    rules = resolved(schema, root)
    found = [(True, at.isNotNull()), *[(True, at[name].isNotNull()) for name in rules.get("required", [])]]
    for name, sub in rules.get("properties", {}).items():
        here = f"{pointer}/{name}"
        if outline[name] is not None:
            plain = _is_plain(sub, root)
            found += _signs(sub, at[name], outline[name], root, strings, here) if plain else [(True, F.lit(False))]
        else:
            compiled = here in strings and not set(resolved(sub, root)) - COMPILED
            sign = None if here in strings else _compiled_sign(sub, Node(at[name]), root)
            if sign is None:
                sign = _broken_rule(sub, at[name], here, root, strings.get(here)).isNull()
            else:
                compiled = True
            found.append((compiled, at[name].isNull() | sign))
    return found


# Rules of a number that take no function of an array's element.
NUMERIC = ANNOTATIONS | {
    "type", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf",
}


def _compiled_sign(schema: Mapping | bool, node: Node, root: Rules) -> Column | None:
    """A sign that tells in compiled code that a present value conforms for certain:
    a number, a list of strings or an object of such values. None if there is none.
    """
    if isinstance(schema, bool) or "$ref" in schema and set(schema) - ANNOTATIONS - {"$ref"}:
        return None
    if schema.get("$ref") in root.recursive:
        return None
    rules = resolved(schema, root)
    kind, keywords = rules.get("type"), set(rules) - ANNOTATIONS
    if kind in ("number", "integer", "boolean") and not keywords - NUMERIC:
        return _first(violations(rules, node, root)).isNull()
    if kind == "array" and keywords == {"type", "items"} and rules["items"] == {"type": "string"}:
        # Nulls among strings do not show in the type, so a list with such a text is none for certain.
        return (node.kind == "ARRAY<STRING>") & ~F.to_json(node.value).contains("null")
    if kind == "object" and keywords == {"type", "properties"}:
        children = {name: node.child(name) for name in rules["properties"]}
        signs = {n: _compiled_sign(rules["properties"][n], child, root) for n, child in children.items()}
        if any(sign is None for sign in signs.values()):
            return None
        is_object = is_type(node, "object", hints=scalar_hints(rules, root))
        return is_object & _every(~children[n].present | sign for n, sign in signs.items())
    return None


def _every(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


class Outline:
    """What of a record decides as a rule whether it conforms to a schema: its listed
    and required properties and the required strings.

    Where `tells` is false, a look at these is not enough.
    """

    def __init__(self, schema: Mapping | None) -> None:
        self.schema = schema
        self.root = Rules({} if schema is None else schema)
        self.paths = {name: path.split(".")[1:] for name, path, _ in REQUIRED_STRINGS}
        self.parts = _outline(self.root, self.root, [tuple(path) for path in self.paths.values()])
        self.readable = _readable(self.parts)
        told = _is_plain(self.root, self.root) and not self.root.recursive
        self.told = told and self.readable
        self.tells = self.readable and (self.told or schema is None)

    def read(self, parsed: Column) -> Column:
        """The outlined values in one walk over a parsed text; NULL if it is no object."""
        return Node(parsed).get(_outline_type(self.parts))

    def strings(self) -> dict[str, list[str]]:
        """Paths of the values that are strings in a valid record, by pointer."""
        found = {"/".join(["#", *path]): path for path in self.paths.values()}

        def add(schema: Mapping, outline: dict, path: list[str]) -> None:
            for name, sub in resolved(schema, self.root).get("properties", {}).items():
                here = [*path, name]
                if outline[name] is not None:
                    if _is_plain(sub, self.root):
                        add(sub, outline[name], here)
                elif resolved(sub, self.root).get("type") == "string":
                    found["/".join(["#", *here])] = here

        if self.told:
            add(self.root, self.parts, [])
        return found

    def signs(self, at: Column, strings: Mapping[str, Column]) -> tuple[Column, Column]:
        """Whether a read outline conforms for certain: what can be compiled, and the rest."""
        found = _signs(self.root, at, self.parts, self.root, strings) if self.told else []
        return _every(sign for compiled, sign in found if compiled), _every(
            sign for compiled, sign in found if not compiled
        )


def at_path(value: Column, path: Iterable[str]) -> Column:
    return reduce(lambda c, part: c[part], path, value)


def string_of(text: Column, value: Column) -> Column:
    """The value of a JSON text if it is a string, `value` being the parsed one."""
    plain = F.substring(text, F.lit(2), F.length(text) - 2)
    return F.when(text.startswith('"'), F.when(text.contains("\\"), Node(value).get("string")).otherwise(plain))


def findings(schema: Mapping | None, parsed: Column) -> Column:
    """`is_object`, the required strings and the `violation` of a parsed text, as a
    struct. The text is to be a lambda's variable, as it is mentioned often.

    The values that decide are read in one walk over the text. Where they do not
    tell that it conforms, all rules are evaluated one by one.
    """
    outline = Outline(schema)
    violation = F.lit(None).cast("string") if schema is None else first_violation(schema, parsed)
    if not outline.readable:
        strings = [value.alias(name) for name, value in required_strings(parsed)]
        return F.struct(is_object(parsed).alias("is_object"), *strings, violation.alias("violation"))

    def found(at: Column) -> Column:
        strings = [string_at(Node(at_path(at, path))).alias(name) for name, path in outline.paths.items()]
        return bound(F.struct(*strings), lambda read: judged(at, read))

    def judged(at: Column, read: Column) -> Column:
        strings = {"/".join(["#", *path]): read[name] for name, path in outline.paths.items()}
        signs = _signs(outline.root, at, outline.parts, outline.root, strings) if outline.told else [(True, F.lit(False))]
        return F.struct(
            at.isNotNull().alias("is_object"),
            *[read[name].alias(name) for name in outline.paths],
            F.when(~_every(sign for _, sign in signs), violation).alias("violation"),
        )

    return bound(outline.read(parsed), found)


def is_object(parsed: Column) -> Column:
    """Whether a parsed text is a JSON object; false for text that is not JSON."""
    hints = [path.split(".")[1] for _, path, _ in REQUIRED_STRINGS]
    return F.coalesce(is_type(Node(parsed), "object", hints=hints), F.lit(False))


def required_strings(parsed: Column) -> list[tuple[str, Column]]:
    """The required strings by name, NULL where one is missing."""
    return [
        (name, bound(Node(parsed, path).value, lambda v: string_at(Node(v))))
        for name, path, _ in REQUIRED_STRINGS
    ]
