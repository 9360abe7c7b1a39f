"""The schema compiler against a plain validator: every keyword, nested values, references, odd records."""

from __future__ import annotations

import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from archivolt.operators import schema as S


def plain(schema, value, path="", root=None, seen=()):
    """(path, keyword) of every problem, in the compiler's order."""
    root = schema if root is None else root
    if schema is True:
        return []
    if schema is False:
        return [(path, "false")]
    kind = S._KINDS[0] if value is None else "boolean" if isinstance(value, bool) else None
    kind = kind or {dict: "object", list: "array", str: "string"}.get(type(value)) or ("integer" if isinstance(value, int) or float(value).is_integer() else "number")
    number, out = kind in ("integer", "number"), []
    same = lambda a, b: S.canonical(a) == S.canonical(b)
    ok = lambda s: not plain(s, value, path, root, seen)
    for word in (k for k in S._Compiler.KEYWORDS if k in schema):
        x = schema[word]
        bad = {
            "type": lambda: kind not in (x if isinstance(x, list) else [x]) and not (kind == "integer" and "number" in x),
            "enum": lambda: not any(same(value, e) for e in x),
            "const": lambda: not same(value, x),
            "minLength": lambda: kind == "string" and len(value) < x,
            "maxLength": lambda: kind == "string" and len(value) > x,
            "pattern": lambda: kind == "string" and not re.search(x, value),
            "minimum": lambda: number and value < x,
            "maximum": lambda: number and value > x,
            "exclusiveMinimum": lambda: number and value <= x,
            "exclusiveMaximum": lambda: number and value >= x,
            "multipleOf": lambda: number and math.fmod(value, x) != 0,
            "minProperties": lambda: kind == "object" and len(value) < x,
            "maxProperties": lambda: kind == "object" and len(value) > x,
            "minItems": lambda: kind == "array" and len(value) < x,
            "maxItems": lambda: kind == "array" and len(value) > x,
            "uniqueItems": lambda: kind == "array" and x and len({S.canonical(e) for e in value}) < len(value),
            "contains": lambda: kind == "array" and all(plain(x, e, path, root, seen) for e in value),
            "anyOf": lambda: not any(ok(s) for s in x),
            "oneOf": lambda: sum(ok(s) for s in x) != 1,
            "not": lambda: ok(x),
        }.get(word)
        if bad:
            out += [(path, word)] * bool(bad())
        elif word == "allOf":
            out += [p for s in x for p in plain(s, value, path, root, seen)]
        elif word == "if":
            out += plain(schema.get("then" if ok(x) else "else", True), value, path, root, seen)
        elif word == "$ref":
            at = root
            for part in x[1:].split("/")[1:]:
                at = at[part]
            out += [(path, "depth")] if seen.count(x) >= DEPTH else plain(at, value, path, root, (*seen, x))
        elif kind == "object" and word == "required":
            out += [(f"{path}/{n}", word) for n in x if n not in value]
        elif kind == "object" and word == "dependentRequired":
            out += [(f"{path}/{n}", word) for k, needs in x.items() if k in value for n in needs if n not in value]
        elif kind == "object" and word == "properties":
            out += [p for n, s in x.items() if n in value for p in plain(s, value[n], f"{path}/{n}", root, seen)]
        elif kind == "object" and word in ("patternProperties", "additionalProperties", "propertyNames"):
            known, patterns = schema.get("properties", {}), schema.get("patternProperties", {})
            for rule, fits in x.items() if word == "patternProperties" else [(None, None)]:
                for n in sorted(value):
                    if word == "patternProperties" and re.search(rule, n):
                        out += plain(fits, value[n], f"{path}/{n}", root, seen)
                    elif word == "propertyNames":
                        out += plain(x, n, f"{path}/{n}", root, seen)
                    elif word == "additionalProperties" and n not in known and not any(re.search(p, n) for p in patterns):
                        out += [(f"{path}/{n}", word)] if x is False else plain(x, value[n], f"{path}/{n}", root, seen)
        elif kind == "array" and word == "items":
            out += [p for i, e in enumerate(value) if i >= len(schema.get("prefixItems", [])) for p in plain(x, e, f"{path}/{i}", root, seen)]
        elif kind == "array" and word == "prefixItems":
            out += [p for i, (s, e) in enumerate(zip(x, value)) for p in plain(s, e, f"{path}/{i}", root, seen)]  # noqa: B905
    return out


DEPTH = 3
SCHEMA = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "title": "a record",
    "type": "object",
    "required": ["a", "z"],
    "minProperties": 2,
    "maxProperties": 6,
    "propertyNames": {"maxLength": 3},
    "dependentRequired": {"b": ["c", "d"]},
    "properties": {
        "a": {"type": ["integer", "null"], "minimum": -2, "exclusiveMaximum": 9, "multipleOf": 2},
        "b": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "prefixItems": [{"type": "string"}], "items": {"$ref": "#/$defs/node"}, "contains": {"type": "string"}},
        "c": {"oneOf": [{"type": "number", "exclusiveMinimum": 0.5}, {"type": "number", "maximum": 1.5}, {"const": {"x": [1, "é"], "b": None}}]},
        "d": {"anyOf": [{"type": "boolean"}, {"enum": ["p", 1, None, [1, 2]]}]},
        "z": {"type": "string", "minLength": 1, "maxLength": 4, "pattern": "^[a-zé]"},
    },
    "patternProperties": {"^x": {"type": "integer"}},
    "additionalProperties": {"not": {"type": "object"}},
    "allOf": [{"if": {"required": ["d"]}, "then": {"required": ["c"]}, "else": {"properties": {"z": {"minLength": 2}}}}],
    "$defs": {"node": {"type": "object", "required": ["v"], "properties": {"v": {"type": "integer"}, "in": {"type": "array", "items": {"$ref": "#/$defs/node"}}}, "additionalProperties": False}},
}


def some_value(r, depth=0):
    pick = r.randrange(9 if depth < 3 else 6)
    if pick < 6:
        return [None, True, r.randrange(-4, 12), r.choice([0.25, 1.0, 2.5, 1e30, -7.5]), r.choice(["", "p", "é", "abc", "ABCDE", "zz"]), False][pick]
    if pick == 6:
        return [some_value(r, depth + 1) for _ in range(r.randrange(5))]
    if pick == 7:
        return {"v": some_value(r, depth + 1), **({"in": [{"v": 1}, some_value(r, depth + 1)]} if r.random() < 0.5 else {})}
    return {r.choice(["a", "b", "x", "v", "in"]): some_value(r, depth + 1) for _ in range(r.randrange(3))}


def some_record(r):
    if r.random() < 0.1:
        return some_value(r)
    return {n: r.choice([some_value(r), good]) for n, good in {"a": 2, "b": ["s", {"v": 1}], "c": 7, "d": True, "z": "abc", "x1": 3, "other": [1]}.items() if r.random() < 0.75}


def test_problems_equal_a_plain_validator(spark):
    r = random.Random(4)
    records = [some_record(r) for _ in range(400)] + [{"a": 4, "z": "ok"}, {"a": 2, "z": "é", "c": {"b": None, "x": [1, "é"]}, "d": [1, 2]}]
    rows = [(i, json.dumps(x, ensure_ascii=i % 2 == 0)) for i, x in enumerate(records)]
    df = spark.createDataFrame(rows, "id int, j string").select("id", S.compile_schema(SCHEMA, F.parse_json("j"), depth=DEPTH).alias("p"))
    got = {x.id: [(p.path, p.keyword) for p in x.p] for x in df.collect()}
    assert got == {i: plain(SCHEMA, x) for i, x in enumerate(records)}
    found = {k for own in got.values() for _, k in own}
    assert [] in got.values() and len(found) >= 19, found


def test_first_problem_of_odd_records(spark):
    rows = [(1, None), (2, "{"), (3, "null"), (4, '{"a": 2, "z": "x"}'), (5, ""), (6, '{"a": 12345678901234567890123, "z": "abc", "d": 1}')]
    got = S.schema_problems(spark.createDataFrame(rows, "id int, record string"), SCHEMA, json_col="record", key="id").collect()
    assert sorted((r.id, r.path, r.keyword, r.problems) for r in got)[:5] == [(1, None, None, 0), (2, "", "json", 1), (3, "", "type", 1), (4, "/z", "minLength", 1), (5, "", "json", 1)]
    assert [r.keyword for r in got if r.id == 6] == ["exclusiveMaximum"]
    assert S.schema_problems(spark.createDataFrame([], "id int, record string"), SCHEMA, json_col="record", key="id").collect() == []


def test_a_schema_is_refused_rather_than_read_in_part(spark):
    v = F.parse_json(F.lit("1"))
    for bad in ({"minimun": 1}, {"properties": {"a": {"unevaluatedProperties": False}}}, {"$ref": "other.json#/x"}, {"type": "text"}):
        with pytest.raises(ValueError):
            S.compile_schema(bad, v)


def test_references_that_come_back_are_followed_so_far(spark):
    tree = {"$ref": "#/$defs/n", "$defs": {"n": {"type": "object", "properties": {"n": {"$ref": "#/$defs/n"}}}}}
    rows = [(d, '{"n":' * d + "{}" + "}" * d) for d in range(5)]
    got = S.schema_problems(spark.createDataFrame(rows, "id int, record string"), tree, json_col="record", key="id", depth=3).collect()
    assert [(r.id, r.path, r.keyword) for r in sorted(got)] == [(0, None, None), (1, None, None), (2, None, None), (3, "/n/n/n", "depth"), (4, "/n/n/n", "depth")]
