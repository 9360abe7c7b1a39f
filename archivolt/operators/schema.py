"""A JSON Schema compiled to column expressions over VARIANT values.

``compile_schema`` reads a schema (draft 2020-12) and returns one expression: the problems of a value, each with the path at
which it stands and the keyword that it breaks. The keywords are type, enum, const, required, properties, patternProperties,
additionalProperties, propertyNames, dependentRequired, minProperties, maxProperties, items, prefixItems, minItems, maxItems,
uniqueItems, contains, minLength, maxLength, pattern, minimum, maximum, exclusiveMinimum, exclusiveMaximum, multipleOf, allOf,
anyOf, oneOf, not, if/then/else and $ref within the schema. Words that only describe are passed over; any other is refused
when the schema is read, so that no rule is silently dropped. A reference that comes back to itself is followed ``depth``
times; a value nested deeper is a problem of its own.

Defined results: a null value (no record) has no problems; JSON's null is a value. Numbers are compared as decimals of 38
digits or, beyond these, as doubles; 1.0 is an integer. Lengths are in code points. Patterns are searched for anywhere, in
Java's syntax. Order of problems: a value's own before its parts', keywords in the order above, parts in theirs.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that only describe.
_ANNOTATIONS = frozenset("$schema $id $anchor $comment $defs definitions title description default examples deprecated readOnly writeOnly format contentMediaType contentEncoding".split())
_PROBLEM = "struct<path:string,keyword:string>"
_NONE = f"array<{_PROBLEM}>"
_KINDS = ("null", "boolean", "integer", "number", "string", "array", "object")

#: Records that a task checks, about.
TASK_RECORDS = 10_000

#: Column of the value, and of its path.
Check = Callable[[Column, Column], list[Column]]


def _none() -> Column:
    return F.array().cast(_NONE)


def _if(bad: Column, path: Column, keyword: str) -> Column:
    """One problem where ``bad`` holds."""
    return F.when(F.coalesce(bad, F.lit(False)), F.array(F.struct(path.alias("path"), F.lit(keyword).alias("keyword")))).otherwise(_none())


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once."""
    return F.transform(F.array(value), body)[0]


def kind_of(v: Column) -> Column:
    """null, boolean, integer, number (not an integer), string, array or object."""
    t = F.upper(F.schema_of_variant(v))
    number = t.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    whole = t.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL\\([0-9]+, ?0\\))") | (number & (_double(v) % 1 == 0))
    return (
        F.when(t == "VOID", "null")
        .when(t == "BOOLEAN", "boolean")
        .when(t.startswith("OBJECT"), "object")
        .when(t.startswith("ARRAY"), "array")
        .when(whole, "integer")
        .when(number, "number")
        .otherwise("string")
    )


def _double(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _members(v: Column) -> Column:
    """An object's members, an empty map for another value."""
    return F.coalesce(v.try_cast("map<string,variant>"), F.create_map().cast("map<string,variant>"))


def _elements(v: Column) -> Column:
    return F.coalesce(v.try_cast("array<variant>"), F.array().cast("array<variant>"))


def canonical(value: Any) -> str:
    """A JSON value as the text by which values are compared: members in order of their names, equal numbers alike."""
    if isinstance(value, bool) or value is None:
        return json.dumps(value)
    if isinstance(value, (int, float)):
        return str(int(value)) if float(value).is_integer() and abs(value) < 1 << 53 else repr(float(value)) if isinstance(value, float) else str(value)
    if isinstance(value, str):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{canonical(value[k])}" for k in sorted(value)) + "}"


def _equals(v: Column, kind: Column, want: Any) -> Column:
    """Whether a value is the given one: by kind for plain values, by the text of the whole for nested ones."""
    if want is None:
        return kind == "null"
    if isinstance(want, bool):
        return (kind == "boolean") & (_text(v) == json.dumps(want))
    if isinstance(want, (int, float)):
        return kind.isin("integer", "number") & (_double(v) == float(want))
    if isinstance(want, str):
        return (kind == "string") & (_text(v) == want)
    return kind.isin("array", "object") & (F.to_json(v) == canonical(want))


class _Compiler:
    def __init__(self, schema: Any, depth: int):
        self.root, self.depth = schema, depth

    def target(self, ref: str) -> Any:
        if not ref.startswith("#"):
            raise ValueError(f"reference outside the schema: {ref}")
        at = self.root
        for part in ref[1:].split("/")[1:]:
            part = part.replace("~1", "/").replace("~0", "~")
            at = at[int(part)] if isinstance(at, list) else at[part]
        return at

    def problems(self, schema: Any, v: Column, path: Column, seen: tuple[str, ...] = ()) -> Column:
        """The problems of a value that is there."""
        if schema is True or schema == {}:
            return _none()
        if schema is False:
            return _if(F.lit(True), path, "false")
        unknown = set(schema) - _ANNOTATIONS - set(self.KEYWORDS) - {"then", "else"}
        if unknown:
            raise ValueError(f"keywords not known: {', '.join(sorted(unknown))}")
        own = [k for k in self.KEYWORDS if k in schema]

        def all_of(k: Column) -> Column:
            parts = [getattr(self, f"_{name.strip('$')}")(schema, v, k, path, seen) for name in own]
            return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else _none()

        return _bind(kind_of(v), all_of)

    # each: (schema, value, its kind, its path, references on the way) to problems

    def _type(self, schema, v, k, path, seen):
        want = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        if set(want) - set(_KINDS):
            raise ValueError(f"types not known: {want}")
        return _if(~k.isin(*want, *(["integer"] if "number" in want else [])), path, "type")

    def _enum(self, schema, v, k, path, seen):
        return _if(~functools.reduce(lambda a, b: a | b, (F.coalesce(_equals(v, k, x), F.lit(False)) for x in schema["enum"]), F.lit(False)), path, "enum")

    def _const(self, schema, v, k, path, seen):
        return _if(~F.coalesce(_equals(v, k, schema["const"]), F.lit(False)), path, "const")

    def _required(self, schema, v, k, path, seen):
        names = F.map_keys(_members(v))
        missing = F.filter(F.array(*(F.lit(x) for x in schema["required"])).cast("array<string>"), lambda x: ~F.array_contains(names, x))
        return F.when(k == "object", F.transform(missing, lambda x: F.struct(F.concat(path, F.lit("/"), x).alias("path"), F.lit("required").alias("keyword")))).otherwise(_none())

    def _properties(self, schema, v, k, path, seen):
        def parts(members: Column) -> Column:
            out = [self._part(s, members, name, path, seen) for name, s in schema["properties"].items()]
            return F.concat(*out) if out else _none()

        return F.when(k == "object", _bind(_members(v), parts)).otherwise(_none())

    def _part(self, schema, members, name, path, seen):
        child = F.try_element_at(members, F.lit(name))
        return F.when(F.map_contains_key(members, name), _bind(child, lambda c: self.problems(schema, c, F.concat(path, F.lit(f"/{name}")), seen))).otherwise(_none())

    def _each(self, members: Column, keep: Callable[[Column], Column], schema: Any, path: Column, seen) -> Column:
        """Problems of the members whose name fits."""
        entries = F.filter(F.map_entries(members), lambda e: keep(e["key"]))
        return F.flatten(F.transform(entries, lambda e: self.problems(schema, e["value"], F.concat(path, F.lit("/"), e["key"]), seen)))

    def _patternProperties(self, schema, v, k, path, seen):  # noqa: N802
        parts = [self._each(_members(v), lambda x, p=p: x.rlike(p), s, path, seen) for p, s in schema["patternProperties"].items()]  # noqa: B023
        return F.when(k == "object", F.concat(_none(), *parts)).otherwise(_none())

    def _additionalProperties(self, schema, v, k, path, seen):  # noqa: N802
        known = list(schema.get("properties", {}))
        patterns = list(schema.get("patternProperties", {}))

        def other(name: Column) -> Column:
            out = ~name.isin(*known) if known else F.lit(True)
            for p in patterns:
                out = out & ~name.rlike(p)
            return out

        rule = schema["additionalProperties"]
        if rule is False:
            names = F.filter(F.map_keys(_members(v)), other)
            found = F.transform(names, lambda x: F.struct(F.concat(path, F.lit("/"), x).alias("path"), F.lit("additionalProperties").alias("keyword")))
        else:
            found = self._each(_members(v), other, rule, path, seen)
        return F.when(k == "object", found).otherwise(_none())

    def _propertyNames(self, schema, v, k, path, seen):  # noqa: N802
        def named(x: Column) -> Column:
            return self.problems(schema["propertyNames"], F.parse_json(F.to_json(F.array(x))).cast("array<variant>")[0], F.concat(path, F.lit("/"), x), seen)

        return F.when(k == "object", F.flatten(F.transform(F.map_keys(_members(v)), named))).otherwise(_none())

    def _dependentRequired(self, schema, v, k, path, seen):  # noqa: N802
        parts = []
        for name, needs in schema["dependentRequired"].items():
            for need in needs:
                names = F.map_keys(_members(v))
                parts.append(_if((k == "object") & F.array_contains(names, name) & ~F.array_contains(names, need), F.concat(path, F.lit(f"/{need}")), "dependentRequired"))
        return F.concat(_none(), *parts)

    def _minProperties(self, schema, v, k, path, seen):  # noqa: N802
        return _if((k == "object") & (F.size(_members(v)) < schema["minProperties"]), path, "minProperties")

    def _maxProperties(self, schema, v, k, path, seen):  # noqa: N802
        return _if((k == "object") & (F.size(_members(v)) > schema["maxProperties"]), path, "maxProperties")

    def _items(self, schema, v, k, path, seen):
        first = len(schema.get("prefixItems", []))

        def one(x: Column, i: Column) -> Column:
            found = self.problems(schema["items"], x, F.concat(path, F.lit("/"), i.cast("string")), seen)
            return F.when(i >= first, found).otherwise(_none()) if first else found

        return F.when(k == "array", F.flatten(F.transform(_elements(v), one))).otherwise(_none())

    def _prefixItems(self, schema, v, k, path, seen):  # noqa: N802
        def parts(own: Column) -> Column:
            out = [F.when(F.size(own) > i, self.problems(s, F.get(own, F.lit(i)), F.concat(path, F.lit(f"/{i}")), seen)).otherwise(_none()) for i, s in enumerate(schema["prefixItems"])]
            return F.concat(_none(), *out)

        return F.when(k == "array", _bind(_elements(v), parts)).otherwise(_none())

    def _minItems(self, schema, v, k, path, seen):  # noqa: N802
        return _if((k == "array") & (F.size(_elements(v)) < schema["minItems"]), path, "minItems")

    def _maxItems(self, schema, v, k, path, seen):  # noqa: N802
        return _if((k == "array") & (F.size(_elements(v)) > schema["maxItems"]), path, "maxItems")

    def _uniqueItems(self, schema, v, k, path, seen):  # noqa: N802
        texts = F.transform(_elements(v), lambda x: F.to_json(x))
        return _if((k == "array") & F.lit(bool(schema["uniqueItems"])) & (F.size(F.array_distinct(texts)) < F.size(texts)), path, "uniqueItems")

    def _contains(self, schema, v, k, path, seen):
        some = F.exists(_elements(v), lambda x: F.size(self.problems(schema["contains"], x, path, seen)) == 0)
        return _if((k == "array") & ~some, path, "contains")

    def _minLength(self, schema, v, k, path, seen):  # noqa: N802
        return _if((k == "string") & (F.length(_text(v)) < schema["minLength"]), path, "minLength")

    def _maxLength(self, schema, v, k, path, seen):  # noqa: N802
        return _if((k == "string") & (F.length(_text(v)) > schema["maxLength"]), path, "maxLength")

    def _pattern(self, schema, v, k, path, seen):
        re.compile(schema["pattern"])
        return _if((k == "string") & ~_text(v).rlike(schema["pattern"]), path, "pattern")

    def _number(self, v: Column, k: Column, bad: Callable[[Column, Column], Column], bound: float, path: Column, word: str) -> Column:
        """Compared as decimals where both are, else as doubles."""
        exact = F.try_variant_get(v, "$", "decimal(38,10)")
        near = bad(_double(v), F.lit(float(bound)))
        return _if(k.isin("integer", "number") & F.coalesce(bad(exact, F.lit(str(bound)).try_cast("decimal(38,10)")), near), path, word)

    def _minimum(self, schema, v, k, path, seen):
        return self._number(v, k, lambda a, b: a < b, schema["minimum"], path, "minimum")

    def _maximum(self, schema, v, k, path, seen):
        return self._number(v, k, lambda a, b: a > b, schema["maximum"], path, "maximum")

    def _exclusiveMinimum(self, schema, v, k, path, seen):  # noqa: N802
        return self._number(v, k, lambda a, b: a <= b, schema["exclusiveMinimum"], path, "exclusiveMinimum")

    def _exclusiveMaximum(self, schema, v, k, path, seen):  # noqa: N802
        return self._number(v, k, lambda a, b: a >= b, schema["exclusiveMaximum"], path, "exclusiveMaximum")

    def _multipleOf(self, schema, v, k, path, seen):  # noqa: N802
        return self._number(v, k, lambda a, b: a % b != 0, schema["multipleOf"], path, "multipleOf")

    def _allOf(self, schema, v, k, path, seen):  # noqa: N802
        return F.concat(_none(), *(self.problems(s, v, path, seen) for s in schema["allOf"]))

    def _valid(self, schema: Any, v: Column, path: Column, seen) -> Column:
        return F.size(self.problems(schema, v, path, seen)) == 0

    def _anyOf(self, schema, v, k, path, seen):  # noqa: N802
        return _if(~functools.reduce(lambda a, b: a | b, (self._valid(s, v, path, seen) for s in schema["anyOf"])), path, "anyOf")

    def _oneOf(self, schema, v, k, path, seen):  # noqa: N802
        n = functools.reduce(lambda a, b: a + b, (self._valid(s, v, path, seen).cast("int") for s in schema["oneOf"]))
        return _if(n != 1, path, "oneOf")

    def _not(self, schema, v, k, path, seen):
        return _if(self._valid(schema["not"], v, path, seen), path, "not")

    def _if(self, schema, v, k, path, seen):
        yes, no = (self.problems(schema.get(word, True), v, path, seen) for word in ("then", "else"))
        return F.when(self._valid(schema["if"], v, path, seen), yes).otherwise(no)

    def _ref(self, schema, v, k, path, seen):
        ref = schema["$ref"]
        if seen.count(ref) >= self.depth:
            return _if(F.lit(True), path, "depth")
        return self.problems(self.target(ref), v, path, (*seen, ref))

    KEYWORDS = (
        "type", "enum", "const", "minLength", "maxLength", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf",
        "required", "dependentRequired", "minProperties", "maxProperties", "propertyNames", "minItems", "maxItems", "uniqueItems", "contains",
        "additionalProperties", "properties", "patternProperties", "prefixItems", "items", "$ref", "allOf", "anyOf", "oneOf", "not", "if",
    )


def compile_schema(schema: dict | bool, value: Column, depth: int = 3) -> Column:
    """The problems (path, keyword) of a VARIANT column, an array; paths are JSON pointers, the empty one is the whole."""
    return F.when(value.isNull(), _none()).otherwise(_Compiler(schema, depth).problems(schema, value, F.lit("")))


def schema_problems(records: DataFrame, schema: dict | bool, *, json_col: str, key: str, depth: int = 3) -> DataFrame:
    """(key, path, keyword, problems): the first problem of every record in JSON, null for a valid one, and their number. Text
    that is no JSON has the problem "json"."""
    value = F.try_parse_json(json_col)
    found = records.select(key, F.col(json_col).isNotNull().alias("__some"), value.alias("__v"))
    found = found.select(key, ((F.col("__some")) & F.col("__v").isNull()).alias("__bad"), compile_schema(schema, F.col("__v"), depth).alias("__p"))
    first = F.when(F.col("__bad"), F.struct(F.lit("").alias("path"), F.lit("json").alias("keyword"))).otherwise(F.get("__p", F.lit(0)))
    return found.select(key, first["path"].alias("path"), first["keyword"].alias("keyword"), (F.size("__p") + F.col("__bad").cast("int")).alias("problems"))
