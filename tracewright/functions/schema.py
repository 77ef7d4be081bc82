"""A JSON schema (draft 7) compiled to one Column over parsed documents.

Known are type, enum, const, pattern, minLength, maxLength, minimum, maximum, required, properties,
additionalProperties (false), items, minItems, maxItems and ``$ref`` into the schema itself; other
keywords are refused rather than passed over. A reference to what encloses it has no end and is
refused too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.functions.text import bound

_TELLING = {"$schema", "$id", "title", "description", "default", "examples", "$comment", "definitions", "$defs"}
_KNOWN = _TELLING | {"type", "enum", "const", "pattern", "minLength", "maxLength", "minimum", "maximum", "required", "properties", "additionalProperties", "items", "minItems", "maxItems", "$ref"}


def _json(value) -> str:
    import json

    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def _is(v: Column, kind: Column, name: str) -> Column:
    number = kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)")
    double = F.try_variant_get(v, "$", "double")
    tests = {
        "object": kind.startswith("OBJECT"), "array": kind.startswith("ARRAY"), "string": kind == "STRING", "boolean": kind == "BOOLEAN", "null": kind == "VOID",
        "number": number, "integer": number & F.coalesce(double == F.rint(double), F.lit(False)),
    }
    return tests[name]


def _resolved(schema, root: dict, seen: tuple[str, ...]) -> tuple[dict, tuple[str, ...]]:
    while isinstance(schema, dict) and "$ref" in schema:
        ref = schema["$ref"]
        if not ref.startswith("#"):
            raise ValueError(f"a reference out of the schema: {ref}")
        if ref in seen:
            raise ValueError(f"a reference to what encloses it: {ref}")
        seen, schema = (*seen, ref), root
        for step in ref[1:].strip("/").split("/") if ref != "#" else []:
            schema = schema[step.replace("~1", "/").replace("~0", "~")]
    if schema is True:
        schema = {}
    if not isinstance(schema, dict) or set(schema) - _KNOWN:
        raise ValueError(f"unknown in a schema: {schema if not isinstance(schema, dict) else sorted(set(schema) - _KNOWN)}")
    return schema, seen


def _errors(v: Column, schema, path: Column, root: dict, seen: tuple[str, ...]) -> Column:
    """Errors of ``v``, a bound value; its kind and its items are computed once too, whatever looks at them."""
    schema, seen = _resolved(schema, root, seen)
    return bound(F.schema_of_variant(v), lambda kind: _errors_of(v, kind, schema, path, root, seen))


def _errors_of(v: Column, kind: Column, schema: dict, path: Column, root: dict, seen: tuple[str, ...]) -> Column:
    none = F.array().cast("array<string>")
    said = lambda what: F.array(F.concat(F.lit("schema["), F.coalesce(F.nullif(path, F.lit("")), F.lit("(root)")), F.lit("]: "), what if isinstance(what, Column) else F.lit(what)))
    below = lambda name: F.concat(path, F.when(path == "", "").otherwise("/"), name)
    out = []

    def demand(holds: Column, what) -> None:
        out.append(F.when(holds, none).otherwise(said(what)))

    if "type" in schema:
        names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        fits = _is(v, kind, names[0])
        for n in names[1:]:
            fits = fits | _is(v, kind, n)
        demand(fits, f"is not of type {', '.join(names)}")
    values = schema.get("enum", [schema["const"]] if "const" in schema else None)
    if values is not None:
        written = F.coalesce(F.to_json(v), F.lit("null"))  # of a variant: canonical for scalars
        demand(written.isin([_json(x) for x in values]), f"is not one of {', '.join(map(_json, values))}")
    text = F.try_variant_get(v, "$", "string")
    for key, test, what in (("pattern", lambda p: text.rlike(p), "does not match {}"), ("minLength", lambda n: F.length(text) >= n, "is shorter than {}"), ("maxLength", lambda n: F.length(text) <= n, "is longer than {}")):
        if key in schema:
            demand((kind != "STRING") | test(schema[key]), what.format(schema[key]))
    number = F.try_variant_get(v, "$", "double")
    for key, test, what in (("minimum", lambda n: number >= n, "is less than {}"), ("maximum", lambda n: number <= n, "is greater than {}")):
        if key in schema:
            demand(~_is(v, kind, "number") | test(schema[key]), what.format(_json(schema[key])))
    place = lambda name: "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
    if "'" in "".join([*schema.get("required", []), *schema.get("properties", {})]):
        raise ValueError("a property with a quote in its name")
    for name in schema.get("required", []):
        demand(~kind.startswith("OBJECT") | F.try_variant_get(v, place(name), "variant").isNotNull(), f"{name} is required")
    if schema.get("additionalProperties") is False:
        names = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
        odd = F.array_sort(F.filter(names, lambda k: ~k.isin(list(schema.get("properties", {})) or [""])))
        more = F.when(kind.startswith("OBJECT"), odd)
        demand(F.coalesce(F.size(more), F.lit(0)) <= 0, F.concat(F.lit("has unknown properties "), F.array_join(more, ", ")))
    elif schema.get("additionalProperties", True) is not True:
        raise ValueError("additionalProperties is true or false")

    def child(name, sub):
        return lambda c: F.when(c.isNull(), none).otherwise(_errors(c, sub, below(F.lit(name)), root, seen))

    for name, sub in schema.get("properties", {}).items():
        out.append(F.when(kind.startswith("OBJECT"), bound(F.try_variant_get(v, place(name), "variant"), child(name, sub))).otherwise(none))
    if {"items", "minItems", "maxItems"} & set(schema):
        # What a list breaks itself stands before what stands under it, as do an object's own errors.
        own, out = out, []

        def listed(items):
            told = []
            for key, test, what in (("minItems", lambda n: F.size(items) >= n, "has fewer than {} items"), ("maxItems", lambda n: F.size(items) <= n, "has more than {} items")):
                if key in schema:
                    told.append(F.when(items.isNull() | test(schema[key]), none).otherwise(said(what.format(schema[key]))))
            if "items" in schema:
                each = F.transform(items, lambda x, i: _errors(x, schema["items"], below(i.cast("string")), root, seen))
                told.append(F.coalesce(F.flatten(each), none))
            return F.concat(*told)

        out = [*own, F.when(kind.startswith("ARRAY"), bound(F.try_variant_get(v, "$", "array<variant>"), listed)).otherwise(none)]
    return F.concat(*out) if out else none


def schema_errors(text: Column, schema: dict, most: int = 50) -> Column:
    """Errors of a document (JSON text) against a schema, each with the path to where it is: ``schema[a/0/b]: ..``; the first ``most``.

    What a place breaks itself comes before what stands under it, properties in the schema's order,
    items in theirs. A text that is no JSON has one error, a null one too.
    """
    def told(v):
        found = F.slice(_errors(v, schema, F.lit(""), schema, ()), 1, most)
        return F.when(v.isNull(), F.array(F.lit("schema[(root)]: is not JSON"))).otherwise(found)

    return bound(F.try_parse_json(text), told)
