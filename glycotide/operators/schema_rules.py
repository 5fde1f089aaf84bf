"""A JSON schema as columns: what in a document breaks it, found by built-in expressions over a VARIANT.

The rules of draft 2020-12 that documents of this kind use: type, required, properties, additionalProperties: false, items, enum,
const, pattern, format date-time, minLength, maxLength, minimum, maximum, exclusiveMinimum, exclusiveMaximum, minItems, maxItems,
uniqueItems, anyOf, oneOf, allOf, and $ref to definitions of the schema itself. Other keywords are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glycotide.functions.columns import INSTANT

_NONE = "cast(array() AS array<string>)"
_NAMED = {"string": ("STRING",), "number": ("BIGINT", "DOUBLE", "FLOAT"), "integer": ("BIGINT",), "boolean": ("BOOLEAN",), "null": ("VOID",)}
_BEGUN = {"object": "OBJECT<", "array": "ARRAY<", "number": "DECIMAL("}


def violations(value: Column, schema: dict, root: dict | None = None, at: str = "$") -> Column:
    """The places and rules (``$.samples[].unit: enum``), sorted and each once, that a VARIANT breaks; nothing for a null column.

    A rule of a type says nothing of a value of another type.
    """
    found = _broken(value, schema, root or schema, at)
    return F.coalesce(F.array_sort(F.array_distinct(found)), F.expr(_NONE))


def breaking(rows: DataFrame, found: Column, out: str = "violations") -> DataFrame:
    """``rows`` whose ``found`` (as of ``violations``) isn't empty, with it as ``out``.

    A filter on a column of a projection repeats the column's expression, with all that it rests on. It doesn't get past a
    generator, so each document is parsed and each rule asked once; the generator reads a plain column, as it asks its
    input for its type at each row.
    """
    return rows.withColumn(out, F.array(found)).withColumn(out, F.explode_outer(out)).filter(F.size(out) > 0)


def _is_a(kind: Column, t: str) -> Column:
    named, begun = kind.isin(*_NAMED.get(t, ())), kind.startswith(_BEGUN.get(t, ""))
    return named | begun if t in _NAMED and t in _BEGUN else named if t in _NAMED else begun


def _once(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of an expression that is evaluated once, and stands in the plan once, whatever ``f`` asks of it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _broken(value: Column, schema: dict, root: dict, at: str) -> Column:
    if "$ref" in schema:
        target = root
        for part in schema["$ref"].removeprefix("#/").split("/"):
            target = target[part]
        schema = target | {k: v for k, v in schema.items() if k != "$ref"}
    typed = lambda v: F.struct(v.alias("v"), F.schema_of_variant(v).alias("kind"))
    found = lambda v: _once(typed(v), lambda x: _once(_views(x["v"], x["kind"], schema), lambda y: _rules(y, schema, root, at)))
    return _once(value, lambda v: F.when(v.isNull(), F.expr(_NONE)).otherwise(found(v)))


def _views(v: Column, kind: Column, schema: dict) -> Column:
    """A value, its kind, and what the rules of a schema read it as: each null where the value is of another type."""
    choices = schema.get("enum", [schema["const"]] if "const" in schema else [])
    views = [v.alias("v"), kind.alias("kind")]
    if {"pattern", "minLength", "maxLength", "format"} & schema.keys() or any(isinstance(c, str) for c in choices):
        views.append(F.when(_is_a(kind, "string"), F.try_variant_get(v, "$", "string")).alias("text"))
    if {"minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"} & schema.keys() or "integer" in schema.get("type", ()) or any(isinstance(c, (int, float)) for c in choices):
        views.append(F.when(_is_a(kind, "number"), F.try_variant_get(v, "$", "double")).alias("number"))
    if any(isinstance(c, bool) for c in choices):
        views.append(F.when(_is_a(kind, "boolean"), F.try_variant_get(v, "$", "boolean")).alias("truth"))
    if {"minItems", "maxItems", "uniqueItems", "items"} & schema.keys():
        views.append(F.when(_is_a(kind, "array"), F.try_variant_get(v, "$", "array<variant>")).alias("listed"))
    if {"required", "properties", "additionalProperties"} & schema.keys():
        views.append(F.when(_is_a(kind, "object"), v.try_cast("map<string,variant>")).alias("fields"))
    return F.struct(*views)


def _rules(x: Column, schema: dict, root: dict, at: str) -> Column:
    """What the ``_views`` of a value break of one schema and of those within it."""
    is_a = lambda t: _is_a(x["kind"], t)
    rules: list[tuple[str, Column]] = []
    if "type" in schema:
        allowed = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        fits = is_a(allowed[0])
        for t in allowed[1:]:
            fits = fits | is_a(t)
        if "integer" in allowed:  # 5.0 is an integer
            fits = fits | F.coalesce(x["number"] == F.rint(x["number"]), F.lit(False))
        rules.append(("type", ~fits))
    choices = schema.get("enum", [schema["const"]] if "const" in schema else None)
    if choices is not None:
        any_ = F.lit(False)
        if None in choices:
            any_ = any_ | is_a("null")
        for view, of_type in (("text", lambda c: isinstance(c, str)), ("truth", lambda c: isinstance(c, bool)), ("number", lambda c: isinstance(c, (int, float)) and not isinstance(c, bool))):
            if same := [float(c) if view == "number" else c for c in choices if of_type(c)]:
                any_ = any_ | F.coalesce(x[view].isin(*same), F.lit(False))
        rules.append(("enum" if "enum" in schema else "const", ~any_))
    for rule, bad in (
        ("pattern", lambda v: ~x["text"].rlike(v)), ("minLength", lambda v: F.length(x["text"]) < v), ("maxLength", lambda v: F.length(x["text"]) > v), ("format", lambda v: ~x["text"].rlike(INSTANT) if v == "date-time" else F.lit(False)),
    ):
        if rule in schema:
            rules.append((rule, bad(schema[rule])))
    for rule, bad in (("minimum", lambda v: x["number"] < v), ("maximum", lambda v: x["number"] > v), ("exclusiveMinimum", lambda v: x["number"] <= v), ("exclusiveMaximum", lambda v: x["number"] >= v)):
        if rule in schema:
            rules.append((rule, bad(float(schema[rule]))))
    if {"minItems", "maxItems"} & schema.keys():
        rules += [(r, F.size(x["listed"]) < schema[r] if r == "minItems" else F.size(x["listed"]) > schema[r]) for r in ("minItems", "maxItems") if r in schema]
    if schema.get("uniqueItems"):
        rules.append(("uniqueItems", F.size(F.array_distinct(F.transform(x["listed"], lambda y: F.to_json(y)))) < F.size(x["listed"])))
    parts = []
    if {"required", "properties", "additionalProperties"} & schema.keys():
        fields = x["fields"]
        rules += [(f"required {name}", ~F.map_contains_key(fields, name)) for name in schema.get("required", ())]
        if schema.get("additionalProperties") is False:
            more = F.array_except(F.map_keys(fields), F.array(F.lit(""), *map(F.lit, schema.get("properties", {}))))
            parts.append(F.transform(more, lambda k: F.concat(F.lit(f"{at}: additional "), k)))
        parts += [_broken(F.try_element_at(fields, F.lit(name)), sub, root, f"{at}.{name}") for name, sub in schema.get("properties", {}).items()]
    if "items" in schema:
        parts.append(F.flatten(F.transform(x["listed"], lambda y: _broken(y, schema["items"], root, f"{at}[]"))))
    parts += [_broken(x["v"], sub, root, at) for sub in schema.get("allOf", ())]
    for rule in ("anyOf", "oneOf"):
        if rule in schema:
            fitting = sum((F.when(F.size(_broken(x["v"], sub, root, at)) == 0, 1).otherwise(0) for sub in schema[rule]), F.lit(0))
            rules.append((rule, fitting == 0 if rule == "anyOf" else fitting != 1))
    own = F.array_compact(F.array(*[F.when(bad, F.lit(f"{at}: {rule}")) for rule, bad in rules])) if rules else F.expr(_NONE)
    return F.concat(own, *[F.coalesce(p, F.expr(_NONE)) for p in parts]) if parts else own


def read_schema(spark: SparkSession, path: str) -> dict:
    """A schema document, from any store that Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def check_documents(spark: SparkSession, path: str | list[str], schema: dict) -> DataFrame:
    """file, violations of each document that breaks the schema, or is no JSON (``$: not JSON``)."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v"))
    found = F.when(F.col("v").isNull(), F.array(F.lit("$: not JSON"))).otherwise(violations(F.col("v"), schema))
    return breaking(texts, found).select("file", "violations")
