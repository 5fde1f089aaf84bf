"""Each rule of a schema, broken and kept, over documents in one column."""

import json

from pyspark.sql import functions as F

from glycotide.operators.schema_rules import check_documents, violations

INSTANT = {"type": "string", "format": "date-time"}
SCHEMA = {
    "type": "object", "required": ["id", "items"], "additionalProperties": False,
    "properties": {
        "id": {"type": "string", "pattern": "^x_[0-9a-f]{4}$"}, "unit": {"enum": ["mg/dL", "mmol/L", None, 7, True]}, "version": {"const": "1.0"}, "count": {"type": "integer", "minimum": 1, "exclusiveMaximum": 10},
        "name": {"type": ["string", "null"], "minLength": 2, "maxLength": 4}, "share": {"type": "number", "exclusiveMinimum": 0, "maximum": 1}, "flag": {"type": "boolean"},
        "items": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"$ref": "#/$defs/item"}}, "window": {"anyOf": [{"$ref": "#/$defs/window"}, {"type": "object", "required": ["baseline"], "properties": {"baseline": {"$ref": "#/$defs/window"}}}]},
        "one": {"oneOf": [{"type": "number"}, {"type": "integer"}]}, "all": {"allOf": [{"type": "string"}, {"minLength": 3}]},
    },
    "$defs": {"item": {"type": "object", "required": ["at"], "properties": {"at": INSTANT, "tags": {"type": "array", "uniqueItems": True, "items": {"enum": ["a", "b"]}}}}, "window": {"type": "object", "required": ["start"], "properties": {"start": {"type": "number"}}, "additionalProperties": False}},
}
GOOD = {"id": "x_00ff", "items": [{"at": "2024-01-01T00:00:00Z", "tags": ["a", "b"]}]}
CASES = [
    ({}, []), ({"unit": None, "version": "1.0", "count": 5.0, "name": None, "share": 1, "flag": True, "one": 1.5, "all": "abc"}, []), ({"unit": 7}, []), ({"unit": True}, []), ({"window": {"start": 1}}, []), ({"window": {"baseline": {"start": 0.5}}}, []),
    ({"id": "y"}, ["$.id: pattern"]), ({"id": 3}, ["$.id: type"]), ({"unit": "g/l"}, ["$.unit: enum"]), ({"unit": "7"}, ["$.unit: enum"]), ({"version": "2"}, ["$.version: const"]), ({"count": 0}, ["$.count: minimum"]),
    ({"count": 10}, ["$.count: exclusiveMaximum"]), ({"count": 2.5}, ["$.count: type"]), ({"name": "a"}, ["$.name: minLength"]), ({"name": "abcde"}, ["$.name: maxLength"]), ({"share": 0}, ["$.share: exclusiveMinimum"]), ({"share": 2}, ["$.share: maximum"]),
    ({"flag": "true"}, ["$.flag: type"]), ({"items": []}, ["$.items: minItems"]), ({"items": GOOD["items"] * 4}, ["$.items: maxItems"]), ({"items": [{"at": "2024-01-01"}, {"tags": ["a", "a", "c"]}]}, ["$.items[].at: format", "$.items[].tags: uniqueItems", "$.items[].tags[]: enum", "$.items[]: required at"]),
    ({"items": {"at": 1}}, ["$.items: type"]), ({"more": 1, "yet": 2}, ["$: additional more", "$: additional yet"]), ({"window": {"start": "x"}}, ["$.window: anyOf"]), ({"window": {"start": 1, "end": 2}}, ["$.window: anyOf"]), ({"one": 1}, ["$.one: oneOf"]), ({"all": "ab"}, ["$.all: minLength"]),
]


def test_rules(spark):
    rows = [(n, json.dumps(GOOD | change)) for n, (change, _) in enumerate(CASES)] + [(-1, "{}"), (-2, "[]"), (-3, None)]
    df = spark.createDataFrame(rows, "n int, j string").select("n", violations(F.try_parse_json("j"), SCHEMA).alias("v"))
    got = {r.n: r.v for r in df.collect()}
    for n, (change, want) in enumerate(CASES):
        assert got[n] == sorted(want), change
    assert got[-1] == ["$: required id", "$: required items"] and got[-2] == ["$: type"] and got[-3] == []


def test_documents_of_a_folder(spark, tmp_path):
    for name, text in (("good", json.dumps(GOOD)), ("bad", json.dumps(GOOD | {"count": 0})), ("cut", "{")):
        (tmp_path / f"{name}.json").write_text(text)
    got = {r.file.rsplit("/", 1)[1]: r.violations for r in check_documents(spark, f"file://{tmp_path}", SCHEMA).collect()}
    assert got == {"bad.json": ["$.count: minimum"], "cut.json": ["$: not JSON"]}
