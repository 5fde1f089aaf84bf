"""JSON documents as flat tables that lose nothing, and back.

A document is parsed to a VARIANT. Fields that are known, and of their type, become columns; everything else (unknown fields,
known ones of another type, explicit nulls, and the originals of nested objects) stays in a map from name to VARIANT, from
which the same document can be written again. A bare list of elements is taken like a document that has just them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EMPTY = "cast(map() AS map<string,variant>)"
WINDOW = "struct<relative_to:string,start_offset_minutes:double,end_offset_minutes:double>"
COMPONENTS = "array<struct<name:string,value:double,unit:string>>"
_SCALARS = {"string": "^STRING$", "double": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "bigint": "^BIGINT$", "boolean": "^BOOLEAN$"}


@dataclass(frozen=True)
class Kind:
    """The array of elements (None: a document is one element), and the known fields of header and elements with their types."""

    array: str | None
    header: dict[str, str]
    item: dict[str, str]


def _of(kind: str, names: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), kind)


KINDS = {
    "series": Kind("samples", _of("string", "schema_version series_id subject_id device_id sensor_id time_zone unit notes") | _of("double", "sampling_interval_minutes"), {"timestamp": "string", "glucose_value": "double", "sample_index": "bigint", "quality_flags": "array<string>"}),
    "events": Kind(
        "events", _of("string", "schema_version events_id subject_id time_zone notes"),
        _of("string", "event_id event_type start_time end_time source label notes") | _of("double", "duration_minutes annotation_quality") | {"exposure_components": COMPONENTS},
    ),
    "metrics": Kind(
        "metrics", _of("string", "metric_set_id subject_id time_zone series_id generated_at"),
        _of("string", "event_id metric_name metric_version unit computed_at method") | _of("double", "value coverage_ratio") | {"window": WINDOW, "window_bundle": f"map<string,{WINDOW}>", "quality_flags": "array<string>", "quality_summary": "map<string,variant>"},
    ),
    "signals": Kind("events", _of("string", "schema_version signal_set_id subject_id time_zone series_id generated_at") | _of("double", "coverage_soft history_size min_history"), _of("string", "event_id status") | _of("double", "coverage_ratio") | {"metric_values": "map<string,double>"}),
    "question": Kind(None, {}, _of("string", "question_id subject_id time_zone") | {"exposure": "map<string,variant>", "comparison": "map<string,variant>", "outcome": "map<string,variant>", "condition": "array<map<string,variant>>", "time_span": "map<string,string>", "assumptions": "array<string>"}),
    "answer": Kind(None, {}, _of("string", "question_id metric_name") | _of("boolean", "answerable") | {"reasons": "array<map<string,variant>>", "data_requirements": "array<map<string,variant>>"}),
}
#: Fields that are read from another one's place.
_FROM = {"window_bundle": "window"}


def _typed(value: str, fields: dict[str, str]) -> dict[str, Column]:
    out = {}
    for name, kind in fields.items():
        path = f"'$.{_FROM.get(name, name)}'"
        got = F.expr(f"try_variant_get({value}, {path}, '{kind}')")
        if kind in _SCALARS:  # a number in quotes is no number
            got = F.when(F.expr(f"schema_of_variant(try_variant_get({value}, {path}, 'variant'))").rlike(_SCALARS[kind]), got)
        elif name == "window":
            got = F.when(F.expr(f"try_variant_get({value}, '$.window.relative_to', 'string')").isNotNull(), got)
        elif name in _FROM:
            got = F.when(F.expr(f"try_variant_get({value}, '$.window.relative_to', 'string')").isNull(), got)
        out[name] = got
    return out


def _extra(whole: str, fields: dict[str, str]) -> Column:
    """Of a map of an object's fields, those that the columns of the same names don't tell in full."""
    told = F.array_compact(F.array(F.lit(""), *[F.when(F.col(f"`{n}`").isNotNull(), F.lit(n)) for n, kind in fields.items() if kind in _SCALARS or kind == "array<string>"]))
    return F.map_filter(whole, lambda k, _: ~F.array_contains(told, k))


def read(spark: SparkSession, path: str | list[str], kind: str) -> tuple[DataFrame, DataFrame]:
    """A row per element: file, ``doc`` (a struct of header fields and their ``extra``; null for a bare list), pos, the fields, ``extra``.

    And (file, message) of files that are no such document. A document with an empty array has no rows.
    """
    return parse(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value"), kind)


def parse(texts: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """``read`` for documents that are in a table: file, value."""
    about = KINDS[kind]
    texts = texts.select("file", F.try_parse_json("value").alias("_v"))
    texts = texts.withColumn("_whole", F.expr("try_cast(_v AS map<string,variant>)"))
    if about.array:
        listed = F.coalesce(F.expr(f"try_variant_get(_v, '$.{about.array}', 'array<variant>')"), F.expr("try_variant_get(_v, '$', 'array<variant>')"))
    else:
        listed = F.when(F.col("_whole").isNotNull(), F.array("_v"))
    docs = texts.withColumn("_items", listed)
    docs = docs.withColumn("_objects", F.transform("_items", lambda e: e.try_cast("map<string,variant>")))
    bad = F.when(F.col("_v").isNull(), "not JSON").when(F.col("_items").isNull(), f"no {about.array}" if about.array else "not an object").when(F.exists("_objects", lambda o: o.isNull()), f"an element of {about.array} is no object")
    docs = docs.withColumn("_bad", bad)
    problems = docs.filter("_bad is not null").select("file", F.col("_bad").alias("message"))
    header = docs.filter("_bad is null").select("file", "_whole", "_items", *[c.alias(n) for n, c in _typed("_v", about.header).items()])
    rest = F.map_filter(_extra("_whole", about.header), lambda k, _: k != (about.array or ""))
    header = header.withColumn("extra", rest)
    doc = F.when(F.col("_whole").isNotNull(), F.struct(*about.header, "extra")).alias("doc")
    rows = header.select("file", doc, F.posexplode("_items").alias("pos", "_e"))
    items = rows.select("file", "doc", F.col("pos").cast("long").alias("pos"), F.expr("try_cast(_e AS map<string,variant>)").alias("_fields"), *[c.alias(n) for n, c in _typed("_e", about.item).items()])
    return items.withColumn("extra", _extra("_fields", about.item)).drop("_fields"), problems


def object_of(kind: str, extra: Column | None = None, named: dict[str, str] | None = None) -> Column:
    """An element as a map from field to VARIANT, from columns of its fields' names (``named``: of others) and ``extra``."""
    return _object(KINDS[kind].item, F.expr(EMPTY) if extra is None else extra, "", named)


def _object(fields: dict[str, str], extra: Column, at: str = "", named: dict[str, str] | None = None) -> Column:
    """An object's fields as a map: the columns (those of struct ``at``) that are there, and ``extra``, which goes before them."""
    entries = []
    for name, kind in fields.items():
        if name in _FROM:
            continue
        c = F.col(f"{at}`{(named or {}).get(name, name)}`")
        if name == "window":
            c = F.coalesce(F.to_variant_object(c), F.to_variant_object(F.col("window_bundle")))
        elif kind in _SCALARS or kind == "array<string>":
            c = c.cast("variant")
        elif "variant" not in kind:
            c = F.to_variant_object(c)
        else:
            continue  # an original is in ``extra``
        entries += [F.lit(name), c]
    extra = F.coalesce(extra, F.expr(EMPTY))
    if not entries:
        return extra
    known = F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull() & ~F.map_contains_key(extra, k))
    return F.map_concat(known, extra)


def documents(rows: DataFrame, kind: str) -> DataFrame:
    """file, value: the JSON text of each file's document again, a bare list as one. ``rows`` are as ``read`` gives them.

    Columns may have been changed; what ``extra`` has goes before, so a changed nested object must leave it.
    """
    about = KINDS[kind]
    if not about.array:
        return rows.select("file", F.to_json(_object(about.item, F.col("extra"))).alias("value"))
    each = rows.select("file", "doc", F.struct("pos", _object(about.item, F.col("extra")).alias("o")).alias("e"))
    by_place = lambda a, b: F.when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0)
    whole = each.groupBy("file").agg(F.first("doc").alias("doc"), F.array_sort(F.collect_list("e"), by_place).alias("items"))
    items = F.to_json(F.transform("items", lambda e: e["o"]))
    head = F.to_json(_object(about.header, F.col("doc.extra"), "doc."))
    comma = F.when(head == "{}", "").otherwise(",")
    inside = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), comma, F.lit(f'"{about.array}":'), items, F.lit("}"))
    return whole.select("file", F.when(F.col("doc").isNull(), items).otherwise(inside).alias("value"))
