"""Annotations (events that a person reports): construction, diary text, identity and warnings.

A flat annotation has event_id, subject_id, event_type, start_time and end_time (instants), their ISO texts
(start_time_raw, end_time_raw), duration_minutes, exposure_components, source, annotation_quality, label, notes and pos.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glycotide.functions.columns import flags_of, half_even, micros, minutes, parse_instant

SOURCES = ("manual", "app", "import", "api", "other")
TAGS_PREFIX = "Context tags: "
# The words that tags usually are, by kind; others are taken, too.
CONTEXT_TAGS = {
    "time_of_day": ("breakfast", "lunch", "dinner", "snack", "late_night"),
    "activity_context": ("post_exercise", "pre_exercise", "sedentary", "active"),
    "meal_context": ("home_cooked", "restaurant", "takeout", "packaged"),
    "special_contexts": ("illness", "stress", "travel", "celebration"),
}

# The warnings' texts, in order.
LOW_QUALITY = "Low annotation quality (<0.5). This event may be unreliable for analysis."
NO_COMPONENTS = "No exposure components (e.g., carbs) provided. Analysis may be limited without dose information."
SHORT = "Very short event (<5 min). May not represent a complete exposure."
MANUAL = "Manual entry source. Consider validating with app/import data when possible."
NO_CONTEXT = "No context tags provided. Context (time, setting, activity) improves analysis."


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(c) == "")


def comma_list(text: Column) -> Column:
    """The trimmed, non-empty parts of a text between commas."""
    return F.filter(F.transform(F.split(text, ","), lambda t: F.trim(t)), lambda x: x != "")


def with_context_tags(notes: Column, tags: Column) -> Column:
    """``notes`` and, on a line of its own, the tags in lower case with ``_`` for blanks; no tags: notes as they are."""
    names = F.array_join(F.transform(tags, lambda t: F.replace(F.lower(t), F.lit(" "), F.lit("_"))), ", ")
    line = F.concat(F.lit(TAGS_PREFIX), names)
    return F.when(F.coalesce(F.size(tags), F.lit(0)) > 0, F.concat_ws("\n", notes, line)).otherwise(notes)


def create(raw: DataFrame, *keys: str) -> DataFrame:
    """Annotations (and their ``keys``) from columns subject_id, event_type, start_time_raw, and, if there, end_time_raw, label, carbs, tags, notes, source, annotation_quality, pos.

    Every row stays; ``violations`` names what is wrong with it (an empty array: nothing). Ids are digests of keys,
    subject, start, label and pos, so a rerun gives the same ones. Quality is 0.8 and source ``manual`` where the column is
    absent; a null in a column that is there counts as absent, too.
    """
    absent = {"end_time_raw": "string", "label": "string", "carbs": "double", "tags": "array<string>", "notes": "string", "source": "string", "annotation_quality": "double", "pos": "long"}
    rows = raw.withColumns({c: F.lit(None).cast(t) for c, t in absent.items() if c not in raw.columns})
    rows = rows.withColumns({"source": F.coalesce("source", F.lit("manual")), "annotation_quality": F.coalesce("annotation_quality", F.lit(0.8))})
    start, end = parse_instant(F.col("start_time_raw")), parse_instant(F.col("end_time_raw"))
    rows = rows.withColumns({"start_time": start, "end_time": end})
    wrong = flags_of(
        ("no_subject", _blank("subject_id")),
        ("no_event_type", _blank("event_type")),
        ("start_time_without_offset", F.col("start_time").isNull()),
        ("end_time_without_offset", F.col("end_time_raw").isNotNull() & F.col("end_time").isNull()),
        ("end_time_not_after_start", F.col("end_time") <= F.col("start_time")),
        ("quality_out_of_range", (F.col("annotation_quality") < 0) | (F.col("annotation_quality") > 1)),
        ("unknown_source", ~F.col("source").isin(*SOURCES)),
        ("negative_carbs", F.col("carbs") < 0),
    )
    trimmed = lambda c: F.nullif(F.trim(c), F.lit(""))
    component = F.struct(F.lit("carbohydrate").alias("name"), F.col("carbs").cast("double").alias("value"), F.lit("g").alias("unit"))
    identity = F.concat_ws("|", *keys, "subject_id", "start_time_raw", F.coalesce("label", F.lit("")), F.coalesce(F.col("pos").cast("string"), F.lit("")))
    return rows.select(
        *keys, F.concat(F.lit("evt_"), F.substring(F.sha2(identity, 256), 1, 12)).alias("event_id"), "subject_id", "event_type", "start_time", "start_time_raw", "end_time", "end_time_raw",
        half_even(minutes(micros("end_time") - micros("start_time")), 2).alias("duration_minutes"), F.when(F.col("carbs").isNotNull(), F.array(component)).alias("exposure_components"),
        "source", half_even(F.col("annotation_quality"), 2).alias("annotation_quality"), trimmed("label").alias("label"),
        with_context_tags(trimmed("notes"), F.col("tags")).alias("notes"), "pos", wrong.alias("violations"),
    )


def require_valid(events: DataFrame) -> DataFrame:
    """``events`` without ``violations``; a row that has any fails the job."""
    ok = F.size("violations") == 0
    text = F.concat(F.lit("invalid event: "), F.array_join("violations", ", "))
    return events.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))).drop("violations")


def parse_diary(lines: DataFrame, line_no: str = "line_no", line: str = "value", *keys: str) -> DataFrame:
    """keys, line_no, local_start, label, problem of the lines ``YYYY-MM-DD HH:MM label`` of diaries.

    Empty lines and those that begin with # are skipped. Days, months, hours and minutes may have one digit. A line of
    fewer than three parts, or without a time, has a ``problem`` text with its number.
    """
    text = F.trim(F.regexp_replace(F.col(line), r"^\s+|\s+$", ""))
    rows = lines.select(*keys, F.col(line_no).alias("line_no"), text.alias("_text")).filter((F.col("_text") != "") & ~F.col("_text").startswith("#"))
    rows = rows.withColumn("_parts", F.split("_text", r"\s+", 3))
    stamp = F.concat_ws(" ", F.element_at("_parts", 1), F.try_element_at("_parts", F.lit(2)))
    local = F.when(stamp.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$"), F.to_timestamp_ntz(_padded(stamp)))
    label = F.trim(F.try_element_at("_parts", F.lit(3)))
    problem = F.when(F.size("_parts") < 3, F.format_string("line %d: expected date, time and label", "line_no")).when(local.isNull(), F.format_string("line %d: not a date and time", "line_no"))
    return rows.select(*keys, "line_no", local.alias("local_start"), label.alias("label"), problem.alias("problem"))


def _padded(stamp: Column) -> Column:
    """``2026-1-2 3:4`` as ``2026-01-02 03:04``; null where that is no time."""
    number = lambda k: F.lpad(F.regexp_extract(stamp, r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2})$", k), 2, "0")
    text = F.concat(F.substring(stamp, 1, 4), F.lit("-"), number(2), F.lit("-"), number(3), F.lit(" "), number(4), F.lit(":"), number(5), F.lit(":00"))
    return F.when(F.try_to_timestamp(text).isNotNull(), text)


def require_parsed(diary: DataFrame) -> DataFrame:
    """``diary`` without ``problem``; a line that has one fails the job with its text."""
    return diary.filter(F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(F.col("problem")).cast("boolean"))).drop("problem")


def merge_same_time(diary: DataFrame, *keys: str) -> DataFrame:
    """keys, local_start, label, first_line: lines of one time are one entry, labels joined by `` / `` in line order."""
    listed = F.array_sort(F.collect_list(F.struct("line_no", "label")))
    return diary.groupBy(*keys, "local_start").agg(F.array_join(F.transform(listed, lambda x: x["label"]), " / ").alias("label"), F.min("line_no").alias("first_line"))


def collection_ids(events: DataFrame, *keys: str, time_zone: Column) -> DataFrame:
    """keys (subject_id among them), events_id: a digest of the subject, the zone and the sorted ids; order plays no part."""
    ids = F.array_join(F.array_sort(F.collect_list("event_id")), ",")
    whole = F.concat_ws("_", F.first("subject_id"), F.first(time_zone), ids)
    return events.groupBy(*keys).agg(F.concat(F.lit("evts_"), F.substring(F.sha2(whole, 256), 1, 16)).alias("events_id"))


def warnings() -> Column:
    """The texts of what may limit an event's use, in a fixed order. A missing duration counts as 0, a missing quality as 1."""
    rules = [
        (F.coalesce("annotation_quality", F.lit(1.0)) < 0.5, LOW_QUALITY),
        (F.coalesce(F.size("exposure_components"), F.lit(0)) <= 0, NO_COMPONENTS),
        (F.coalesce("duration_minutes", F.lit(0.0)) < 5, SHORT),
        (F.coalesce(F.col("source") == "manual", F.lit(False)), MANUAL),
        (~F.coalesce(F.contains(F.lower("notes"), F.lit("context")), F.lit(False)), NO_CONTEXT),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(t)) for c, t in rules]))


def context_tags(notes: Column) -> Column:
    """The tags in notes: what follows the first ``Context tags:``, split at commas, trimmed, lower case; none: empty."""
    after = F.substring(notes, F.locate("Context tags:", notes) + F.lit(len("Context tags:")), F.length(notes))
    tags = F.filter(F.transform(F.split(after, ","), lambda t: F.lower(F.trim(t))), lambda t: t != "")
    return F.when(F.coalesce(F.contains(notes, F.lit("Context tags:")), F.lit(False)), tags).otherwise(F.array().cast("array<string>"))


def appended(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both, for annotations of one subject and zone: a subject_id or time_zone of ``new`` that ``existing`` lacks is an error."""
    for c in ("subject_id", "time_zone"):
        if c in existing.columns and c in new.columns:
            other = new.select(c).distinct().join(existing.select(c).distinct(), c, "left_anti")
            if existing.head(1) and other.head(1):
                raise ValueError(f"{c} of the new events does not match")
    return existing.unionByName(new, allowMissingColumns=True)
