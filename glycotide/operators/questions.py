"""Whether data can answer a comparison question: matching, confounding, usable events, reasons and what to collect.

A question is a document (a dict): it is compiled to columns, and one row comes out. Events are flat annotations, metrics
the long table; neither is collected. Matched ids stay lists in the result, as in the document that is written.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glycotide.config import AnswerConfig
from glycotide.functions.columns import MICROS_PER_MINUTE, micros, parse_instant
from glycotide.operators.predicates import definition
from glycotide.operators.range_join import longest_of, overlapping_intervals

# The codes, kinds and texts of reasons and requirements in this module are part of the results.
GROUPS = ("exposure", "comparison")
BUNDLE_PART = {"delta_peak": "peak_window", "iAUC": "auc_window", "recovery_slope": "recovery_window"}
LABELS = ("confounded", "missing_metric", "window_mismatch", "low_quality_metric", "usable")
REASON = "struct<code:string,detail:string,blocking:boolean,affected_event_ids:array<string>,observed:bigint,required:bigint>"
REQUIREMENT = "struct<type:string,group:string,detail:string,needed_count:bigint,event_ids:array<string>,selector:variant>"


def in_span(span: dict | None) -> Column:
    """Starts within the span, both ends included; always true unless both are given."""
    if not span or not span.get("start_time") or not span.get("end_time"):
        return F.lit(True)
    return F.col("start_time").between(parse_instant(F.lit(span["start_time"])), parse_instant(F.lit(span["end_time"])))


def with_bounds(events: DataFrame, config: AnswerConfig = AnswerConfig()) -> DataFrame:
    """With start_us and stop_us (the end, or half an hour after the start)."""
    start = micros("start_time")
    return events.withColumns({"start_us": start, "stop_us": F.coalesce(micros("end_time"), start + F.lit(int(config.default_duration_minutes * MICROS_PER_MINUTE)))})


def confounded(events: DataFrame, *keys: str, config: AnswerConfig = AnswerConfig()) -> DataFrame:
    """keys, event_id of events that another one (any type, another id) is within the isolation minutes of; equality counts."""
    pad = F.lit(int(config.min_isolation_minutes * MICROS_PER_MINUTE))
    rows = events.select(*keys, "event_id", "start_us", "stop_us")
    longest = longest_of(rows, F.col("start_us"), F.col("stop_us")) / MICROS_PER_MINUTE + 2 * config.min_isolation_minutes
    return overlapping_intervals(rows, rows, keys, (F.col("start_us") - pad, F.col("stop_us") + pad), (F.col("start_us"), F.col("stop_us")), semi_on=("event_id", "event_id"), longest_minutes=longest)


def window_matches(window: dict, name: str, config: AnswerConfig = AnswerConfig()) -> Column:
    """A single window equal in all three fields; a bundle matches only if the configuration maps it to one of its parts."""

    def same(w: Column) -> Column:
        return (w["relative_to"] == window.get("relative_to")) & (w["start_offset_minutes"] == float(window["start_offset_minutes"])) & (w["end_offset_minutes"] == float(window["end_offset_minutes"]))

    ok = F.coalesce(same(F.col("window")), F.lit(False))
    if config.match_bundle_outcome_window and name in BUNDLE_PART:
        ok = ok | F.coalesce(same(F.try_element_at("window_bundle", F.lit(BUNDLE_PART[name]))), F.lit(False))
    return ok


def labelled(matches: DataFrame, metrics: DataFrame, confounded_ids: DataFrame, outcome: dict, *keys: str, config: AnswerConfig = AnswerConfig()) -> DataFrame:
    """``matches`` with ``label``: the first that holds of confounded, missing_metric, window_mismatch, low_quality_metric, usable.

    An event's metric is its first, by pos, of the outcome's name whose window matches. Where metrics have the ``keys``,
    they are joined by them, too: an id may stand for an event of each of several keys.
    """
    name, window = outcome["metric_name"], outcome.get("window")
    fits = window_matches(window, name, config) if window else F.lit(True)
    coverage = F.coalesce("coverage_ratio", F.col("quality_summary.coverage_percentage") / 100.0, F.lit(1.0))
    by = [*[k for k in keys if k in metrics.columns], "event_id"]
    first = metrics.filter(F.col("metric_name") == name).groupBy(*by).agg(F.min_by(F.when(fits, coverage), F.when(fits, F.col("pos"))).alias("metric_coverage"), F.bool_or(fits).alias("fits"))
    out = matches.join(confounded_ids.select(*keys, "event_id", F.lit(True).alias("near")), [*keys, "event_id"], "left").join(first, by, "left")
    label = (
        F.when(F.col("near"), "confounded").when(F.col("fits").isNull(), "missing_metric").when(~F.col("fits"), "window_mismatch")
        .when(F.col("metric_coverage") < config.min_metric_coverage, "low_quality_metric").otherwise("usable")
    )
    return out.withColumn("label", label).drop("near", "fits", "metric_coverage")


def _ids(condition: Column) -> Column:
    """The ids of rows where ``condition`` holds, in the order of their pos."""
    return F.transform(F.array_sort(F.collect_list(F.when(condition, F.struct("pos", "event_id")))), lambda x: x["event_id"])


def group_stats(labels: DataFrame, *keys: str) -> DataFrame:
    """keys, and of each group the ids it matched and those of each label, in order."""
    aggs = []
    for g in GROUPS:
        mine = F.col("group") == g
        aggs.append(F.struct(_ids(mine).alias("matched"), *[_ids(mine & (F.col("label") == x)).alias(x) for x in LABELS]).alias(g))
    return labels.groupBy(*keys).agg(*aggs)


def _reason(code: str, detail: Column, blocking: Column, ids: Column | None = None, observed: Column | None = None, required: int | None = None) -> Column:
    null = lambda x, t: (F.lit(None) if x is None else x).cast(t)
    return F.struct(
        F.lit(code).alias("code"), detail.alias("detail"), blocking.alias("blocking"), null(ids, "array<string>").alias("affected_event_ids"), null(observed, "bigint").alias("observed"), F.lit(required).cast("bigint").alias("required")
    ).cast(REASON)


def reasons(group: str, metric: str, config: AnswerConfig = AnswerConfig()) -> Column:
    """What stands against a group: nothing matched, or each kind of lost event, and too few usable ones."""
    ids = lambda x: F.col(f"{group}.{x}")
    some = lambda x: F.size(ids(x)) > 0
    usable, least = F.size(ids("usable")), config.min_events_per_group
    short, name = usable < least, group.capitalize()
    rules = [
        ("confounded", "confounded_context", f"{name} events are too close to other events."),
        ("window_mismatch", "metric_window_mismatch", f"Metrics for {group} events do not match the requested window."),
        ("missing_metric", "missing_baseline" if metric == "baseline_glucose" else "missing_metric", f"Missing metric for {group} events."),
        ("low_quality_metric", "low_metric_coverage", f"Low metric coverage for {group} events."),
    ]
    found = [F.when(some(x), _reason(code, F.lit(text), short, ids(x))) for x, code, text in rules]
    too_few = F.format_string(f"Need at least {least} usable {group} events, found %d.", usable)
    found.append(F.when(short, _reason(f"insufficient_repeats_{group}", too_few, F.lit(True), None, usable, least)))
    none = _reason(f"no_matching_{group}_events", F.lit(f"No events match the {group} selector within the time span."), F.lit(True))
    return F.when(~some("matched"), F.array(none)).otherwise(F.array_compact(F.array(*found)))


def requirements(group: str, config: AnswerConfig = AnswerConfig(), selector: dict | None = None) -> Column:
    """What to collect or compute for a group; what to collect names the group's ``selector``."""
    ids = lambda x: F.col(f"{group}.{x}")
    least = config.min_events_per_group
    missing = F.greatest(F.lit(least) - F.size(ids("usable")), F.lit(0))

    wanted = F.lit(None).cast("variant") if selector is None else F.parse_json(F.lit(json.dumps(selector)))

    def need(kind: str, detail: Column | str, count: Column | None = None, events: Column | None = None) -> Column:
        text = F.lit(detail) if isinstance(detail, str) else detail
        null = lambda x, t: (F.lit(None) if x is None else x).cast(t)
        return F.struct(F.lit(kind).alias("type"), F.lit(group).alias("group"), text.alias("detail"), null(count, "bigint").alias("needed_count"), null(events, "array<string>").alias("event_ids"), (wanted if kind == "collect_events" else F.lit(None).cast("variant")).alias("selector")).cast(REQUIREMENT)

    rules = [
        ("missing_metric", "compute_metrics", "Compute outcome metrics for events missing metrics or improve CGM coverage."),
        ("low_quality_metric", "improve_cgm_coverage", "Increase CGM coverage in the outcome window for low-coverage events."),
        ("window_mismatch", "recompute_metrics", "Recompute metrics using the question's outcome window."),
        ("confounded", "collect_isolated_events", f"Add {group} events isolated by at least {config.min_isolation_minutes:g} minutes."),
    ]
    found = [F.when(missing > 0, need("collect_events", F.format_string(f"Collect at least %d more usable {group} events.", missing), missing))]
    found += [F.when(F.size(ids(x)) > 0, need(kind, text, None, ids(x))) for x, kind, text in rules]
    none = need("collect_events", f"Add events that match the {group} selector.", F.lit(least))
    return F.when(F.size(ids("matched")) == 0, F.array(none)).otherwise(F.array_compact(F.array(*found)))


def matches(question: dict, events: DataFrame) -> DataFrame:
    """``events`` in the question's span that a group matches, with ``group``: one row per event and group."""
    conditions = question.get("condition") or []
    names = F.array_compact(F.array(*[F.when(definition(question[g], conditions), F.lit(g)) for g in GROUPS]))
    return events.filter(in_span(question.get("time_span"))).withColumn("group", F.explode(names))


def answerability(question: dict, events: DataFrame, metrics: DataFrame, *keys: str, config: AnswerConfig = AnswerConfig()) -> DataFrame:
    """One row per value of ``keys`` (none: one row): answerable, reasons, data_requirements and the ids of each group.

    Confounding is among the events of the span, of any type. Events or metrics of another subject than the question's
    block; events that both groups match block, too. With keys, each subject with an event in the span gets an answer.
    """
    rows = with_bounds(events, config)
    spanned = rows.filter(in_span(question.get("time_span")))
    near = confounded(spanned, *keys, config=config)
    labels = labelled(matches(question, rows), metrics, near, question["outcome"], *keys, config=config)
    if keys:
        stats = spanned.select(*keys).distinct().join(group_stats(labels, *keys), list(keys), "left")
        near_ids = near.groupBy(*keys).agg(F.array_sort(F.collect_set("event_id")).alias("confounded_event_ids"))
        stats = stats.join(near_ids, list(keys), "left")
        strangers = F.array().cast(f"array<{REASON}>")
        for name, table in (("Events", rows), ("Metrics", metrics)):
            if question.get("subject_id") and {"subject_id", *keys} <= set(table.columns):
                other = table.filter(F.col("subject_id") != question["subject_id"]).groupBy(*keys).agg(F.min("subject_id").alias("_other"))
                stats = stats.join(other, list(keys), "left").withColumn("strangers", F.when(F.col("_other").isNotNull(), F.array(_stranger(name, F.col("_other"), question))))
                stats = stats.withColumnRenamed("strangers", f"_strangers_{name}").drop("_other")
                strangers = F.concat(strangers, F.coalesce(f"_strangers_{name}", F.array().cast(f"array<{REASON}>")))
    else:
        ids = near.agg(F.array_sort(F.collect_set("event_id")).alias("confounded_event_ids"))
        stats = group_stats(labels).join(ids, F.lit(True), "inner")  # two single rows
        strangers = _strangers(question, events, metrics)
    empty = F.array().cast("array<string>")
    stats = stats.withColumns({g: F.struct(*[F.coalesce(F.col(f"{g}.{x}"), empty).alias(x) for x in ("matched", *LABELS)]) for g in GROUPS})
    stats = stats.withColumns({"confounded_event_ids": F.coalesce("confounded_event_ids", empty), "overlap_event_ids": F.array_sort(F.array_intersect("exposure.matched", "comparison.matched"))})
    both = F.size("overlap_event_ids") > 0
    metric = question["outcome"]["metric_name"]
    same = F.when(both, F.array(_reason("ambiguous_event_definition", F.lit("Exposure and comparison selectors match the same events."), F.lit(True), F.col("overlap_event_ids")))).otherwise(F.array().cast(f"array<{REASON}>"))
    refine = F.struct(F.lit("refine_definitions").alias("type"), F.lit(None).cast("string").alias("group"), F.lit("Refine exposure/comparison selectors to avoid overlapping events.").alias("detail"), F.lit(None).cast("bigint").alias("needed_count"), F.col("overlap_event_ids").alias("event_ids"), F.lit(None).cast("variant").alias("selector")).cast(REQUIREMENT)
    needs = F.concat(*[requirements(g, config, question[g].get("selector")) for g in GROUPS], F.when(both, F.array(refine)).otherwise(F.array().cast(f"array<{REQUIREMENT}>")))
    out = stats.withColumns({"reasons": F.concat(strangers, same, *[reasons(g, metric, config) for g in GROUPS]), "data_requirements": needs})
    return out.select(
        *keys, F.lit(question.get("question_id", "unknown")).alias("question_id"), F.lit(metric).alias("metric_name"), (~F.exists("reasons", lambda r: r["blocking"])).alias("answerable"),
        "reasons", "data_requirements", *GROUPS, "confounded_event_ids", "overlap_event_ids",
    )


def _stranger(name: str, subject: Column, question: dict) -> Column:
    text = F.concat(F.lit(f"{name} subject_id "), subject.cast("string"), F.lit(f" does not match question subject_id {question['subject_id']}."))
    return _reason("subject_id_mismatch", text, F.lit(True))


def _strangers(question: dict, events: DataFrame, metrics: DataFrame) -> Column:
    """Reasons for tables of another subject than the question's: each table has one subject, whose id comes to the driver."""
    found = []
    for name, table in (("Events", events), ("Metrics", metrics)):
        if question.get("subject_id") and "subject_id" in table.columns:
            row = table.filter(F.col("subject_id") != question["subject_id"]).select("subject_id").head(1)
            if row:
                found.append(_stranger(name, F.lit(row[0][0]), question))
    return F.array(*found).cast(f"array<{REASON}>")


def first_metric(metrics: DataFrame, name: str, window: dict | None = None, *keys: str) -> DataFrame:
    """Each event's (by its id and ``keys``) first metric of that name, by pos, whose window matches."""
    ok = window_matches(window, name) if window else F.lit(True)
    w = Window.partitionBy("event_id", *keys).orderBy("pos")
    return metrics.filter((F.col("metric_name") == name) & ok).withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")
