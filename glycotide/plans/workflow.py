"""From workbooks and diaries to series, sanity reports, metrics, signals, answers and reports, for all series in one job.

``python -m glycotide.plans.workflow DATA OUT --timezone Area/City`` does for a folder of workbooks (or, with
``--documents``, of series documents) what a run per file would; each series is a case, and every output is partitioned
by case. Facts are stored as Parquet after each step and read back, so no step plans, or computes, those before it.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glycotide.config import UNITS, AnswerConfig, MetricWindows, QualityConfig, SignalConfig
from glycotide.functions.columns import micros
from glycotide.operators import annotations, event_quality, ingest, metrics, questions, sanity, schema_rules, signals
from glycotide.sources import documents
from glycotide.sources.workbook import TIME_COLUMN, VALUE_COLUMN, read_workbooks


#: What a case can fail in, in the order of the work: of several problems the first is reported.
STEPS = ("read", "parse", "duplicates", "local time", "interval", "diary", "events")
PROBLEM = "case string, step string, message string"


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def _problems(step: str, found: DataFrame, case: str = "case", message: str = "message") -> DataFrame:
    return found.select(F.col(case).alias("case"), F.lit(STEPS.index(step)).alias("nth"), F.lit(step).alias("step"), F.col(message).alias("message"))


def first_problems(*found: DataFrame) -> DataFrame:
    """case, step, message: one row per case that has any problem, with that of the first step."""
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("case").agg(F.min(F.struct("nth", "step", "message")).alias("p")).select("case", "p.step", "p.message")


def require_none(problems: DataFrame) -> None:
    """An error with a few of the problems, if there are any."""
    if some := problems.orderBy("case").head(3):
        raise ValueError("; ".join(f"{x.case}: {x.message}" for x in some))


def import_cases(raw: DataFrame, *, time_zone: str, unit: str, subject: str = "subject", time_col: str = TIME_COLUMN, value_col: str = VALUE_COLUMN, store: Callable[[DataFrame, str], DataFrame] = _as_is) -> tuple[DataFrame, DataFrame]:
    """Flat samples with headers from raw readings of many files (``stem``): cleaned, indexed, flagged, identified; and ``problems``.

    A file that can't be read, has a time that is none or that it repeats, a local time that its zone skips or has twice, no
    readings, or gaps that tell no interval, is no case of the samples but a row (case, step, message): it stops no other file.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    if "problem" not in raw.columns:
        raw = raw.withColumn("problem", F.lit(None).cast("string"))
    clean = ingest.clean_readings(raw.filter("problem is null"), time_col, value_col, keep=("stem",), strict=False)
    found = [ingest.unusable_series(raw, time_col, value_col, "stem").select(F.col("stem").alias("case"), *[F.col(f"p.{c}").alias(c) for c in ("nth", "step", "message")])]
    placed = ingest.localized(ingest.indexed(clean, "stem"), F.lit(time_zone), problem="_problem")
    found.append(_problems("local time", placed.filter("_problem is not null").groupBy("stem").agg(F.min("_problem").alias("message")), "stem"))
    interval = ingest.sampling_interval(placed.filter("_problem is null"), "stem", at=F.unix_micros("ts"))
    found.append(_problems("interval", interval.filter("issue is not null"), "stem", "issue"))
    problems = store(first_problems(*found), "import_problems")
    good = placed.drop("_problem").join(problems.select(F.col("case").alias("stem")), "stem", "left_anti").join(interval.drop("issue"), "stem")
    flagged = ingest.artifact_flags(good, "stem", unit=F.lit(unit), interval=F.col("sampling_interval_minutes"))
    flagged = flagged.withColumns({"subject_id": F.lit(subject), "device_id": ingest.device_id(F.col("stem")), "time_zone": F.lit(time_zone), "unit": F.lit(unit), "schema_version": F.lit("1.0.0")})
    ids = ingest.series_ids(flagged, "stem", subject=F.col("subject_id"), device=F.col("device_id"), time_zone=F.col("time_zone"), unit=F.col("unit"))
    return flagged.join(ids, "stem").withColumnRenamed("stem", "case").drop("local_time"), problems


def import_series(raw: DataFrame, **how) -> DataFrame:
    """The samples of ``import_cases``; a file with a problem is an error."""
    samples, problems = import_cases(raw, **how)
    require_none(problems)
    return samples


def diary_cases(lines: DataFrame, *, time_zone: str, subject: str = "subject", event_type: str = "meal", merge: bool = True) -> tuple[DataFrame, DataFrame]:
    """Flat annotations from diary lines (case, line_no, value), and the problems of cases, which have none.

    Lines of one time become one event, unless not to be merged.
    """
    parsed = annotations.parse_diary(lines, "line_no", "value", "case")
    found = [_problems("diary", parsed.filter("problem is not null").groupBy("case").agg(F.min_by("problem", "line_no").alias("message")))]
    good = parsed.filter("problem is null").drop("problem")
    entries = annotations.merge_same_time(good, "case") if merge else good.withColumnRenamed("line_no", "first_line")
    local = ingest.localized(entries.withColumnRenamed("local_start", "local_time"), F.lit(time_zone), problem="_problem")
    found.append(_problems("diary", local.filter("_problem is not null").groupBy("case").agg(F.min_by("_problem", "first_line").alias("message"))))
    raw = local.filter("_problem is null").select("case", F.lit(subject).alias("subject_id"), F.lit(event_type).alias("event_type"), F.col("ts_raw").alias("start_time_raw"), "label", F.col("first_line").cast("long").alias("pos"))
    made = annotations.create(raw, "case").withColumn("time_zone", F.lit(time_zone))
    wrong = F.concat(F.lit("invalid event: "), F.array_join("violations", ", "))
    found.append(_problems("events", made.filter(F.size("violations") > 0).groupBy("case").agg(F.min_by(wrong, "pos").alias("message"))))
    problems = first_problems(*found)
    made = made.drop("violations").withColumn("extra", F.lit(None).cast("string")).join(problems.select("case"), "case", "left_anti")
    return made.join(annotations.collection_ids(made, "case", time_zone=F.col("time_zone")), "case"), problems


def diary_events(lines: DataFrame, **how) -> DataFrame:
    """The annotations of ``diary_cases``; a case with a problem is an error."""
    events, problems = diary_cases(lines, **how)
    require_none(problems)
    return events


def events_for_cases(cases: list[str], files: list[str]) -> dict[str, str]:
    """The events file of each case: ``case.txt``, ``case.json``, else ``events.txt``, ``events.json``; cases without one are left out."""
    there = set(files)
    found = {}
    for case in cases:
        name = next((n for n in (f"{case}.txt", f"{case}.json", "events.txt", "events.json") if n in there), None)
        if name:
            found[case] = name
    return found


EVENT_COLUMNS = (
    "case", "events_id", "subject_id", "time_zone", "pos", "event_id", "event_type", "start_time", "start_time_raw", "end_time", "end_time_raw", "duration_minutes", "exposure_components",
    "source", "annotation_quality", "label", "notes", "extra",
)


def file_names(spark: SparkSession, folder: str, pattern: str) -> dict[str, str]:
    """Name to path of a folder's files, as Spark lists them; contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path").collect()  # one row a file
    return {r.path.rpartition("/")[2]: r.path for r in listed}


def case_events(spark: SparkSession, cases: list[str], folder: str, *, time_zone: str, subject: str = "subject", merge: bool = True, schema: dict | None = None) -> tuple[DataFrame, DataFrame] | None:
    """Annotations of all cases from a folder of diaries and events documents, chosen as ``events_for_cases`` does, and the problems of cases; None if there are none.

    A file that serves several cases is read once; what is wrong with it is a problem of each of them. Events documents
    that break ``schema`` are problems, too.
    """
    files = file_names(spark, folder, "*.{txt,json}")
    chosen = events_for_cases(cases, list(files))
    used = spark.createDataFrame([(c, files[f]) for c, f in chosen.items()], "case string, file string") if chosen else None
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    found, problems = [], []
    for suffix in (".txt", ".json"):
        paths = sorted({files[f] for f in chosen.values() if f.endswith(suffix)})
        if not paths:
            continue
        serves = F.broadcast(used.select("case", name.alias("name")))  # one row a case
        if suffix == ".txt":
            lines = documents.read_diary(spark, paths).withColumn("name", name).join(serves, "name")
            events, wrong = diary_cases(lines.drop("name", "file"), time_zone=time_zone, subject=subject, merge=merge)
        else:
            events, wrong = documents.read_events_tolerant(spark, paths)
            if schema:
                broken = F.concat(F.lit("breaks the schema: "), F.array_join(F.slice("violations", 1, 3), "; ")).alias("message")
                wrong = wrong.unionByName(schema_rules.check_documents(spark, paths, schema).select("file", broken))
            events, wrong = (df.withColumn("name", name).join(serves, "name") for df in (events, wrong))
            wrong = first_problems(_problems("events", wrong))
            events = events.join(wrong.select("case"), "case", "left_anti")
        found.append(events.select(*EVENT_COLUMNS))
        problems.append(wrong)
    if not found:
        return None
    return (found[0].unionByName(found[1]), problems[0].unionByName(problems[1])) if len(found) > 1 else (found[0], problems[0])


def series_from_documents(spark: SparkSession, path: str | list[str], tolerant: bool = False) -> DataFrame:
    """Flat samples of series documents; a document's file stem is its case."""
    rows = documents.read_series(spark, path, tolerant)
    return rows.withColumn("case", F.regexp_extract("file", r"([^/]+)\.[^./]+$", 1)).drop("file")


@dataclass
class Results:
    samples: DataFrame
    sanity: DataFrame
    events: DataFrame | None = None
    quality: DataFrame | None = None
    metrics: DataFrame | None = None
    signals: DataFrame | None = None
    answers: DataFrame | None = None
    warnings: DataFrame | None = None
    problems: DataFrame | None = None


def stored_in(folder: str) -> Callable[[DataFrame, str], DataFrame]:
    """Writes a table to ``folder`` as Parquet and reads it back: what comes after starts from there."""

    def store(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    return store


def warnings_of(samples: DataFrame, events: DataFrame | None, ready: DataFrame | None, not_numeric: DataFrame | None) -> DataFrame:
    """case, warnings: what users should know of and nothing stops for (an empty list: nothing)."""
    text = lambda df, t: df.select("case", t.alias("warning"))
    found = [samples.select("case", F.lit(None).cast("string").alias("warning")).distinct()]
    if not_numeric is not None:
        found.append(text(not_numeric.filter("not_numeric > 0"), F.format_string("%d glucose values are no numbers and were dropped", "not_numeric")))
    if events is not None:
        subjects = samples.groupBy("case").agg(F.first("subject_id").alias("_subject"))
        other = events.select("case", "subject_id").distinct().join(subjects, "case").filter("subject_id <> _subject")
        found.append(text(other, F.format_string("subject %s of the events is not that of the series, %s", "subject_id", "_subject")))
        zero = metrics.interval_warnings(ready, "case")
        found.append(text(zero, F.concat("event_id", F.lit(": "), "warning")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("case").agg(F.array_sort(F.collect_set("warning")).alias("warnings"))


def analyse(samples: DataFrame, events: DataFrame | None, question: dict | None = None, *, windows: MetricWindows | None = None, signal_config: SignalConfig = SignalConfig(), quality_config: QualityConfig = QualityConfig(), answer_config: AnswerConfig = AnswerConfig(), store: Callable[[DataFrame, str], DataFrame] = _as_is, not_numeric: DataFrame | None = None) -> Results:
    """All results of flat samples and annotations that share a ``case``. ``store`` is applied to each fact table in turn."""
    samples = store(samples, "samples")
    out = Results(samples, store(sanity.report(samples, "case"), "sanity"))
    if events is None:
        out.warnings = store(warnings_of(samples, None, None, not_numeric), "warnings")
        return out
    header = samples.groupBy("case").agg(F.first("unit").alias("unit"), F.first("sampling_interval_minutes").alias("sampling_interval_minutes"))
    out.events = events = store(events, "events")
    ready = store(metrics.metric_events(events, header, "case").select("event_id", "case", "label", "start_us", micros("end_time").alias("end_us"), "pos", "unit", "interval"), "metric_events")
    near = metrics.metric_samples(samples, "case")
    out.warnings = store(warnings_of(samples, events, ready, not_numeric), "warnings")
    out.quality = store(event_quality.score(ready, near, ("case",), ("case",), quality_config), "event_quality")
    out.metrics = store(metrics.metrics(ready, near, "case", windows=windows), "metrics")
    rows = store(signals.event_rows(ready.select("event_id", "case", "start_us", "pos", "unit"), out.metrics, "case"), "signal_rows")
    out.signals = store(signals.signals(rows, "case", unit=F.col("unit"), config=signal_config), "event_signals")
    if question:
        out.answers = store(questions.answerability(question, events, out.metrics, "case", config=answer_config), "answers")
    return out


def signal_documents(results: Results, generated_at: str, config: SignalConfig = SignalConfig()) -> DataFrame:
    """One document per case: header with ids and configuration, and the events in order of their start."""
    about = results.samples.groupBy("case").agg(*[F.first(c).alias(c) for c in ("subject_id", "time_zone", "series_id")])
    event = F.struct("event_id", "status", "coverage_ratio", "triggers", "metric_values")
    rows = results.signals.withColumn("_at", F.struct("start_us", "pos"))
    docs = documents.nested(rows, ["case"], "events", event, "_at").join(about, "case")
    return docs.select(
        "case", F.lit("1.0.0").alias("schema_version"), F.concat(F.lit("signals_"), "series_id").alias("signal_set_id"), "subject_id", "time_zone", "series_id", F.lit(generated_at).alias("generated_at"),
        F.lit(config.coverage_soft).alias("coverage_soft"), F.lit(config.history_size).alias("history_size"), F.lit(config.min_history).alias("min_history"), "events",
    )


def summary(results: Results) -> DataFrame:
    """One row per case: samples, interval, coverage, number of metrics, verdict and blocking reasons."""
    report = results.sanity.select("case", "total_samples", "sampling_interval_minutes", "end_time", F.col("coverage.coverage_percentage").alias("coverage_percentage"))
    ids = results.samples.groupBy("case").agg(F.first("series_id").alias("series_id"))
    out = ids.join(report, "case")
    if results.metrics is not None:
        out = out.join(results.metrics.groupBy("case").agg(F.count("*").alias("total_metrics")), "case", "left")
    else:
        out = out.withColumn("total_metrics", F.lit(0))
    out = out.withColumn("total_metrics", F.coalesce("total_metrics", F.lit(0)))
    if results.answers is not None:
        return out.join(results.answers.select("case", "answerable", "reasons", "data_requirements"), "case", "left").withColumn("blocking_reasons", F.filter("reasons", lambda r: r["blocking"]))
    none = lambda t: F.lit(None).cast(f"array<{t}>")
    return out.withColumns({"answerable": F.lit(None).cast("boolean"), "reasons": none(questions.REASON), "data_requirements": none(questions.REQUIREMENT), "blocking_reasons": none(questions.REASON)})


def markdown(generated_at: Column) -> Column:
    """A row of ``summary`` as a Markdown report."""

    def listed(title: str, items: Column, head: str) -> list[Column]:
        lines = F.transform(items, lambda r: F.concat(F.lit("- "), r[head], F.lit(": "), F.coalesce(r["detail"], F.lit("unspecified"))))
        text = F.array_join(lines, "\n")
        return [F.lit(""), F.lit(f"## {title}"), F.when(F.coalesce(F.size(items), F.lit(0)) > 0, text).otherwise("- None")]

    fact = lambda name, c: F.concat(F.lit(f"- {name}: "), F.coalesce(F.col(c).cast("string"), F.lit("unknown")))
    # The headings of the report and their order.
    lines = [F.lit("# CGM Question Report"), F.lit(""), F.concat(F.lit("- Generated: "), generated_at), fact("Series ID", "series_id"), fact("Total samples", "total_samples"), fact("Coverage", "coverage_percentage"), fact("Total metrics", "total_metrics"), fact("Answerable", "answerable")]
    lines += [*listed("Blocking Reasons", F.col("blocking_reasons"), "code"), *listed("All Reasons", F.col("reasons"), "code"), *listed("Data Requirements", F.col("data_requirements"), "type")]
    return F.concat_ws("\n", *lines, F.lit(""))


def case_index(reports: DataFrame) -> DataFrame:
    """title, path, end_time of each case, the latest first; cases without an end time last, by name."""
    return reports.select(F.col("case").alias("title"), F.col("case").alias("path"), "end_time").orderBy(F.desc_nulls_last("end_time"), "title")


def quality_text(rollup: DataFrame) -> DataFrame:
    """case, value: a few lines for people on how far a case's events can be used."""
    line = lambda label, c: F.concat(F.lit(f"{label}: "), F.col(c).cast("string"))
    lines = [F.col("summary"), line("High quality", "high_quality"), line("Medium quality", "medium_quality"), line("Low quality", "low_quality"), line("Usable share", "usability_fraction")]
    return rollup.select("case", F.array_join(F.array(*lines), "\n").alias("value"))


def events_text(events: DataFrame) -> DataFrame:
    """case, value: a paragraph for people on each of a case's events, with what may limit its use."""
    # The headings of the paragraphs.
    line = lambda label, c: F.concat(F.lit(f"{label}: "), c.cast("string"))
    parts = F.transform("exposure_components", lambda c: F.concat(F.lit("  - "), c["name"], F.lit(": "), c["value"].cast("string"), F.lit(" "), c["unit"]))
    listed = F.when(F.coalesce(F.size("exposure_components"), F.lit(0)) > 0, F.concat(F.lit("Exposure components:\n"), F.array_join(parts, "\n")))
    limits = annotations.warnings()
    warned = F.when(F.size(limits) > 0, F.array_join(F.transform(limits, lambda w: F.concat(F.lit("! "), w)), "\n"))
    lines = [
        F.lit("EVENT CLAIM (not ground truth measurement)"), line("Event ID", F.col("event_id")), line("Type", F.col("event_type")), line("Label", F.col("label")), line("Start", F.col("start_time_raw")), line("End", F.col("end_time_raw")),
        line("Duration", F.concat(F.col("duration_minutes").cast("string"), F.lit(" minutes"))), listed, line("Source", F.col("source")), F.concat(F.lit("Annotation quality: "), F.col("annotation_quality").cast("string"), F.lit("/1.0")), line("Notes", F.col("notes")), warned,
    ]
    each = events.select("case", "pos", F.array_join(F.array_compact(F.array(*lines)), "\n").alias("value"))
    return documents.nested(each, ["case"], "all", F.col("value")).select("case", F.array_join("all", "\n\n").alias("value"))


def sanity_text(reports: DataFrame) -> DataFrame:
    """case, value: a few lines for people on a case's readings."""
    line = lambda label, c: F.concat(F.lit(f"{label}: "), F.coalesce(F.col(c).cast("string"), F.lit("unknown")))
    lines = [line("Samples", "total_samples"), line("Interval (minutes)", "sampling_interval_minutes"), line("Coverage (%)", "coverage.coverage_percentage"), line("Missing intervals", "coverage.missing_intervals"), line("Long gaps", "coverage.large_gaps")]
    return reports.select("case", F.array_join(F.array(*lines), "\n").alias("value"))


def write(results: Results, out: str, generated_at: str) -> None:
    """Documents, one per case and kind, the texts for people, and the index of cases."""
    by_case = lambda docs, name: documents.write_documents(docs, f"{out}/{name}", partition_by="case")
    text = lambda df, name: df.write.partitionBy("case").text(f"{out}/{name}")
    by_case(documents.nested(results.samples, ["case", *[c for c in documents.SERIES_HEADER if c in results.samples.columns]], "samples", F.struct(F.col("ts_raw").alias("timestamp"), "glucose_value", F.col("pos").alias("sample_index"), "quality_flags")), "cgm")
    by_case(results.sanity, "sanity")
    text(sanity_text(results.sanity), "sanity_txt")
    if results.warnings is not None:
        by_case(results.warnings, "warnings")
    if results.problems is not None:
        by_case(results.problems, "problems")
    if results.events is not None:
        by_case(documents.nested(results.events, ["case", *[c for c in ("events_id", "subject_id", "time_zone") if c in results.events.columns]], "events", documents.event_object(results.events)), "events")
        text(events_text(results.events), "events_txt")
        by_case(documents.metrics_documents(results.metrics, "case"), "metrics")
        by_case(signal_documents(results, generated_at), "event_signals")
        rollup = event_quality.rollup(results.quality, "case")
        quality = results.quality.groupBy("case").agg(F.array_sort(F.collect_list(F.struct("event_id", "label", "quality_score", "is_usable_for_analysis", "quality_issues", "recommendations"))).alias("events"))
        by_case(rollup.join(quality, "case"), "event_quality")
        text(quality_text(rollup), "event_quality_txt")
    if results.answers is not None:
        by_case(results.answers, "answerability")
    summaries = summary(results)
    by_case(summaries, "report")
    text(summaries.select("case", markdown(F.lit(generated_at)).alias("value")), "report_md")
    documents.write_documents(case_index(results.sanity).coalesce(1), f"{out}/cases")


def read_question(spark: SparkSession, path: str) -> dict:
    """A question document, from any store that Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def run(
    spark: SparkSession, data: str, out: str, *, time_zone: str, unit: str = "mmol/L", subject: str = "subject", events: str | None = None, question: dict | None = None, from_documents: bool = False,
    generated_at: str = "", strict: bool = False, schema: dict | None = None, **tunables,
) -> Results:
    """The whole workflow of a folder; facts are stored under ``out``/facts.

    A case whose file or events have a problem is left out from there on and listed in the results' ``problems``; the others
    are not touched by it. ``strict``: the first problems are an error. ``tunables`` are those of ``analyse``.
    """
    not_numeric, store = None, stored_in(f"{out}/facts")
    wrong = spark.createDataFrame([], PROBLEM)
    if from_documents:
        samples = series_from_documents(spark, data)
    else:
        raw = store(read_workbooks(spark, data, tolerant=True), "readings")  # workbooks are read once
        not_numeric = ingest.dropped_readings(raw, VALUE_COLUMN, "stem").withColumnRenamed("stem", "case")
        samples, wrong = import_cases(raw, time_zone=time_zone, unit=unit, subject=subject, store=store)
    if strict:
        require_none(wrong)
    samples = store(samples, "imported")
    found = None
    if events:
        cases = [r.case for r in samples.select("case").distinct().collect()]  # one row a file
        if both := case_events(spark, cases, events, time_zone=time_zone, subject=subject, schema=schema):
            found, more = both
            more = store(more, "event_problems")
            if strict:
                require_none(more)
            wrong = wrong.unionByName(more)
    if not_numeric is not None:
        not_numeric = not_numeric.join(wrong.select("case"), "case", "left_anti")
    results = analyse(samples, found, question if found is not None else None, store=store, not_numeric=not_numeric, **tunables)
    results.problems = store(wrong, "problems")
    write(results, out, generated_at)
    return results


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Import workbooks and derive reports, metrics, signals and answers.")
    p.add_argument("data", help="a folder of workbooks, or with --documents of series documents (JSON)")
    p.add_argument("out")
    p.add_argument("--timezone", required=True)
    p.add_argument("--unit", default="mmol/L", choices=UNITS)
    p.add_argument("--subject", default="subject")
    p.add_argument("--events", help="a folder with CASE.txt, CASE.json, events.txt or events.json, the first of which counts")
    p.add_argument("--question", help="a question document (JSON)")
    p.add_argument("--documents", action="store_true")
    p.add_argument("--generated-at", default="")
    p.add_argument("--validate", metavar="SCHEMA", help="a JSON schema that events documents must fit")
    p.add_argument("--strict", action="store_true", help="stop at a case that has a problem, instead of listing it")
    for f in fields(QualityConfig):
        p.add_argument(f"--{f.name.replace('_', '-')}", type=float, default=f.default, help="a tunable of the events' quality (default: %(default)s)")
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    question = read_question(spark, a.question) if a.question else None
    quality = QualityConfig(**{f.name: getattr(a, f.name) for f in fields(QualityConfig)})
    run(spark, a.data, a.out, time_zone=a.timezone, unit=a.unit, subject=a.subject, events=a.events, question=question, from_documents=a.documents, generated_at=a.generated_at, strict=a.strict, quality_config=quality, schema=schema_rules.read_schema(spark, a.validate) if a.validate else None)


if __name__ == "__main__":
    main()
