"""JSON documents as flat tables, and back: a document's array becomes rows, ``pos`` their places in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glycotide import schemas
from glycotide.functions.columns import parse_instant
from glycotide.sources import lossless

BUNDLE = ("baseline_window", "peak_window", "auc_window", "recovery_window")
SERIES_HEADER = ("schema_version", "series_id", "subject_id", "device_id", "sensor_id", "time_zone", "unit", "sampling_interval_minutes")


def _read(spark: SparkSession, path: str | list[str], schema) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST").withColumn("file", F.col("_metadata.file_path"))


def read_series(spark: SparkSession, path: str | list[str], tolerant: bool = False) -> DataFrame:
    """Flat samples with their headers. ``tolerant``: samples whose time can't be read go, and pos follows the time."""
    docs = _read(spark, path, schemas.SERIES_DOC).withColumn("sampling_interval_minutes", F.coalesce("sampling_interval_minutes", F.lit(5.0)))
    rows = docs.select("file", *SERIES_HEADER, F.posexplode("samples").alias("pos", "s"))
    out = rows.select("file", *SERIES_HEADER, F.col("pos").cast("long").alias("pos"), F.col("s.timestamp").alias("ts_raw"), "s.glucose_value", "s.quality_flags").withColumn("ts", parse_instant(F.col("ts_raw")))
    if not tolerant:
        return out
    from glycotide.operators.ingest import indexed

    return indexed(out.filter("ts is not null").drop("pos"), "series_id", time_col="ts")


def flat_events(docs: DataFrame) -> DataFrame:
    rows = docs.select("file", "events_id", "subject_id", "time_zone", F.posexplode("events").alias("pos", "e"))
    out = rows.select("file", "events_id", "subject_id", "time_zone", F.col("pos").cast("long").alias("pos"), "e.*")
    out = out.withColumnsRenamed({"start_time": "start_time_raw", "end_time": "end_time_raw"})
    return out.withColumns({"start_time": parse_instant(F.col("start_time_raw")), "end_time": parse_instant(F.col("end_time_raw"))})


def read_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Flat annotations. An absent field and a null are the same."""
    return flat_events(_read(spark, path, schemas.EVENTS_DOC))


def read_events_tolerant(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Flat annotations of the documents, or bare lists, that can be read, with ``extra`` (JSON: what no column tells), and (file, message) of the others.

    A document with an event that has no instant to start at is one of the others, too.
    """
    rows, bad = lossless.read(spark, path, "events")
    header = [F.col(f"doc.{c}").alias(c) for c in ("events_id", "subject_id", "time_zone")]
    rows = rows.select("file", *header, "pos", *lossless.KINDS["events"].item, F.to_json("extra").alias("extra")).withColumnsRenamed({"start_time": "start_time_raw", "end_time": "end_time_raw"})
    rows = rows.withColumns({"start_time": parse_instant(F.col("start_time_raw")), "end_time": parse_instant(F.col("end_time_raw"))})
    first = rows.filter("start_time is null").groupBy("file").agg(F.min_by(F.concat(F.lit("event "), F.coalesce("event_id", F.col("pos").cast("string")), F.lit(": start_time is no instant")), "pos").alias("message"))
    return rows, bad.select("file", F.concat(F.lit("not an events document: "), "message").alias("message")).unionByName(first)


def event_object(events: DataFrame) -> Column:
    """A flat annotation as an object of an events document, with what ``extra`` kept of the one that it was read from."""
    named = {"start_time": "start_time_raw", "end_time": "end_time_raw"}
    extra = F.try_parse_json("extra").try_cast("map<string,variant>") if "extra" in events.columns else None
    return lossless.object_of("events", extra, named)


def read_metrics(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The long table of metrics: a bundle of windows becomes ``window_bundle``, and ``window`` is null."""
    rows = _read(spark, path, schemas.METRICS_DOC).select("file", "metric_set_id", "subject_id", "series_id", F.posexplode("metrics").alias("pos", "m"))
    single = F.when(F.col("m.window.relative_to").isNotNull(), F.struct(*[F.col(f"m.window.{c}").alias(c) for c in ("relative_to", "start_offset_minutes", "end_offset_minutes")]))
    pairs = F.array_compact(F.array(*[F.when(F.col(f"m.window.{p}").isNotNull(), F.struct(F.lit(p).alias("k"), F.col(f"m.window.{p}").alias("v"))) for p in BUNDLE]))
    names = [c for c in schemas.METRIC.fieldNames() if c != "window"]
    return rows.select(
        "file", "metric_set_id", "subject_id", "series_id", F.col("pos").cast("long").alias("pos"), *[F.col(f"m.{c}") for c in names],
        single.alias("window"), F.when(F.size(pairs) > 0, F.map_from_entries(pairs)).alias("window_bundle"),
    )


def read_diary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line_no (from 1), value of each line of text files; a diary is one value until it is split."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("n", "value"))
    return whole.select("file", (F.col("n") + 1).alias("line_no"), "value")


def nested(rows: DataFrame, header: list[str], array: str, element: Column, order: str = "pos") -> DataFrame:
    """One document per header: the rows again as an array of ``element`` in the order of ``order``."""
    by_order = lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)  # noqa: E731  elements may hold maps, which have no order
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), element.alias("x"))), by_order), lambda r: r["x"])
    return rows.groupBy(*header).agg(listed.alias(array))


def series_documents(samples: DataFrame) -> DataFrame:
    """Series documents: series with all their samples; flags are left out where there are none."""
    element = F.struct(F.col("ts_raw").alias("timestamp"), "glucose_value", F.col("pos").alias("sample_index"), "quality_flags")
    return nested(samples, [c for c in SERIES_HEADER if c in samples.columns], "samples", element)


def events_documents(events: DataFrame) -> DataFrame:
    element = F.struct("event_id", "event_type", F.col("start_time_raw").alias("start_time"), F.col("end_time_raw").alias("end_time"), "duration_minutes", "exposure_components", "source", "annotation_quality", "label", "notes")
    return nested(events, [c for c in ("schema_version", "events_id", "subject_id", "time_zone") if c in events.columns], "events", element)


def metrics_documents(metrics: DataFrame, *header: str) -> DataFrame:
    names = [c for c in ("event_id", "metric_name", "metric_version", "window", "value", "unit", "method", "quality_flags", "coverage_ratio", "quality_summary") if c in metrics.columns]
    single = [F.col(f"window.{c}").alias(c) for c in ("relative_to", "start_offset_minutes", "end_offset_minutes")]
    bundle = [F.try_element_at("window_bundle", F.lit(p)).alias(p) for p in BUNDLE]
    ordered = metrics.withColumns({"_order": F.struct("event_id", "pos"), "window": F.struct(*single, *bundle)})
    return nested(ordered, list(header), "metrics", F.struct(*names), "_order")


def write_documents(docs: DataFrame, path: str, pretty: bool = False, mode: str = "errorifexists", partition_by: str | None = None) -> None:
    """One JSON document per row, a line each (``pretty``: over several lines); null fields are left out."""
    options = {"pretty": "true"} if pretty else {}
    columns = [c for c in docs.columns if c != partition_by]
    text = docs.select(*([partition_by] if partition_by else []), F.to_json(F.struct(*columns), options).alias("value"))
    writer = text.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).text(path)
