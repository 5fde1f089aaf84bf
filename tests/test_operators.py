"""Operators over small made-up series: error paths and branches that the driver's tables don't have."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from glycotide.config import AnswerConfig, MetricWindows, Window
from glycotide.operators import annotations, ingest, metrics, questions, signals

T0 = datetime(2024, 1, 1, 8, 0)


def series(spark, values, minutes=None, unit="mg/dL"):
    minutes = minutes or [5 * k for k in range(len(values))]
    rows = [("s", k, T0 + timedelta(minutes=m), float(v)) for k, (m, v) in enumerate(zip(minutes, values))]
    out = spark.createDataFrame(rows, "series_id string, pos long, ts timestamp, glucose_value double")
    return out.withColumns({"unit": F.lit(unit), "sampling_interval_minutes": F.lit(5.0), "quality_flags": F.lit(None).cast("array<string>"), "ts_raw": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")})


def flagged(df) -> list[int]:
    out = ingest.artifact_flags(df, "series_id", unit=F.col("unit"), interval=F.col("sampling_interval_minutes"))
    return sorted(r.pos for r in out.filter("array_contains(quality_flags, 'artifact')").collect())


def interval(spark, minutes):
    return ingest.sampling_interval(series(spark, [1] * len(minutes), minutes), "series_id", at=F.unix_micros("ts")).first()


def test_sampling_intervals(spark):
    assert interval(spark, [0, 5, 10, 15, 20, 25]).sampling_interval_minutes == 5.0
    assert interval(spark, [0, 15, 30, 45, 60]).sampling_interval_minutes == 15.0
    assert interval(spark, [5 * i + 0.5 * (i % 2) for i in range(10)]).sampling_interval_minutes == 5.5
    assert interval(spark, [0, 5, 10, 40, 45, 50]).sampling_interval_minutes == 5.0  # uneven: the commonest gap
    assert interval(spark, [0]).issue == "needs two samples"
    assert interval(spark, [0, 0, 5]).issue == "duplicate or unordered timestamps"
    assert interval(spark, [0, 0.1, 0.5, 0.6]).issue == "inconsistent sampling interval"


def test_artifacts(spark):
    assert flagged(series(spark, [95, 98, 102, 98, 200, 100, 105, 108, 40, 98])) == [4, 8]
    assert flagged(series(spark, [98, 98, 98, 98, 99, 100, 101])) == [2, 3]
    assert flagged(series(spark, [5.3, 5.5, 5.8, 7.8, 5.6], unit="mmol/L")) == []
    assert flagged(series(spark, [5.3, 5.5, 5.8, 9.8, 5.6], unit="mmol/L")) == [3]
    had = series(spark, [95, 200, 96]).withColumn("quality_flags", F.when(F.col("pos") <= 1, F.array(F.lit("sensor_error"))))
    out = ingest.artifact_flags(had, "series_id", unit=F.col("unit"), interval=F.col("sampling_interval_minutes"))
    assert [r.quality_flags for r in out.orderBy("pos").collect()] == [["sensor_error"], ["artifact", "sensor_error"], None]


def test_readings_that_are_no_numbers(spark):
    raw = spark.createDataFrame([("a", "2024-01-01 08:00:00", "5.1"), ("a", "2024-01-01 08:05:00", "异常"), ("a", None, "5"), ("a", "2024-01-01 08:10:00", "NaN"), ("b", "2024-01-01 08:00:00", None)], "stem string, t string, v string")
    assert ingest.clean_readings(raw, "t", "v", keep=("stem",)).count() == 1
    assert {r.stem: r.not_numeric for r in ingest.dropped_readings(raw, "v", "stem").collect()} == {"a": 2, "b": 0}
    with pytest.raises(ValueError, match="Missing required columns: w"):
        ingest.clean_readings(raw, "t", "w")
    with pytest.raises(Exception, match="not a timestamp"):
        ingest.clean_readings(raw.withColumn("t", F.lit("noon")), "t", "v").collect()


def test_repeated_times_are_an_error(spark):
    with pytest.raises(ValueError, match="found 1 duplicate"):
        ingest.require_unique_timestamps(series(spark, [1, 2, 3, 4], [0, 5, 5, 10]), "series_id", time_col="ts")


def test_times_when_clocks_change(spark):
    local = lambda *t: spark.createDataFrame([(x,) for x in t], "t string").select(F.col("t").cast("timestamp_ntz").alias("local_time"))
    zone = F.lit("America/Los_Angeles")
    got = ingest.localized(local("2024-01-15 08:00:00", "2024-07-15 08:00:00.5"), zone).orderBy("ts").collect()
    assert [r.ts_raw for r in got] == ["2024-01-15T08:00:00-08:00", "2024-07-15T08:00:00.500000-07:00"]
    for t, why in (("2024-03-10 02:30:00", "skipped"), ("2024-11-03 01:30:00", "ambiguous")):
        with pytest.raises(Exception, match=f"{why} local time"):
            ingest.localized(local(t), zone).collect()


def test_series_ids_depend_on_all_that_names_them(spark):
    ids = lambda values, zone="UTC", unit="mg/dL": ingest.series_ids(series(spark, values), "series_id", subject=F.lit("me"), device=F.lit("d"), time_zone=F.lit(zone), unit=F.lit(unit)).toDF("k", "id").first().id
    one = ids([95, 100, 105])
    assert one == ids([95, 100, 105]) and len({one, ids([95, 100, 105], "LA"), ids([95, 100, 105], unit="mmol/L"), ids([95, 100, 106])}) == 4


def test_diaries(spark):
    lines = lambda *t: spark.createDataFrame(list(enumerate(t, 1)), "line_no int, value string")
    parsed = annotations.parse_diary(lines("2026-01-01 12:00 item-a", "# no", "", "2026-01-01 12:00 item-b", "2026-1-1 12:30 c"))
    merged = annotations.merge_same_time(annotations.require_parsed(parsed)).orderBy("local_start").collect()
    assert [(r.label, r.first_line) for r in merged] == [("item-a / item-b", 1), ("c", 5)]
    for bad in ("2026-01-01 badline", "2026-01-41 12:00 x", "2026-01-01 noon x"):
        with pytest.raises(Exception, match="line 1"):
            annotations.require_parsed(annotations.parse_diary(lines(bad))).collect()


def test_texts_of_annotations(spark):
    one = spark.range(1)
    assert one.select(annotations.comma_list(F.lit(" a, ,b,,c ")).alias("x")).first().x == ["a", "b", "c"]
    tags = F.array(F.lit("Dinner"), F.lit("post exercise"))
    assert one.select(annotations.with_context_tags(F.lit("n"), tags).alias("x")).first().x == "n\nContext tags: dinner, post_exercise"
    assert one.select(annotations.with_context_tags(F.lit(None).cast("string"), F.array().cast("array<string>")).alias("x")).first().x is None


def test_append_needs_one_subject(spark):
    a, b = (spark.createDataFrame([(s, "UTC", e)], "subject_id string, time_zone string, event_id string") for s, e in (("me", "1"), ("you", "2")))
    assert annotations.appended(a, a).count() == 2
    with pytest.raises(ValueError, match="subject_id"):
        annotations.appended(a, b)


def found(spark, values, minutes, windows=None) -> dict:
    events = spark.createDataFrame([("e", "s", T0)], "event_id string, series_id string, start_time timestamp").withColumns({"unit": F.lit("mg/dL"), "interval": F.lit(5.0)})
    table = metrics.metrics(metrics.metric_events(events), metrics.metric_samples(series(spark, values, minutes), "series_id"), "series_id", windows=windows)
    return {r.metric_name: r for r in table.collect()}


def test_metrics_of_small_series(spark):
    base = found(spark, [95, 98, 96, 94, 97, 100], [-30, -25, -20, -15, -10, -5])
    assert round(base["baseline_glucose"].value, 4) == 96.6667 and base["baseline_glucose"].quality_summary.window_samples == 6 and set(base) == {"baseline_glucose"}
    part = found(spark, [95, 96, 97, 100], [-30, -20, -10, -5])["baseline_glucose"]
    assert part.quality_summary.coverage_percentage == 57.1 and part.quality_flags == ["low_coverage", "missing_data"]
    triangle = [100] * 6 + [100 + 10 * k for k in range(8)] + [170 - 10 * k for k in range(1, 12)]
    assert found(spark, triangle, [5 * k for k in range(25)])["iAUC"].value == 2450
    rising = found(spark, [100 + 2 * k for k in range(75)], [5 * (k - 6) for k in range(75)])
    assert abs(rising["recovery_slope"].value - 0.4) < 1e-12 and len(rising) == 6
    assert set(found(spark, [120], [10])) == {"time_to_peak", "nadir_glucose"}
    ties = found(spark, [100, 150, 150, 90, 90], [0, 5, 10, 15, 20])
    assert ties["time_to_peak"].value == 5.0 and ties["nadir_glucose"].quality_summary.nadir_time == "2024-01-01T08:15:00Z"
    wide = found(spark, [80, 100, 130], [-60, 0, 5], MetricWindows(baseline=Window(-60, -30)))
    assert wide["delta_peak"].value == 50 and wide["delta_peak"].window_bundle["baseline_window"].start_offset_minutes == -60


def test_signals_from_either_table(spark):
    """The row per event that a long table and a wide one give is the same."""
    values = [100 + (k * 37 % 50) for k in range(400)]
    events = spark.createDataFrame([(f"e{k}", "s", T0 + timedelta(minutes=200 * k + 3)) for k in range(10)], "event_id string, series_id string, start_time timestamp").withColumns({"unit": F.lit("mg/dL"), "interval": F.lit(5.0), "pos": F.lit(0)})
    ready, near = metrics.metric_events(events), metrics.metric_samples(series(spark, values), "series_id")
    keys = events.select("event_id")
    long = signals.event_rows(keys, metrics.metrics(ready, near, "series_id").drop("series_id"))
    wide = signals.window_rows(keys, metrics.window_aggregates(ready, near, "series_id", names=signals.REQUIRED))
    assert sorted(map(str, long.select(*sorted(long.columns)).collect())) == sorted(map(str, wide.select(*sorted(long.columns)).collect()))


QUESTION = {
    "question_id": "q", "exposure": {"event_type": "meal", "selector": {"component": "label", "operator": "=", "value": "x"}}, "comparison": {"event_type": "meal", "selector": {"component": "label", "operator": "=", "value": "y"}},
    "outcome": {"metric_name": "iAUC", "window": {"relative_to": "event_start", "start_offset_minutes": 0, "end_offset_minutes": 120}}, "time_span": {"start_time": "2024-01-01T00:00:00+00:00", "end_time": "2024-12-31T00:00:00+00:00"},
}


def answer(spark, x, y, without=(), window=(0.0, 120.0), question=QUESTION, subject="me"):
    """Meals of the labels x and y at so many minutes, each with one iAUC."""
    rows = [(f"{g}{k}", subject, T0 + timedelta(minutes=m), g) for g, offsets in (("x", x), ("y", y)) for k, m in enumerate(offsets)]
    schema = "event_id string, subject_id string, start_time timestamp, label string"
    events = spark.createDataFrame(rows, schema).withColumns({
        "event_type": F.lit("meal"), "start_time_raw": F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ssXXX"), "end_time": F.lit(None).cast("timestamp"), "end_time_raw": F.lit(None).cast("string"), "pos": F.monotonically_increasing_id(),
        "source": F.lit("manual"), "annotation_quality": F.lit(0.8), "notes": F.lit(None).cast("string"), "duration_minutes": F.lit(None).cast("double"), "exposure_components": F.lit(None).cast("array<struct<name:string,value:double,unit:string>>"),
    })
    found = [(i, "iAUC", 10.0, 0.9, 0) for i, *_ in rows if i not in without]
    one = F.struct(F.lit("event_start").alias("relative_to"), F.lit(window[0]).alias("start_offset_minutes"), F.lit(window[1]).alias("end_offset_minutes"))
    table = spark.createDataFrame(found, "event_id string, metric_name string, value double, coverage_ratio double, pos int").withColumns({"window": one, "window_bundle": F.lit(None).cast("map<string,struct<relative_to:string,start_offset_minutes:double,end_offset_minutes:double>>"), "quality_summary": F.struct(F.lit(None).cast("double").alias("coverage_percentage"))})
    return questions.answerability(question, events, table, config=AnswerConfig()).first()


def codes(row) -> set[str]:
    return {r.code for r in row.reasons}


def test_answers(spark):
    good = answer(spark, [0, 200], [400, 600])
    assert good.answerable and not good.reasons and not good.data_requirements
    assert codes(answer(spark, [0], [200])) == {"insufficient_repeats_exposure", "insufficient_repeats_comparison"}
    lost = answer(spark, [0, 200], [400, 600], without=("x1",))
    assert not lost.answerable and "missing_metric" in codes(lost) and {n.type for n in lost.data_requirements} == {"collect_events", "compute_metrics"}
    assert "insufficient_repeats_exposure" in codes(answer(spark, [0, 10], [300, 600]))
    other = answer(spark, [0, 200], [400, 600], window=(0.0, 60.0))
    assert "metric_window_mismatch" in codes(other) and "recompute_metrics" in {n.type for n in other.data_requirements}
    late = answer(spark, [0, 60], [120, 180], question=QUESTION | {"condition": [{"name": "time_of_day", "operator": "between", "value": ["08:00", "09:00"]}]})
    assert not late.answerable
    assert codes(answer(spark, [], [], question=QUESTION)) == {"no_matching_exposure_events", "no_matching_comparison_events"}


def test_answers_about_someone_else(spark):
    row = answer(spark, [0, 200], [400, 600], question=QUESTION | {"subject_id": "you"})
    assert not row.answerable and codes(row) == {"subject_id_mismatch"}
    assert answer(spark, [0, 200], [400, 600], question=QUESTION | {"subject_id": "me"}).answerable


def test_same_events_in_both_groups(spark):
    row = answer(spark, [0, 200], [400, 600], question=QUESTION | {"comparison": QUESTION["exposure"]})
    assert "ambiguous_event_definition" in codes(row) and not row.answerable and {n.type for n in row.data_requirements} == {"refine_definitions"}
