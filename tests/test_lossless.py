"""Documents of each kind, with fields that no one foresaw, are read to tables and written again without loss."""

import json

import pytest

from glycotide.sources import lossless

WINDOW = {"relative_to": "event_start", "start_offset_minutes": 0, "end_offset_minutes": 120, "note": "both ends"}
DOCUMENTS = {
    "series": {"schema_version": "1.0.0", "series_id": "cgm_1", "unit": "mg/dL", "sampling_interval_minutes": 5, "vendor": {"name": "x", "build": [1, 2, {"a": None}]}, "samples": [
        {"timestamp": "2024-01-01T00:00:00Z", "glucose_value": 5.5, "sample_index": 0, "trend": "up"}, {"timestamp": None, "glucose_value": "high", "quality_flags": ["artifact"], "raw": {"mv": 1.25}}]},
    "events": {"events_id": "e", "subject_id": "s", "notes": "of the document", "events": [
        {"event_id": "a", "event_type": "meal", "start_time": "2024-01-01T00:00:00Z", "notes": "of the event", "exposure_components": [{"name": "carbohydrate", "value": 45, "unit": "g", "brand": "b"}], "photo": {"url": "u", "tags": ["x"]}},
        {"event_id": "b", "annotation_quality": 0.5, "label": None, "duration_minutes": 30}]},
    "metrics": {"metric_set_id": "m", "warnings": {"a": "no data"}, "metrics": [
        {"event_id": "a", "metric_name": "iAUC", "value": 12.5, "window": WINDOW, "quality_flags": [], "quality_summary": {"sample_count": 3, "own": [1]}},
        {"event_id": "a", "metric_name": "delta_peak", "value": None, "window": {"baseline_window": WINDOW, "my_window": WINDOW}, "quality_summary": "none"},
        {"event_id": "b", "metric_name": "odd", "value": "12", "coverage_ratio": 1}]},
    "signals": {"series_id": "s", "coverage_soft": 0.85, "history_size": 30, "events": [{"event_id": "a", "status": "red", "metric_values": {"iAUC": 3}, "triggers": [{"metric": "iAUC", "value": 3.5}]}]},
    "question": {"question_id": "q", "exposure": {"event_type": "meal", "selector": {"component": "label", "operator": "in", "value": ["a", 2, None]}}, "outcome": {"metric_name": "iAUC", "window": WINDOW}, "condition": [{"name": "x", "value": [1, 2]}], "priority": 3},
    "answer": {"question_id": "q", "answerable": False, "reasons": [{"code": "x", "affected_event_ids": ["a"], "observed": 1}], "made_by": {"v": 1}},
}


@pytest.mark.parametrize("kind", DOCUMENTS)
def test_nothing_is_lost(spark, tmp_path, kind):
    for n in range(2):
        (tmp_path / f"{n}.json").write_text(json.dumps(DOCUMENTS[kind] | {"copy": n}, indent=n), encoding="utf-8")
    rows, problems = lossless.read(spark, f"file://{tmp_path}", kind)
    assert problems.count() == 0
    got = sorted((json.loads(r.value) for r in lossless.documents(rows, kind).collect()), key=lambda d: d["copy"])
    assert got == [DOCUMENTS[kind] | {"copy": n} for n in range(2)]
    # also by way of a stored table
    rows.write.parquet(f"{tmp_path}/stored")
    again = sorted((json.loads(r.value) for r in lossless.documents(spark.read.parquet(f"{tmp_path}/stored"), kind).collect()), key=lambda d: d["copy"])
    assert again == got


def test_columns_are_typed(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps(DOCUMENTS["metrics"]))
    rows = {r.metric_name: r for r in lossless.read(spark, f"file://{tmp_path}", "metrics")[0].collect()}
    assert rows["iAUC"].window.end_offset_minutes == 120.0 and rows["iAUC"].window_bundle is None and rows["iAUC"].value == 12.5
    assert rows["delta_peak"].window is None and set(rows["delta_peak"].window_bundle) == {"baseline_window", "my_window"} and rows["delta_peak"].value is None
    assert rows["odd"].value is None and rows["odd"].coverage_ratio == 1.0  # "12" is text


def test_bare_lists_are_taken(spark, tmp_path):
    """A list of elements and a document that has it give one table, and each is written as it was."""
    for kind in ("events", "metrics"):
        for name, what in (("list", DOCUMENTS[kind][kind]), ("dict", DOCUMENTS[kind])):
            (tmp_path / kind / name).mkdir(parents=True)
            (tmp_path / kind / name / "x.json").write_text(json.dumps(what))
        table = lambda n: lossless.read(spark, f"file://{tmp_path}/{kind}/{n}", kind)[0]  # noqa: B023, E731
        plain = lambda df: sorted(map(str, df.drop("file", "doc", "extra").collect()))
        assert plain(table("list")) == plain(table("dict")) and table("list").filter("doc is null").count() == len(DOCUMENTS[kind][kind])
        assert json.loads(lossless.documents(table("list"), kind).first().value) == DOCUMENTS[kind][kind]


def test_other_files_are_named(spark, tmp_path):
    for name, text in {"a": "{", "b": "{}", "c": "[1]", "d": '{"events": 3}', "e": "7", "f": '{"events": []}', "g": '{"events": [{}]}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows, problems = lossless.read(spark, f"file://{tmp_path}", "events")
    assert {r.file[-6:-5]: r.message for r in problems.collect()} == {"a": "not JSON", "b": "no events", "c": "an element of events is no object", "d": "no events", "e": "no events"}
    assert [r.file[-6:-5] for r in rows.collect()] == ["g"]
