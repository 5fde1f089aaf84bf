"""The whole workflow over workbooks, diaries and documents that the test makes."""

import json
import subprocess
import sys
import zipfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from glycotide.plans import workflow
from glycotide.sources import documents, workbook

T0 = datetime(2024, 1, 1, 0, 0)
#: An event every 4 hours from 02:00 on; 42 of them.
STARTS = [T0 + timedelta(hours=2 + 4 * k) for k in range(42)]


def make_workbook(path: Path, rows: list[tuple]) -> None:
    cell = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{ref}"><v>{v}</v></c>'
    lines = [(workbook.TIME_COLUMN, workbook.VALUE_COLUMN), *rows]
    sheet = "".join(f'<row r="{n}">{cell(f"A{n}", a)}{cell(f"B{n}", b)}</row>' for n, (a, b) in enumerate(lines, 1))
    main, office = workbook.MAIN.strip("{}"), workbook.RELATIONS.strip("{}")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="a" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{sheet}</sheetData></worksheet>')


def value_at(minute: int) -> float:
    """Flat at 5.0, and after each start up to 8.0 an hour later and down again."""
    since = (minute - 120) % 240 if minute >= 120 else 239
    return round(5.0 + 3.0 * max(0.0, 1 - abs(since - 60) / 60), 3)


def texts(folder: Path) -> dict[str, str]:
    return {p.parent.name.removeprefix("case="): p.read_text(encoding="utf-8") for p in folder.glob("case=*/part-*.txt") if p.stat().st_size}


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    data = tmp_path_factory.mktemp("data")
    rows = [(str(T0 + timedelta(minutes=m)), value_at(m)) for m in range(0, 60 * 24 * 7 + 300, 5)]
    make_workbook(data / "dev-a-1.2.3.xlsx", [*rows, (str(T0 + timedelta(days=20)), "异常")])
    make_workbook(data / "dev-b.xlsx", rows[:300])
    events = data / "events"
    events.mkdir()
    diary = [f"{t:%Y-%m-%d %H:%M} food {'x' if k % 2 else 'y'}" for k, t in enumerate(STARTS)]
    (events / "dev-a-1.2.3.txt").write_text("# a diary\n\n" + "\n".join([*diary, f"{STARTS[3]:%Y-%m-%d %H:%M} and more"]), encoding="utf-8")
    event = lambda k: {"event_id": f"e{k}", "event_type": "meal", "start_time": f"{STARTS[k]:%Y-%m-%dT%H:%M:%S}+08:00", "source": "manual", "label": "tea"}
    (events / "events.json").write_text(json.dumps({"events_id": "evts_1", "subject_id": "other", "time_zone": "Asia/Shanghai", "events": [event(0), event(1)]}))
    (events / "dev-a-1.2.3.json").write_text("not read")
    question = {
        "question_id": "q", "subject_id": "me", "exposure": {"event_type": "meal", "selector": {"component": "label", "operator": "=", "value": "food x"}},
        "comparison": {"event_type": "meal", "selector": {"component": "label", "operator": "=", "value": "food y"}}, "outcome": {"metric_name": "iAUC", "window": {"relative_to": "event_start", "start_offset_minutes": 0, "end_offset_minutes": 120}},
    }
    (data / "question.json").write_text(json.dumps(question))
    to = data / "out"
    workflow.run(spark, f"file://{data}", f"file://{to}", time_zone="Asia/Shanghai", subject="me", events=f"file://{events}", question=workflow.read_question(spark, f"file://{data}/question.json"), generated_at="now")
    return to


def doc(folder: Path, case: str) -> dict:
    return json.loads(texts(folder)[case])


def test_series_and_sanity(out):
    a = doc(out / "cgm", "dev-a-1.2.3")
    assert a["device_id"] == "dev-a" and a["subject_id"] == "me" and a["time_zone"] == "Asia/Shanghai" and a["unit"] == "mmol/L"
    assert len(a["samples"]) == 60 * 24 * 7 // 5 + 60 and a["samples"][0] == {"timestamp": "2024-01-01T00:00:00+08:00", "glucose_value": 5.0, "sample_index": 0}
    assert a["samples"][3]["quality_flags"] == ["artifact"]  # three equal values in a row
    assert a["sampling_interval_minutes"] == 5.0
    assert doc(out / "sanity", "dev-b")["total_samples"] == 300
    assert "Samples: 300" in texts(out / "sanity_txt")["dev-b"]


def test_warnings(out):
    assert doc(out / "warnings", "dev-a-1.2.3")["warnings"] == ["1 glucose values are no numbers and were dropped"]
    assert doc(out / "warnings", "dev-b")["warnings"] == ["subject other of the events is not that of the series, me"]


def test_events(out):
    a, b = (doc(out / "events", c) for c in ("dev-a-1.2.3", "dev-b"))
    assert [e["label"] for e in a["events"][2:5]] == ["food y", "food x / and more", "food y"] and len(a["events"]) == 42
    assert [e["event_id"] for e in b["events"]] == ["e0", "e1"] and b["events_id"] == "evts_1"


def test_metrics(out):
    by = {}
    for m in doc(out / "metrics", "dev-b")["metrics"]:
        by[m["event_id"], m["metric_name"]] = m
    assert by["e0", "baseline_glucose"]["value"] == 5.0 and by["e0", "delta_peak"]["value"] == 3.0 and by["e0", "time_to_peak"]["value"] == 60.0
    assert by["e0", "nadir_glucose"]["value"] == 5.0 and abs(by["e0", "iAUC"]["value"] - 180.0) < 1e-9 and by["e0", "iAUC"]["unit"] == "mmol/L * minutes"
    assert by["e0", "recovery_slope"]["coverage_ratio"] == 1.0


def test_signals(out):
    a = doc(out / "event_signals", "dev-a-1.2.3")
    assert (a["coverage_soft"], a["history_size"], a["min_history"], a["generated_at"]) == (0.85, 30, 10, "now") and a["series_id"].startswith("cgm_")
    assert [e["status"] for e in a["events"]] == ["red"] * 42  # the peak of 8.0 is over 7.8
    first = a["events"][0]
    assert first["metric_values"]["peak_glucose"] == 8.0 and first["triggers"][0]["message"] == "Peak glucose=8.00 mmol/L > 7.80 mmol/L (hard)"


def test_quality(out):
    b = doc(out / "event_quality", "dev-b")
    assert (b["total_events"], b["usable_events"]) == (2, 2) and b["summary"] == "2/2 events are suitable for causal analysis"
    assert b["events"][0]["recommendations"][1] == "Event is well-isolated for analysis."
    assert "High quality: 2" in texts(out / "event_quality_txt")["dev-b"]


def test_answers(out):
    a, b = (doc(out / "answerability", c) for c in ("dev-a-1.2.3", "dev-b"))
    # a metric of several windows never has the question's one
    assert not a["answerable"] and {r["code"] for r in a["reasons"]} == {"metric_window_mismatch", "insufficient_repeats_exposure", "insufficient_repeats_comparison"}
    assert b["reasons"][0]["code"] == "subject_id_mismatch" and b["reasons"][0]["detail"] == "Events subject_id other does not match question subject_id me."
    assert {x["type"] for x in a["data_requirements"]} == {"collect_events", "recompute_metrics"}


def test_reports_and_cases(out):
    r = doc(out / "report", "dev-a-1.2.3")
    assert r["total_metrics"] == 42 * 6 and r["answerable"] is False and r["blocking_reasons"]
    assert texts(out / "report_md")["dev-a-1.2.3"].startswith("# CGM Question Report\n\n- Generated: now\n")
    cases = [json.loads(x) for p in sorted((out / "cases").glob("part-*.txt")) for x in p.read_text().splitlines()]
    assert [c["title"] for c in cases] == ["dev-a-1.2.3", "dev-b"]


def test_documents_read_back(spark, out, tmp_path):
    """What was written is what a run from documents starts from."""
    for case, text in texts(out / "cgm").items():
        (tmp_path / f"{case}.json").write_text(text, encoding="utf-8")
    samples = workflow.series_from_documents(spark, f"file://{tmp_path}")
    assert {r.case: r["count"] for r in samples.groupBy("case").count().collect()} == {"dev-a-1.2.3": 60 * 24 * 7 // 5 + 60, "dev-b": 300}
    assert samples.filter(F.col("ts").isNull()).count() == 0
    (tmp_path / "m.metrics").write_text(texts(out / "metrics")["dev-b"])
    table = documents.read_metrics(spark, f"file://{tmp_path}/m.metrics")
    assert table.filter("metric_name = 'iAUC'").count() == 2


def test_files_of_cases():
    assert workflow.events_for_cases(["a", "b", "c"], ["a.txt", "a.json", "b.json", "events.json"]) == {"a": "a.txt", "b": "b.json", "c": "events.json"}
    assert workflow.events_for_cases(["a"], []) == {}


def test_command_line_starts():
    """In an interpreter of its own, without a session."""
    done = subprocess.run([sys.executable, "-m", "glycotide.plans.workflow", "--help"], capture_output=True, text=True, timeout=120, cwd=Path(__file__).resolve().parents[1])
    assert done.returncode == 0 and "--timezone" in done.stdout


def test_one_events_file_for_several_workbooks(spark, tmp_path):
    """Each case gets what a run of its own gives it, although all events have the same ids."""
    values = {"dev-a": lambda m: value_at(m), "dev-b": lambda m: 4.0 + value_at(m), "dev-c": lambda m: 9.5 - value_at(m) / 4}
    event = lambda k: {"event_id": f"e{k}", "event_type": "meal", "start_time": f"{STARTS[k]:%Y-%m-%dT%H:%M:%S}+08:00", "source": "manual", "label": f"food {'xy'[k % 2]}"}
    shared = json.dumps({"events_id": "evts_1", "subject_id": "me", "time_zone": "Asia/Shanghai", "events": [event(k) for k in range(14)]})
    question = {
        "question_id": "q", "exposure": {"event_type": "meal", "selector": {"component": "label", "operator": "=", "value": "food x"}},
        "comparison": {"event_type": "meal", "selector": {"component": "label", "operator": "=", "value": "food y"}},
        "outcome": {"metric_name": "nadir_glucose", "window": {"relative_to": "event_start", "start_offset_minutes": 0, "end_offset_minutes": 180}},
    }

    def run(cases):
        data = tmp_path / "-".join(cases)
        (data / "events").mkdir(parents=True)
        (data / "events" / "events.json").write_text(shared)
        for c in cases:
            length = 60 * 24 * (3 if c != "dev-c" else 2)  # the last one's readings end before the events do
            make_workbook(data / f"{c}.xlsx", [(str(T0 + timedelta(minutes=m)), round(values[c](m), 3)) for m in range(0, length, 5)])
        got = workflow.run(spark, f"file://{data}", f"file://{data}/out", time_zone="Asia/Shanghai", subject="me", events=f"file://{data}/events", question=question, generated_at="now")
        tables = {n: getattr(got, n) for n in ("quality", "metrics", "signals", "answers", "warnings")}
        return {(n, r.case): sorted(str(x) for x in df.filter(F.col("case") == r.case).collect()) for n, df in tables.items() for r in df.select("case").distinct().collect()}

    together = run(list(values))
    assert len(together) == 15 and all(len(together["quality", c]) == len(together["signals", c]) == 14 for c in values)
    assert together["signals", "dev-a"] != together["signals", "dev-b"]
    for c in ("dev-a", "dev-c"):
        assert {k: v for k, v in together.items() if k[1] == c} == run([c])


def test_events_for_people_and_what_to_collect(out):
    a, b = (texts(out / "events_txt")[c] for c in ("dev-a-1.2.3", "dev-b"))
    assert a.count("EVENT CLAIM (not ground truth measurement)") == 42 and "Label: food x / and more\nStart: 2024-01-01T14:00:00+08:00\nSource: manual" in a
    assert "! Very short event (<5 min)" in b and b.index("Event ID: e0") < b.index("Event ID: e1")
    needs = doc(out / "answerability", "dev-a-1.2.3")["data_requirements"]
    assert {n["group"]: n.get("selector") for n in needs if n["type"] == "collect_events"} == {g: {"component": "label", "operator": "=", "value": f"food {x}"} for g, x in (("exposure", "x"), ("comparison", "y"))}
    assert all("selector" not in n for n in needs if n["type"] != "collect_events")


def test_lists_of_events_and_unknown_fields_come_through(spark, tmp_path):
    event = {"event_id": "e0", "event_type": "meal", "start_time": "2024-01-01T02:00:00+08:00", "exposure_components": [{"name": "carbohydrate", "value": 45, "unit": "g", "brand": "b"}], "photo": {"tags": ["x"]}, "rating": 4}
    (tmp_path / "events.json").write_text(json.dumps([event]))
    events, problems = workflow.case_events(spark, ["c"], f"file://{tmp_path}", time_zone="UTC")
    assert problems.count() == 0
    written = documents.nested(events, ["case"], "events", documents.event_object(events)).select(F.to_json("events").alias("j")).first().j
    assert json.loads(written) == [event]
    assert [c["value"] for c in events.first().exposure_components] == [45.0]


def test_documents_that_break_a_schema_are_problems(spark, tmp_path):
    event = {"event_id": "e0", "event_type": "meal", "start_time": "2024-01-01T02:00:00+08:00"}
    for case, one in (("a", event), ("b", event | {"event_type": "lunch", "annotation_quality": 2})):
        (tmp_path / f"{case}.json").write_text(json.dumps({"events": [one]}))
    schema = {"properties": {"events": {"items": {"properties": {"event_type": {"enum": ["meal"]}, "annotation_quality": {"maximum": 1}}}}}}
    events, problems = workflow.case_events(spark, ["a", "b"], f"file://{tmp_path}", time_zone="UTC", schema=schema)
    assert [tuple(r) for r in problems.collect()] == [("b", "events", "breaks the schema: $.events[].annotation_quality: maximum; $.events[].event_type: enum")]
    assert [r.case for r in events.collect()] == ["a"]
