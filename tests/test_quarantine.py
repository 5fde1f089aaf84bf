"""Workbooks, diaries and documents that are each broken in another way stop nothing but their own case."""

import json
from datetime import datetime, timedelta

import pytest

from glycotide.plans import workflow
from glycotide.sources import workbook
from tests.test_workflow import make_workbook, value_at

T0 = datetime(2024, 3, 9, 0, 0)
ROWS = [(str(T0 + timedelta(minutes=m)), value_at(m)) for m in range(0, 600, 5)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    data = tmp_path_factory.mktemp("broken")
    broken = {
        "bad-time": [*ROWS[:5], ("yesterday", 5.0), ("today", 5.0)], "twice": [*ROWS[:9], ROWS[8], ROWS[8]], "no-values": [(t, "high") for t, _ in ROWS[:4]], "one": ROWS[:1],
        "clock": [*ROWS[:4], ("2024-03-10 02:30:00", 5.0)], "uneven": [(str(T0 + timedelta(seconds=s)), 5.0) for s in (0, 36, 96, 180)],
    }
    for name, rows in broken.items():
        make_workbook(data / f"{name}.xlsx", rows)
    (data / "not-a-zip.xlsx").write_bytes(b"plain text")
    make_workbook(data / "no-column.xlsx", ROWS[:3])
    whole = (data / "no-column.xlsx").read_bytes()
    make_workbook(data / "cut-off.xlsx", ROWS)
    cut = (data / "cut-off.xlsx").read_bytes()
    (data / "cut-off.xlsx").write_bytes(cut[: len(cut) // 2])
    named = workbook.VALUE_COLUMN
    try:
        workbook.VALUE_COLUMN = "other"
        make_workbook(data / "no-column.xlsx", ROWS[:3])
    finally:
        workbook.VALUE_COLUMN = named
    assert whole
    for name in ("good", "bad-diary", "bad-json", "odd-json", "no events at all"):
        make_workbook(data / f"{name}.xlsx", ROWS)
    events = data / "events"
    events.mkdir()
    (events / "good.txt").write_text("2024-03-09 02:00 food x\n2024-03-09 6:00 food y\n")
    (events / "bad-diary.txt").write_text("2024-03-09 02:00 food x\n# fine\n2024-03-09 noon food y\n2024-03-09\n")
    (events / "bad-json.json").write_text('{"events": [')
    event = {"event_id": "e1", "event_type": "meal", "start_time": "2024-03-09T02:00:00"}  # without an offset
    (events / "odd-json.json").write_text(json.dumps({"events_id": "x", "subject_id": "s", "time_zone": "UTC", "events": [event | {"event_id": "e0", "start_time": "2024-03-09T02:00:00Z"}, event]}))
    return data


MESSAGES = {
    "bad-time": ("parse", "not a timestamp: today (2 in all)"), "twice": ("duplicates", "found 2 duplicate timestamps"), "no-values": ("parse", "no readings"), "one": ("interval", "needs two samples"),
    "clock": ("local time", "skipped local time: 2024-03-10 02:30:00"), "uneven": ("interval", "inconsistent sampling interval"), "not-a-zip": ("read", "not a workbook: "), "cut-off": ("read", "not a workbook: "),
    "no-column": ("read", f"Missing required columns: {workbook.VALUE_COLUMN}"), "bad-diary": ("diary", "line 3: not a date and time"), "bad-json": ("events", "not an events document"), "odd-json": ("events", "event e1: start_time is no instant"),
}


def test_broken_cases_are_listed_and_stop_no_other(spark, folder):
    out = folder / "out"
    got = workflow.run(spark, f"file://{folder}", f"file://{out}", time_zone="America/Los_Angeles", events=f"file://{folder}/events", generated_at="now", quality_config=workflow.QualityConfig(min_baseline_minutes=30))
    found = {r.case: (r.step, r.message) for r in got.problems.collect()}
    assert set(found) == set(MESSAGES) and all(found[c][0] == step and found[c][1].startswith(text) for c, (step, text) in MESSAGES.items())
    assert {r.case for r in got.sanity.collect()} == {"good", "bad-diary", "bad-json", "odd-json", "no events at all"}
    assert {r.case for r in got.signals.collect()} == {r.case for r in got.quality.collect()} == {"good"}
    assert got.metrics.filter("metric_name = 'delta_peak' and value = 3.0").count() == 2
    assert {r.baseline.expected_samples for r in got.quality.collect()} == {6.0}  # of half an hour
    listed = {p.parent.name.removeprefix("case="): json.loads(p.read_text()) for p in (out / "problems").glob("case=*/part-*.txt") if p.stat().st_size}
    assert {c: (d["step"], d["message"]) for c, d in listed.items()} == found
    warned = {p.parent.name.removeprefix("case=") for p in (out / "warnings").glob("case=*/part-*.txt")}
    assert "no-values" not in warned


def test_strict_runs_stop(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="bad-time: not a timestamp: today"):
        workflow.run(spark, f"file://{folder}", f"file://{tmp_path}/out", time_zone="America/Los_Angeles", strict=True)
    with pytest.raises(Exception, match="Missing required columns"):
        workbook.read_workbooks(spark, f"file://{folder}/no-column.xlsx").count()
    with pytest.raises(FileNotFoundError, match="no workbook"):
        workbook.read_workbooks(spark, f"file://{folder}/events")


def test_workbooks_from_another_store(spark, folder):
    """By a scheme that only Spark's readers open."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.cells.link./books", f"file://{folder}")
    by_view = workbook.read_workbooks(spark, "viewfs://cells/books", tolerant=True)
    by_file = workbook.read_workbooks(spark, f"file://{folder}", tolerant=True)
    rows = lambda df: sorted(map(str, df.drop("file").collect()))
    assert rows(by_view) == rows(by_file) and by_view.filter("file like 'viewfs:%'").count() == by_view.count()
    assert {r.stem for r in by_view.filter("row_no is not null").select("stem").distinct().collect()} >= {"no events at all", "good"}
