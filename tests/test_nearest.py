"""Nearest events by days against a comparison of all pairs: one subject with nearly all events, gaps of many days."""

import random

from glycotide.operators.event_quality import _nearest, isolation

MINUTE = 60_000_000
DAY = 1440


def test_nearest_equals_all_pairs(spark):
    rng = random.Random(2)
    rows, at = [], -40 * DAY
    for i in range(500):
        at += rng.choice([0, 5, 30, 31, 700, 3 * DAY if i % 9 == 0 else 60, 400 * DAY if i % 150 == 149 else 1])
        rows.append((f"e{i}", "one" if i % 25 else "other", at * MINUTE, (at + rng.choice([5, 30, 45, 2 * DAY])) * MINUTE))
    rows += [("same", "one", rows[7][2], rows[7][3]), ("same", "other", rows[25][2], rows[25][3]), ("alone", "third", 5, 6)]
    ev = spark.createDataFrame(rows, "event_id string, s string, start_us long, stop_us long").repartition(5)
    for widths in ((DAY * MINUTE,), (DAY * MINUTE, 30 * DAY * MINUTE), (30 * MINUTE, DAY * MINUTE, 100 * DAY * MINUTE)):
        got = {(r.event_id, r.s): (r.before_us, r.after_us) for r in _nearest(ev, ["s"], widths).collect()}
        want = {}
        for i, s, lo, hi in rows:
            others = [(a, b) for j, k, a, b in rows if k == s and j != i]
            want[i, s] = (max((b for _, b in others if b <= lo), default=None), min((a for a, _ in others if a >= hi), default=None))
        assert got == want
    events = ev.selectExpr("event_id", "s", "cast(null as string) label", "start_us", "stop_us as end_us")
    found = {(r.event_id, r.s): r for r in isolation(events, "s").collect()}
    assert len(found) == len(rows) and found["alone", "third"].is_isolated and found["alone", "third"].min_before_gap is None
    for i, s, lo, hi in rows:
        assert len(found[i, s].overlapping_events) == sum(k == s and j != i and a <= hi and b >= lo for j, k, a, b in rows)
