"""Queries against their SQL over events whose times are rare in small tables: whole seconds, gaps of milliseconds, gaps of just 0, ties."""

import datetime as dt

import duckdb
import pytest

from glycotide.operators.event_quality import isolation
from glycotide.plans import catalogue
from glycotide.plans.workflow import import_cases

from .test_queries import normal

START = dt.datetime(2024, 1, 1)
MINUTE = 60_000_000


def events(spark, folder, rows):
    """rows: event_id, microseconds after START, user_id, event_type."""
    data = [(n, START + dt.timedelta(microseconds=us), user, kind, 20.0 + n, '{"k": 5}') for n, us, user, kind in rows]
    spark.createDataFrame(data, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    return str(folder)


def assert_equals_sql(spark, folder, name):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    ours, theirs = normal(catalogue.QUERIES[name](spark, folder).toPandas()), normal(con.execute(catalogue.ORACLES[name]).df())
    assert len(ours) and ours.to_dict("records") == theirs[list(ours.columns)].to_dict("records")


def test_import_problems_of_near_and_equal_times(spark, tmp_path):
    near = [(1, 0, 4, "view"), (2, 10_000, 4, "view"), (3, 9 * MINUTE, 4, "view"), (11, 0, 8, "view"), (12, 0, 8, "view"), (21, 0, 12, "view"), (31, 0, 5, "view"), (30, 1, 5, "view"), (41, 0, 6, "view"), (42, 7, 6, "view"), (51, 0, 7, "view")]
    uneven = [(61, 0, 16, "view"), (62, 36_000_000, 16, "view"), (63, 36_000_000 + 84_000_000, 16, "view")]
    folder = events(spark, tmp_path, near + uneven)
    assert_equals_sql(spark, folder, "q_import_problems")
    raw = spark.read.parquet(f"{folder}/events.parquet").selectExpr("'u' || user_id AS stem", "ts AS t", "value AS v")
    said = {r.case: r.message for r in import_cases(raw, time_zone="Etc/UTC", unit="mg/dL", time_col="t", value_col="v")[1].collect()}
    assert said["u4"] == "duplicate or unordered timestamps" and said["u8"] == "found 1 duplicate timestamps" and said["u16"] == "inconsistent sampling interval"


@pytest.mark.parametrize("gap", [0, 1, 200_000, 300_000, 2_700_000, 8_700_000, 62_700_000, 32_700_000])
def test_isolation_of_small_gaps(spark, tmp_path, gap):
    folder = events(spark, tmp_path, [(1, 0, 0, "purchase"), (2, 30 * MINUTE + gap, 1, "purchase"), (3, 100 * MINUTE + 7, 2, "purchase"), (4, 0, 99, "purchase"), (5, 0, 99, "view")])
    assert_equals_sql(spark, folder, "q_isolation")


def test_nearest_gap_is_null_for_just_0(spark):
    ev = spark.createDataFrame([("a", "s", 0, MINUTE), ("b", "s", MINUTE, 2 * MINUTE), ("c", "t", 0, MINUTE), ("d", "t", MINUTE + 1000, 2 * MINUTE)], "event_id string, s string, start_us long, end_us long").selectExpr("*", "cast(null as string) AS label")
    got = {r.event_id: (r.nearest_event_gap_minutes, r.min_before_gap, r.min_after_gap) for r in isolation(ev, "s").collect()}
    assert got == {"a": (None, None, 0.0), "b": (None, 0.0, None), "c": (0.0, None, 0.0), "d": (0.0, 0.0, None)}


def test_localized_whole_seconds(spark, tmp_path):
    assert_equals_sql(spark, events(spark, tmp_path, [(1, 5_000_000, 0, "view"), (2, 5_000_001, 0, "view"), (3, 0, 1, "view"), (4, 5_100_000, 1, "view")]), "q_localized")
