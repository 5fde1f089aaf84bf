"""Scans in pieces against plain windows, over series cut at random places."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from glycotide.functions.columns import micros
from glycotide.operators import ingest, sanity, segments

#: Pieces of one row, of some, of all; two levels, three, and none that is a plain window.
WIDTHS = [(1, 7), (5, 40), (13, 100, 1000), (1 << 20, 1 << 30), (3,), ()]


@pytest.fixture(scope="module")
def rows(spark):
    """Five series: dense, sparse with gaps far longer than a piece, one of one row, one of two, one below 0."""
    r = random.Random(11)
    places = {"dense": range(400), "sparse": sorted(r.sample(range(10**6), 200)), "one": [17], "two": [3, 9000], "low": sorted(r.sample(range(-3000, 50), 150))}
    data = [(s, p, r.choice([5.0, 5.0, 6.5, 9.25, None]), i) for s, ps in places.items() for i, p in enumerate(ps)]
    r.shuffle(data)
    return spark.createDataFrame(data, "series string, pos long, v double, i long").repartition(6).cache()


@pytest.mark.parametrize("widths", WIDTHS)
def test_equal_to_windows(rows, widths):
    w = Window.partitionBy("series").orderBy("pos")
    wanted = {"b1": ("v", 1), "b2": ("i", 2), "b3": ("v", 3), "a1": ("v", -1), "a2": ("i", -2)}
    want = rows.withColumns({"b1": F.lag("v").over(w), "b2": F.lag("i", 2).over(w), "b3": F.lag("v", 3).over(w), "a1": F.lead("v").over(w), "a2": F.lead("i", 2).over(w)})
    got = segments.with_neighbours(rows, ["series"], "pos", wanted, widths)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(got.columns).collect()), key=str)
    gaps = rows.withColumn("gap", F.col("pos") - F.lag("pos").over(w)).filter("gap is not null").select("series", "gap")
    assert sorted(map(tuple, segments.gaps(rows, ["series"], "pos", F.col("pos"), widths).collect())) == sorted(map(tuple, gaps.collect()))
    if widths:
        numbered = segments.numbered(rows.drop("i"), ["series"], "pos", "n", widths).join(rows.select("series", "pos", "i"), ["series", "pos"])
        assert numbered.count() == rows.count() and numbered.filter("n <> i").count() == 0
    for combine, down in ((F.sum, False), (F.max, False), (F.min, True)):
        frame = Window.partitionBy("series").orderBy(F.desc("pos") if down else "pos").rowsBetween(Window.unboundedPreceding, -1)
        want = rows.withColumn("c", combine("i").over(frame)).select("series", "pos", "c")
        got = segments.carried(rows.select("series", "pos", "i"), ["series"], "pos", "i", widths, combine, down, "c").select("series", "pos", "c")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("p", [0.5, 0.0, 1.0, 0.3])
def test_quantiles(spark, p):
    r = random.Random(5)
    data = {"many": [r.gauss(0, 900) for _ in range(500)], "ties": [r.choice([1.5, 2.0, 2.0, 7.0]) for _ in range(301)], "one": [4.25], "far": [-1e300, 1e300, 1e18, 2e18], "two": [1.0, 2.0]}
    rows = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    got = {x.k: x.q for x in segments.quantile(rows, ["k"], "v", "n", p, out="q").collect()}
    for k, vs in data.items():
        vs, at = sorted(vs), (len(vs) - 1) * p
        low, high = vs[int(at)], vs[min(int(at) + 1, len(vs) - 1)]
        assert got[k] == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-12), k
    if p == 0.5:
        assert got["many"] == pytest.approx(statistics.median(data["many"]))


def test_no_window_has_a_whole_series(spark, rows):
    """All windows but those over the outermost pieces are by series and piece."""
    out = segments.with_neighbours(rows, ["series"], "pos", {"b": ("v", 1)}, (10, 100))
    assert "_piece_2" in out._jdf.queryExecution().optimizedPlan().toString()
    plan = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in x]
    assert plan and sum("_piece_2" in x.rsplit("], [", 2)[1] for x in plan) >= 2


def readings(spark, widths):
    """Three series of a month, with jumps, flat stretches and long gaps."""
    r, data = random.Random(3), []
    for s in "abc":
        at = 1_700_000_000_000_000
        for i in range(3000):
            at += 60_000_000 * r.choice([5, 5, 5, 5, 6, 45, 2000 if i % 700 == 0 else 5])
            data.append((s, i, at, r.choice([80.0, 80.0, 95.0, 150.0, 260.0]), "mg/dL", 5.0))
    df = spark.createDataFrame(data, "s string, pos long, us long, glucose_value double, unit string, sampling_interval_minutes double")
    return df.withColumn("ts", F.timestamp_micros("us")).withColumn("ts_raw", F.col("ts").cast("string")).withColumn("quality_flags", F.lit(None).cast("array<string>")).repartition(5)


def test_operators_do_not_depend_on_the_pieces(spark):
    df = readings(spark, None)
    key = lambda frame: sorted(map(str, frame.collect()))
    for make in (
        lambda w: sanity.coverage(df, "s", widths=w), lambda w: sanity.suspicious(df, "s", widths=w), lambda w: ingest.sampling_interval(df, "s", at=micros("ts"), widths=w),
        lambda w: ingest.artifact_flags(df, "s", unit=F.col("unit"), interval=F.col("sampling_interval_minutes"), widths=w), lambda w: ingest.unordered_samples(df, "s", widths=w),
    ):
        whole = key(make(()))
        assert whole
        for widths in ((50, 1000), (7, 70, 700)):
            assert key(make(widths)) == whole
    by_time = ingest.indexed(df.drop("pos"), "s", time_col="ts").join(df.select("s", "us", F.col("pos").alias("want")), ["s", "us"])
    assert by_time.count() == 9000 and by_time.filter("pos <> want").count() == 0
