"""Bucketed joins against a comparison of all pairs."""

import random

from pyspark.sql import functions as F

from glycotide.operators.range_join import cover, levels_of, overlapping_intervals, points_in_intervals

MINUTE = 60_000_000


def test_points_in_intervals_equals_all_pairs(spark):
    rng = random.Random(7)
    spans = [(i, rng.choice("xy"), s := rng.randrange(-300, 600), s + rng.choice([-5, 0, 30, 61, 400])) for i in range(80)]
    points = [(rng.choice("xyz"), rng.randrange(-400, 900), j) for j in range(300)] + [(None, 0, 999), ("x", None, 998)]
    left = spark.createDataFrame([*spans, (80, None, 0, 10), (81, "x", None, 10)], "i int, k string, lo long, hi long")
    right = spark.createDataFrame(points, "k string, at long, j int").withColumn("at", F.col("at") * MINUTE)
    for closed in ("both", "left"):
        got = points_in_intervals(left, right, ["k"], F.col("lo") * MINUTE, F.col("hi") * MINUTE, "at", closed=closed)
        want = {(i, j) for i, k, lo, hi in spans for q, at, j in points if q == k and at is not None and lo <= at and (at <= hi if closed == "both" else at < hi)}
        rows = [(r.i, r.j) for r in got.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want


def test_overlapping_intervals_equals_all_pairs(spark):
    rng = random.Random(8)
    make = lambda n: [(i, rng.choice("xy"), s := rng.randrange(0, 900), s + rng.choice([0, 15, 60, 200])) for i in range(n)]
    a, b = make(60), make(70)
    left = spark.createDataFrame(a, "i int, k string, lo long, hi long")
    right = spark.createDataFrame(b, "j int, k string, lo2 long, hi2 long")
    bounds = lambda x, y: (F.col(x) * MINUTE, F.col(y) * MINUTE)
    got = [(r.i, r.j) for r in overlapping_intervals(left, right, ["k"], bounds("lo", "hi"), bounds("lo2", "hi2")).collect()]
    want = {(i, j) for i, k, lo, hi in a for j, q, lo2, hi2 in b if k == q and lo <= hi2 and lo2 <= hi}
    assert len(got) == len(set(got)) and set(got) == want


def test_empty_tables(spark):
    left = spark.createDataFrame([], "i int, k string, lo long, hi long")
    right = spark.createDataFrame([], "k string, at long")
    assert points_in_intervals(left, right, ["k"], F.col("lo"), F.col("hi"), "at").count() == 0


YEAR = 525_960


def test_intervals_of_any_length(spark):
    """Minutes to a century, in one table: all pairs are found once, and a long interval has few rows."""
    rng = random.Random(9)
    make = lambda n: [(i, rng.choice("xy"), s := rng.randrange(-20 * YEAR, 60 * YEAR), s + rng.choice([-1, 0, 1, 29, 30, 31, 500, 40_000, 3 * YEAR, 100 * YEAR])) for i in range(n)]
    a, b = make(70), make(60)
    b += [(60, "x", a[0][3], a[0][3] + 30), (61, "y", a[1][2], a[1][3])]  # touching, equal
    points = [(rng.choice("xy"), rng.randrange(-20 * YEAR, 90 * YEAR), j) for j in range(200)] + [(k, t, 200 + 2 * n + m) for n, (_, k, lo, hi) in enumerate(a) for m, t in enumerate((lo, hi))]
    left = spark.createDataFrame(a, "i int, k string, lo long, hi long")
    right = spark.createDataFrame(b, "j int, k string, lo2 long, hi2 long")
    at = spark.createDataFrame(points, "k string, at long, p int").withColumn("at", F.col("at") * MINUTE)
    bounds = lambda x, y: (F.col(x) * MINUTE, F.col(y) * MINUTE)
    for closed in ("both", "left"):
        got = [(r.i, r.p) for r in points_in_intervals(left, at, ["k"], *bounds("lo", "hi"), "at", closed=closed).collect()]
        assert len(got) == len(set(got)) and set(got) == {(i, p) for i, k, lo, hi in a for q, t, p in points if k == q and lo <= t and (t <= hi if closed == "both" else t < hi)}
    got = [(r.i, r.j) for r in overlapping_intervals(left, right, ["k"], bounds("lo", "hi"), bounds("lo2", "hi2")).collect()]
    want = {(i, j) for i, k, lo, hi in a for j, q, lo2, hi2 in b if k == q and lo <= hi and lo2 <= hi2 and lo <= hi2 and lo2 <= hi}
    assert len(got) == len(set(got)) and set(got) == want
    semi = overlapping_intervals(left, right.withColumn("j", F.col("j") + 1000), ["k"], bounds("lo", "hi"), bounds("lo2", "hi2"), semi_on=("i", "j")).collect()
    assert sorted(r.i for r in semi) == sorted({i for i, _ in want})
    levels = levels_of(100 * YEAR * MINUTE, 30)
    sizes = left.select((F.col("hi") - F.col("lo")).alias("n"), F.size(cover(*bounds("lo", "hi"), 30, levels)).alias("rows")).collect()
    assert max(r.rows for r in sizes if r.n > 0) < 100


def test_levels_that_were_not_foreseen(spark):
    """A stated length that some interval exceeds costs rows, not pairs."""
    left = spark.createDataFrame([(1, "x", 0, 5000)], "i int, k string, lo long, hi long")
    at = spark.createDataFrame([("x", t * MINUTE) for t in range(-100, 6000, 50)], "k string, at long")
    assert points_in_intervals(left, at, ["k"], F.col("lo") * MINUTE, F.col("hi") * MINUTE, "at", longest_minutes=60).count() == 101
