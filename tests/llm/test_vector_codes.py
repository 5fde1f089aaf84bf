"""Vector codes against plain Lloyd rounds that compute every distance."""

import hashlib
import math

import numpy as np

from glycotide.llm import vector_codes

from .fixtures import table


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(id, code, error, label_error), the codebooks' hash."""
    kept = [(i, [math.floor(scale * c) for c in v], label) for i, v, label in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((far(y, c), e) for e, c in enumerate(books[p])) for p, y in enumerate(cut(v))] for _, v, _ in kept]

    for _ in range(rounds):
        best = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(v)[p] for (_, v, _), b in zip(kept, best) if b[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    best = assign()
    sums = {}
    for (_, _, label), b in zip(kept, best):
        sums[label] = sums.get(label, 0) + sum(d for d, _ in b)
    out = [(i, "".join(f"{e:02x}" for _, e in b), sum(d for d, _ in b), sums[label]) for (i, _, label), b in zip(kept, best)]
    return sorted(out, key=str), hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()


def compare(df, rows, **sizes):
    got = vector_codes.codes(df, **sizes).collect()
    want, digest = plain(rows, **sizes)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == want
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_codes_equal_plain_rounds(spark):
    vectors = table(spark, "embeddings").limit(400)
    vectors = vectors.sparkSession.createDataFrame(vectors.collect(), vectors.schema).repartition(5)
    compare(vectors, [tuple(r) for r in vectors.select("vec_id", "embedding", "label").collect()], entries=32)


def test_ties_repeats_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    rows = [(int(i), [float(x) / 1024 for x in rng.integers(-2, 3, 8)], int(i) % 3 if i % 5 else None) for i in rng.integers(-40, 400, 300)]
    rows += [rows[0], rows[0], (None, [0.5] * 8, 1), (1, None, 1), (2, [None] * 8, 1), (3, [0.1] * 7 + [nan], 2), (4, [inf] + [0.0] * 7, 2), (5, [-inf] * 8, None), (6, [], 1)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "vec_id long, embedding array<double>, label int, key string, x string, _label string").repartition(7)
    compare(df, rows, entries=16)
    compare(df, rows, entries=256, parts=2, rounds=2)
    other = df.union(spark.createDataFrame([(9, [1.0] * 4, 1, "x", "y", "z")], df.schema))  # of another length than most
    compare(other, rows, entries=16, rounds=1)


def test_fewer_vectors_than_entries_and_none(spark):
    rows = [(2, [0.25, -0.25, 0.1, 0.0], 1), (1, [0.5, 0.5, 0.5, 0.5], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    compare(df, [(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert vector_codes.codes(df.limit(0)).collect() == []
    assert vector_codes.codes(df.selectExpr("vec_id", "array(get(embedding, 9)) AS embedding", "label")).collect() == []


def test_bounds_rule_out_distances_and_stay_bounds():
    rng = np.random.default_rng(1)
    centres = rng.integers(-500, 500, (20, 6))
    x = (centres[rng.integers(0, 20, 800)] + rng.integers(-30, 31, (800, 6))).astype(np.int64)
    entries = x[:64].copy()
    code, upper, lower, _ = vector_codes.first_codes(x, entries)
    for step in range(4):
        new = entries + rng.integers(-4, 5, entries.shape) * (rng.random(64) < 0.5)[:, None]
        moved = np.sqrt(((new - entries) ** 2).sum(1).astype(float)) * (1 + vector_codes.SLACK)
        entries = new
        code, upper, lower, computed = vector_codes.next_codes(x, entries, moved, code, upper, lower)
        d = vector_codes.squared(x, entries)
        assert (code == d.argmin(1)).all()
        assert (upper.astype(float) ** 2 >= d[np.arange(len(x)), code] * (1 - 1e-9)).all() and (lower.astype(float) ** 2 <= d * (1 + 1e-9)).all()
        assert computed < 0.3 * d.size


def test_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0, 0.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    try:
        vector_codes.codes(df)
    except ValueError as e:
        assert "or more" in str(e)
    else:
        raise AssertionError
