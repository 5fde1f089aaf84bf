"""The factorization machine: interactions, held-out labels, and rows that must not reach the fit."""

import zlib

import numpy as np

from glycotide.llm import toxicity

from .fixtures import EDGE, edge


def test_pairs_that_no_sum_of_weights_tells_apart():
    """Terms 1 and 2 are toxic with 3 and 4, each with its own: every term alone says nothing."""
    rng = np.random.default_rng(0)
    rows = [[a, b, *(5 + rng.choice(20, 4, replace=False))] for a in (1, 2) for b in (3, 4) for _ in range(100)]
    toxic = np.array([float((r[0] == 1) == (r[1] == 3)) for r in rows])
    starts, terms = np.arange(0, 6 * len(rows) + 1, 6), np.array(rows).ravel()
    right = {}
    for factors in (1, 4):
        bias, table = toxicity.fit_machine(starts, terms, toxic, 24, factors=factors, shrink=0.05)
        if factors == 1:
            table[:, 1:] = 0  # weights alone
        machine = toxicity.FactorizationMachine(bias, np.arange(25, dtype=np.int32), table)
        right[factors] = np.mean([(machine.log_odds(np.array(sorted(r))) >= 0) == t for r, t in zip(rows, toxic)])
    assert right[4] > 0.97 and right[1] < 0.7


def test_log_odds_are_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    table = rng.normal(size=(9, 4)).astype(np.float32)
    machine = toxicity.FactorizationMachine(0.25, np.arange(9, dtype=np.int32), table)
    some = np.array([1, 3, 4, 8])
    want = 0.25 + table[some, 0].astype(float).sum() + sum(float(table[a, 1:].astype(float) @ table[b, 1:].astype(float)) for i, a in enumerate(some) for b in some[i + 1 :])
    assert abs(machine.log_odds(some) - want) < 1e-9
    assert machine.log_odds(np.array([0])) == machine.log_odds(np.array([], np.int64)) == 0.25


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    assert len(got) == docs.count()
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    bad, good = [got[i] for i, t in known.items() if t == 1 and i in got and got[i].held_out], [got[i] for i, t in known.items() if t == 0 and i in got and got[i].held_out]
    assert len(bad) > 50 and np.mean([r.predicted for r in bad]) >= 0.85 and np.mean([r.predicted for r in good]) <= 0.02
    ranks = np.argsort(np.argsort([r.score for r in bad + good], kind="stable"), kind="stable")
    assert (ranks[: len(bad)].sum() - len(bad) * (len(bad) - 1) / 2) / (len(bad) * len(good)) > 0.97


def some(spark, flip=()):
    rows = [(i, f"word{i % 7} and " + ("vile rotten" if i % 3 == 0 else "plain fine") + f" thing{i % 11}") for i in range(300)]
    labels = [(i, int(i % 3 == 0) ^ (i in flip)) for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_rows_and_other_labels_teach_nothing(spark):
    docs, labels = some(spark)
    base = {r.doc_id: r.score for r in toxicity.scored(docs, labels).collect()}
    assert all((s >= 0.5) == (i % 3 == 0) for i, s in base.items())
    out = {i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0}
    _, flipped = some(spark, out)
    assert {r.doc_id: r.score for r in toxicity.scored(docs, flipped).collect()} == base
    # labels of rows that aren't there, differing labels of one id and other numbers: 5,000 of them for a sample of 300
    more = labels.union(spark.createDataFrame([(i, i % 2) for i in range(1000, 6000)], labels.schema)).union(spark.createDataFrame([(None, 1), (7, None)], labels.schema))
    machine = toxicity.fit(docs, more, sample=300)
    assert {r.doc_id: r.score for r in toxicity.score(docs, machine).collect()} == base


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 1), (5, 0), (None, 1)], "doc_id long, toxic int")
    got = toxicity.scored(edge(spark), labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in EDGE)
    assert all(0 <= r.score <= 1 for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert {r.score for r in toxicity.scored(edge(spark), labels.limit(0)).collect()} == {0.0}
    assert toxicity.scored(edge(spark, []), labels).count() == 0
