"""Passages that rows without an id share with others."""

import hashlib
import random
from collections import Counter

import pytest

from glycotide.llm import repeated_spans

from .fixtures import repeated


@pytest.mark.parametrize("hot", [1_000, 3])
def test_rows_without_an_id_are_partners(spark, monkeypatch, hot):
    monkeypatch.setattr(repeated_spans, "HOT", hot)
    rng = random.Random(21)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [noise(n) for n in (41, 60, 90, 300)]
    whole = noise(80)
    rows = [(None, noise(30) + s + noise(50)) for s in shared] + [(k, noise(20) + s + noise(40)) for k, s in enumerate(shared, 1)]
    # a segment that a row without an id has, too, beside one that differs and shares a string with it
    rows += [(10, noise(9) + shared[1]), (None, whole), (11, whole), (12, whole[:70] + noise(60)), (None, noise(70)), (None, noise(5) * 30)]
    rows += [(None, shared[2] + "the same"), (None, shared[2] + "the same"), (None, None), (13, noise(90)), (14, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    raw, want, texts = [(t or "").encode() for _, t in rows], Counter(), Counter()
    for (i, t), data, gone in zip(rows, raw, repeated(raw, 40)):
        stay = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want[i, len(data), sum(gone), spans, hashlib.sha256(stay).hexdigest()] += 1
        parts = "".join(chr(b) if not g else "\0" for b, g in zip(data, gone)).split("\0")
        texts[i, t and "".join(p.encode("latin-1").decode("utf-8", "ignore") for p in parts)] += 1
    got = repeated_spans.remove_repeated(docs, 40)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(map(tuple, got.collect())) == want
    assert Counter(map(tuple, repeated_spans.without_repeated(docs, 40).collect())) == texts
