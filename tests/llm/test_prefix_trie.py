"""The prefix trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from glycotide.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, block=100, heads=6, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % block if c >= 0 else -(-c % block))
        whole[c] = said.get(base, [])[:h] + turns[h:] if rebuild else turns
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out = {}
    for path in sorted(members, key=len, reverse=True):
        below = [out[p] for p in children[path]]
        ends = sorted(c for c in members[path] if len(whole[c]) == len(path))
        out[path] = (
            min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]), len(below), sum(b[5] for b in below) or 1,
            sum(b[6] for b in below) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def compare(spark, rows, extra=(), **how):
    df = spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], SCHEMA + "".join(f", `{c}` string" for c in extra)).repartition(6)
    begun = prefix_trie.rebuilt(df) if how.get("rebuild", True) else prefix_trie.as_they_are(df)
    got = prefix_trie.prefix_trie(begun)
    assert got.columns == prefix_trie.COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, **how)


def some(n, seed, words="ab"):
    r = random.Random(seed)
    ids = r.sample(range(-250, 700), n)
    return [(c, t, r.choice(["user", "assistant"]), r.choice(words) * r.randint(1, 2)) for c in ids for t in range(r.randint(1, 8))]


@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_equals_plain(spark, rebuild):
    rows = some(120, 4)
    rows += [(None, 1, "user", "no conversation"), (5000, None, None, None), (5000, 3, "user", "ü\U0001f600"), (5000, 3, "user", "ü\U0001f600"), (5000, 3, "assistant", "tie"), (5001, 1, "", "")]
    compare(spark, rows, extra=["class", "pos", "rep", "a.b", "n", "depth"], rebuild=rebuild)


def test_copies_and_a_very_long_conversation(spark):
    long = [(7, t, "user", f"turn {t}" * (t % 3)) for t in range(1500)]
    copies = [(c, t, "user", f"copy {t}") for c in range(1000, 1300) for t in range(5)]
    twins = [(c, t, "user", f"twin {t}") for c in (2000, 2001) for t in range(400)]
    compare(spark, long + copies + twins, rebuild=False)


def test_small_tables(spark):
    compare(spark, [(3, 0, "user", "only")])
    compare(spark, [(250, 0, "user", "shorter than its own beginning")])  # and no conversation 200: may be left without a turn
    compare(spark, [(c, 0, "user", "x") for c in range(200, 260)])
    df = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(df)).count() == 0
    assert prefix_trie.prefix_trie(prefix_trie.as_they_are(df)).count() == 0


def test_pieces_of_ids_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    compare(spark, [(c, 0, "user", "same") for c in range(0, 300, 3)], rebuild=False)
