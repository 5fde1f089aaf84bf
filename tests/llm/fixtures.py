"""Rows that every operator must stand: nulls, empty and very long texts, ties, repeated rows, clashing names."""

from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"
LONG = "the quick brown fox jumps over a lazy dog while 27 rivers run to the sea " * 4_000
PASSAGE = "".join(f"passage {i * i} of the shared text, " for i in range(40))
EDGE = [
    (1, None), (2, ""), (3, None), (4, "one"), (5, "one"), (5, "one"), (6, "Ünï côdé ▁ text \U0001f600 with\ttabs\nand lines\n"), (7, LONG), (8, LONG + " end"),
    (9, PASSAGE), (10, "before " + PASSAGE), (11, " \t\n "), (12, "a" * 3_000), (None, "without an id"), (None, None), (-13, "a negative id " * 9), (14, "one\none\nTwo words\ntwo words"),
]
#: Names that operators might use for columns of their own.
CLASHING = ["_id", "_row", "_digest", "_sha", "_ranges", "_gone", "keep_id", "n", "size", "token", "set", "data", "shard", "line", "a.b", "key"]


def edge(spark: SparkSession, rows: list | None = None) -> DataFrame:
    rows = EDGE if rows is None else rows
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, *["x"] * len(CLASHING)) for i, t in rows], f"doc_id long, text string, {extra}").repartition(5)


def table(spark: SparkSession, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def shingles(text: str | None, k: int = 5) -> set:
    import re

    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def near_components(rows: list, num: int = 75, den: int = 100) -> dict:
    """id -> smallest id reachable, by all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) * den >= num * max(len(x), len(y)) and den * len(x & y) >= num * len(x | y):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: root(i) for i in sets}


def repeated(rows: list, length: int) -> list[list[bool]]:
    """Per text (bytes): which bytes go."""
    from collections import Counter

    seen = Counter(t[i : i + length] for t in rows for i in range(len(t) - length + 1))
    out = []
    for t in rows:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out
