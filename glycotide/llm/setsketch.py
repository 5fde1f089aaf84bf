"""Near duplicates by SetSketch registers: banded for candidates, compared by joint likelihood, verified on full sets.

A register of a set is floor(1 - log_B(x)), where x is the smallest of its elements' exponential hashes of rate A, truncated
to two bytes. Registers merge by their maximum; two sets have equal ones about as often as they share elements.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glycotide.llm.components import components
from glycotide.llm.repeated_spans import _binary, _keyed, _powers
from glycotide.llm.shared import fresh, join_by_count, require, text_or_empty, tidy, written

REGISTERS, BANDS, BASE, RATE = 128, 32, 1.001, 20.0
#: Bytes hashed at a time; members up to which all pairs of a band's group are compared; pivots of larger ones; pairs in a block.
AT_ONCE, SMALL, PIVOTS, BLOCK = 1 << 20, 8, 4, 64
#: A tile's members apart, its members, and the bytes of either, about.
TILE_APART, TILE_ALL, TILE_BYTES = 128, 256, 4 << 20
#: Pairs whose likeliest similarity is this much below the threshold are not verified: over 6 standard errors of 128 registers.
MARGIN = 0.25
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MULTIPLIERS = np.random.default_rng(20_240).integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the bytes, and where each starts. A to Z count as lower case."""
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    starts, ends = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    if not len(starts):
        return np.empty(0, np.uint64), starts
    up, down = _powers(len(data))
    symbols = _mix(np.arange(1, 257, dtype=np.uint64))[_FOLD]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(symbols[data] * up, dtype=np.uint64)])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """One hash per k neighbours; fewer words are one sequence, whose length is part of its hash."""
    n = len(words)
    if not n:
        return words
    width = min(n, k)
    h = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i : n - width + 1 + i])
    return h


def shingle_set(data: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct shingle hashes of one text, whole."""
    if len(data) <= AT_ONCE:
        return np.unique(shingle_hashes(word_hashes(data)[0], k))
    pieces, lo = [], 0
    while lo < len(data):  # pieces end between words
        hi = min(lo + AT_ONCE, len(data))
        while hi < len(data) and not _SPACE[data[hi - 1]]:
            hi += 1
        pieces.append(word_hashes(data[lo:hi])[0])
        lo = hi
    return np.unique(shingle_hashes(np.concatenate(pieces), k))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The registers, unsigned 16-bit, of each (non-empty) set of hashes."""
    all_, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), REGISTERS), np.uint16)
    for j, m in enumerate(_MULTIPLIERS):
        low = np.minimum.reduceat(all_ * m, starts)
        x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[:, j] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65_535)
    return out


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity that makes the order of the registers of each pair most likely, given the set sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def log_likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        return more * np.log(up) + less * np.log(down) + (a.shape[1] - more - less) * np.log(np.clip(1 - up - down, 1e-12, 1))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak
        x, y = low + (high - low) / 3, high - (high - low) / 3
        rises = log_likelihood(x) < log_likelihood(y)
        low, high = np.where(rises, x, low), np.where(rises, high, y)
    return (low + high) / 2


SKETCH = "doc_id long, own_id long, n_shingles long, set_1 long, set_2 long, registers binary"


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """Set size, a 128-bit fingerprint of the set, and its registers (null: no words), per row of docs (doc_id, own_id, data)."""

    def run(batches):
        for batch in batches:
            held: list[tuple] = []
            size = 0
            for doc, own, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _binary(batch.column(2))):
                held.append((doc, own, shingle_set(data, k)))
                size += len(held[-1][2])
                if size > AT_ONCE // 8:
                    yield rows(held)
                    held, size = [], 0
            if held:
                yield rows(held)

    def rows(held):
        full = [s for *_, s in held if len(s)]
        regs = iter(registers(full)) if full else iter(())
        one = [int(s.sum(dtype=np.uint64).view(np.int64)) for *_, s in held]
        two = [int(_mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)) for *_, s in held]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in held], pa.int64()), pa.array([x[1] for x in held], pa.int64()), pa.array([len(s) for *_, s in held], pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array([next(regs).tobytes() if len(s) else None for *_, s in held], pa.binary())],
            names=["doc_id", "own_id", "n_shingles", "set_1", "set_2", "registers"],
        )

    return docs.mapInArrow(tidy(run), SKETCH)


def _likely(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose registers don't speak against a similarity of ``least``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (2, 3))
                n_a, n_b = (batch.column(k).to_numpy().astype(float) for k in (4, 5))
                keep = (np.minimum(n_a, n_b) >= least * np.maximum(n_a, n_b)) & (likely_similarity(a, b, n_a, n_b) >= least - MARGIN)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    side = lambda c: sets.select(F.col("id").alias(c), F.col("registers").alias(f"registers_{c}"), F.col("n_shingles").alias(f"n_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "registers_a", "registers_b", "n_a", "n_b").mapInArrow(tidy(run), "a long, b long")


def _verified(pairs: DataFrame, shingles: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs (a, b) with denominator * intersection >= numerator * union on their full sets.

    Pairs of one a meet in blocks of about BLOCK, so that its set is sent once a block and no block grows with a's pairs.
    """
    counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    dealt = pairs.join(counts, "a").withColumn("block", F.struct("a", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / BLOCK).cast("long")).alias("part")))
    dealt = written(dealt.select("a", "b", "block"), "pair-blocks")
    members = dealt.select("block", F.col("b").alias("id")).union(dealt.select("block", "a").distinct())
    rows = members.join(shingles, "id").select(F.xxhash64("block.a", "block.part").alias("group"), F.col("block.a").alias("a"), "id", "shingles")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for a, block in pdf.groupby("a"):  # blocks whose hashes are equal
            sets = {i: np.frombuffer(s, np.uint64) for i, s in zip(block["id"], block["shingles"])}
            for b, s in sets.items():
                if b != a:
                    both = len(np.intersect1d(sets[a], s, assume_unique=True))
                    if denominator * both >= numerator * (len(sets[a]) + len(s) - both):
                        found.append((a, b))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("group").applyInPandas(run, "a long, b long")


def cross_links(sets_a: list[np.ndarray], of_a: np.ndarray, sets_b: list[np.ndarray], of_b: np.ndarray, numerator: int, denominator: int) -> list[tuple[int, int]]:
    """Places (i, j) of similar sets of different components: one j for each i and component of its partners.

    All intersections come from one table: for each member of ``b``, which sets of ``a`` have its elements, summed up.
    """
    words, where = np.unique(np.concatenate(sets_a), return_inverse=True)
    has = np.zeros((len(words) + 1, len(sets_a)), np.uint8)  # the last row: words that no set of a has
    has[where, np.repeat(np.arange(len(sets_a)), [len(x) for x in sets_a])] = 1
    n_a, found = np.array([len(x) for x in sets_a]), []
    for j, b in enumerate(sets_b):
        at = np.searchsorted(words, b)
        at[(at == len(words)) | (words[np.minimum(at, len(words) - 1)] != b)] = len(words)
        both = has[at[at < len(words)]].sum(axis=0, dtype=np.int64)
        found += [(int(i), j) for i in np.flatnonzero((denominator * both >= numerator * (n_a + len(b) - both)) & (of_a != of_b[j]))]
    first: dict[tuple[int, int], tuple[int, int]] = {}
    for i, j in found:
        first.setdefault((i, int(of_b[j])), (i, j))
    return list(first.values())


def _joined_apart(split: DataFrame, shingles: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Links (a, b) between the members apart of each band's group and all others of another component, on full sets.

    split: band, id, component, main. A group's members are dealt to tiles of bounded size; a tile has a block of those
    apart and a block of all, compares them in place and gives the links that connect components, not all pairs.
    """
    rows = split.join(shingles, "id").withColumns({"apart": F.col("component") != F.col("main"), "bytes": F.length("shingles")})
    rows = written(rows.drop("main"), "apart")
    total = lambda c: F.sum(F.when(F.col("apart"), c)), lambda c: F.sum(c)
    blocks = lambda f, count: F.greatest(F.ceil(f(F.lit(1)) / count), F.ceil(f(F.col("bytes")) / TILE_BYTES)).cast("int")
    counts = rows.groupBy("band").agg(blocks(total[0], TILE_APART).alias("a_blocks"), blocks(total[1], TILE_ALL).alias("b_blocks"))
    dealt = rows.join(counts, "band")
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    carried = ["id", "component", "shingles"]
    a = dealt.filter("apart").select("band", block("a_blocks").alias("a_block"), every("b_blocks").alias("b_block"), F.lit(True).alias("is_a"), *carried)
    b = dealt.select("band", every("a_blocks").alias("a_block"), block("b_blocks").alias("b_block"), F.lit(False).alias("is_a"), *carried)

    def run(tile: pa.Table) -> pa.Table:
        is_a = tile.column("is_a").to_numpy()
        ids, of = tile.column("id").to_numpy(), tile.column("component").to_numpy()
        data = [np.frombuffer(x, np.uint64) for x in tile.column("shingles").to_pylist()]
        at_a, at_b = np.flatnonzero(is_a), np.flatnonzero(~is_a)
        links = cross_links([data[k] for k in at_a], of[at_a], [data[k] for k in at_b], of[at_b], numerator, denominator) if len(at_a) else []
        return pa.table([pa.array([ids[at_a[i]] for i, _ in links], pa.int64()), pa.array([ids[at_b[j]] for _, j in links], pa.int64())], names=["a", "b"])

    return a.unionByName(b).groupBy("band", "a_block", "b_block").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, numerator: int = 75, denominator: int = 100, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept (the one document of its component that stays) of each row.

    Links are pairs with denominator * intersection >= numerator * union of their sets of k-word shingles. Equal sets are
    one node from the start. In each band's groups small ones compare all pairs; large ones compare each member with a
    few pivots, and then members that are not in the component of most are compared, in tiles, with all others: that
    finds every component that all pairs would give. A null text is empty; texts without words are linked with nothing; rows that
    repeat an id and a text are one document, rows of one id and several texts are documents of their own. Rows without an
    id link others; they are not kept, and their component_id is null if no row of the component has one. Other columns
    are ignored.
    """
    require(docs, id_col, text_col)
    (key,) = fresh(docs, "_key")
    source = _keyed(docs.select(id_col, text_col), key, id_col, text_col)
    source = source.select(F.col(key).alias("doc_id"), F.col(id_col).cast("long").alias("own_id"), text_or_empty(text_col).cast("binary").alias("data"))
    each = written(sketches(source, k), "sketches")
    with_words = each.filter("n_shingles > 0").withColumn("set", F.struct("n_shingles", "set_1", "set_2"))
    sets = written(with_words.groupBy("set").agg(F.min("doc_id").alias("id"), F.min("own_id").alias("low"), F.count("*").alias("copies"), F.first("registers").alias("registers")).withColumn("n_shingles", F.col("set.n_shingles")), "sets")
    width = 2 * REGISTERS // BANDS
    keys = [F.xxhash64(F.lit(b), F.substring("registers", b * width + 1, width)) for b in range(BANDS)]
    banded = sets.select("id", F.explode(F.array(*keys)).alias("band"))
    groups = banded.groupBy("band").agg(F.count("*").alias("n"), *[F.min(F.struct(F.xxhash64(F.lit(p), "id"), "id")).alias(f"pivot_{p}") for p in range(PIVOTS)]).filter("n > 1")
    groups = written(groups.select("band", "n", F.array_distinct(F.array(*[f"pivot_{p}.id" for p in range(PIVOTS)])).alias("pivots")), "bands")
    members = written(banded.join(groups, "band"), "band-members")
    wanted = members.select("id").distinct()

    def full_sets(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(d, k).tobytes() for d in _binary(batch.column(1))], pa.binary())], names=["id", "shingles"])

    texts = source.select(F.col("doc_id").alias("id"), "data").join(wanted.hint("shuffle_hash"), "id", "left_semi")
    if each.groupBy("doc_id").count().filter("count > 1").head(1):  # rows that repeat an id and a text
        texts = texts.dropDuplicates(["id"])
    shingles = written(texts.mapInArrow(tidy(full_sets), "id long, shingles binary"), "shingles")
    ordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()

    small = members.filter(F.col("n") <= SMALL)
    pairs = small.select("band", F.col("id").alias("a")).join(small.select("band", F.col("id").alias("b")), "band").filter("a < b").select("a", "b")
    large = members.filter(F.col("n") > SMALL)
    pairs = pairs.union(large.select(F.col("id").alias("a"), F.explode("pivots").alias("b")))
    links = written(_verified(written(_likely(ordered(pairs), sets, numerator / denominator), "likely"), shingles, numerator, denominator), "links")
    found = written(components(links), "components")

    if large.head(1):  # members apart from the component that most of their group are in, against all of it
        placed = written(large.select("band", "id").join(found, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component")), "placed")
        counts = placed.groupBy("band", "component").agg(F.count("*").alias("n"))
        main = counts.groupBy("band").agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("apart")).filter("apart > 1")
        split = written(placed.join(main.select("band", F.col("most.component").alias("main")), "band"), "split")
        more = _joined_apart(split.select("band", "id", "component", "main"), shingles, numerator, denominator)
        links = written(links.union(more), "links")
        found = written(components(links), "components")

    by_set = written(sets.join(found, "id", "left").select("set", "copies", "low", F.coalesce("component", "id").alias("component")), "set-components")
    smallest = by_set.groupBy("component").agg(F.min("low").alias("component_id"))
    by_set = by_set.join(smallest, "component").select("set", "copies", "component_id")
    rows = each.withColumn("set", F.struct("n_shingles", "set_1", "set_2")).select("own_id", "doc_id", "n_shingles", "set")
    out = join_by_count(rows, by_set, "set", "copies", each.count(), "doc_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("own_id"))
    return out.select(F.col("own_id").alias("doc_id"), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("own_id"), F.lit(False)).alias("kept"))


def without_near_duplicates(docs: DataFrame, numerator: int = 75, denominator: int = 100, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each component the row of the smallest id. Rows without an id are left out."""
    (id_,) = fresh(docs, "_id")
    kept = near_duplicates(docs, numerator, denominator, k, id_col, text_col).filter("kept").select(F.col("doc_id").alias(id_)).distinct()
    return docs.join(kept.hint("merge"), F.col(id_col).cast("long") == F.col(id_), "left_semi")
