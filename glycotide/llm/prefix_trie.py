"""The trie of conversations that begin alike, by partition refinement.

All conversations are one class at first. Turn by turn each active class is split by what its members say next; a class of
one conversation is done, and what is left of that conversation is a chain of nodes with one child each. Sums over
subtrees are folded back from the deepest classes to the root.
"""

from __future__ import annotations

import hashlib
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glycotide.llm.shared import discard, join_by_count, parts, require, tidy, written_at

#: Ids that are joined into one piece of text before their hash is taken.
PIECE = 4096
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class _Tables:
    """Tables in the shared folder that go when the trie is made, but for those that the result reads."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        out, path = written_at(df, name)
        self.paths.append(path)
        return out

    def discard(self, n: int = 0) -> None:
        for path in self.paths[: len(self.paths) - n]:
            discard(self.spark, path)


def placed(turns: DataFrame, tables: _Tables, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, said, chars) of each turn, and (conv_id, n_turns, chars).

    pos counts from 0 by turn (null first), role and text; said is the SHA-256 of role and text. Rows are dealt by ranges
    of all of these, so a conversation of any length is spread over tasks: a row's place is that within its range and
    the rows that its conversation has in earlier ranges.
    """
    spark = turns.sparkSession
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")).filter("conv_id is not null")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # the row's number at last, so that equal rows, too, are dealt over ranges
    dealt = rows.withColumn("n", F.monotonically_increasing_id()).repartitionByRange(parts(spark), *order, F.col("n")).sortWithinPartitions(*order)
    said = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    here = tables.written(dealt.select("conv_id", said.alias("said"), F.length("text").cast("long").alias("chars"), F.monotonically_increasing_id().alias("at")), "turns")
    here = here.withColumn("range", F.shiftright("at", 33))
    counts = here.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"), F.sum("chars").alias("chars"))
    counts = tables.written(counts, "turn-counts")  # a row per conversation and range
    earlier = W.partitionBy("conv_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select("conv_id", "range", (F.col("before") - F.col("first")).alias("shift"))
    numbered = here.join(before, ["conv_id", "range"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "said", "chars")
    return numbered, counts.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("chars"))


def rebuilt(turns: DataFrame, block: int = 100, heads: int = 6, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame, _Tables]:
    """Turns and sizes of conversations that begin as the first of their block of ids: for ``prefix_trie``.

    Conversation c has the first h turns of conversation c - c % block (all if it has fewer, none if it isn't there), then
    its own turns after its first h; h is crc32(decimal c) % heads. Rows without a conversation are left out.
    """
    require(turns, conv_col, turn_col, role_col, text_col)
    tables = _Tables(turns.sparkSession)
    numbered, sizes = placed(turns, tables, conv_col, turn_col, role_col, text_col)
    numbered = tables.written(numbered, "placed-turns")
    sizes = sizes.select("conv_id", "n_turns", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"))
    sizes = tables.written(sizes, "sizes")
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    sizes = sizes.join(base, "base", "left").select("conv_id", "base", "h", "n_turns", F.least("h", F.coalesce("base_turns", F.lit(0))).alias("taken"))
    # at most heads - 1 turns of a conversation go to the conversations of its block
    first = numbered.filter(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "base").join(sizes.select("conv_id", "base", "taken"), "base").filter("pos < taken")
    own = numbered.join(sizes.select("conv_id", "h", "taken"), "conv_id").filter("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "pos", "said", "chars"]
    turns = tables.written(first.select(columns).unionByName(own.select(columns)), "rebuilt-turns")
    lengths = sizes.select("conv_id", (F.col("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("ends"))
    return turns, tables.written(lengths, "rebuilt-sizes"), tables


def as_they_are(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame, _Tables]:
    """Turns and sizes of conversations as they are: for ``prefix_trie``."""
    require(turns, conv_col, turn_col, role_col, text_col)
    tables = _Tables(turns.sparkSession)
    numbered, sizes = placed(turns, tables, conv_col, turn_col, role_col, text_col)
    return tables.written(numbered, "placed-turns"), tables.written(sizes.select("conv_id", F.col("n_turns").alias("ends")), "sizes"), tables


def distinct(turns: DataFrame, sizes: DataFrame, tables: _Tables) -> DataFrame:
    """conv_id, rep, ends, copies: conversations that are alike throughout have one ``rep``, the smallest id of them.

    They are told apart by their length and two sums of 64-bit hashes of all their (place, SHA-256) pairs.
    """
    sums = [F.sum(F.xxhash64(F.lit(salt), "pos", "said").cast("decimal(38,0)")).alias(f"s{salt}") for salt in (1, 2)]
    content = sizes.join(turns.groupBy("conv_id").agg(*sums), "conv_id", "left").withColumn("alike", F.concat_ws(" ", "ends", "s1", "s2"))
    content = tables.written(content.select("conv_id", "ends", "alike"), "contents")
    groups = content.groupBy("alike").agg(F.min("conv_id").alias("rep"), F.count("*").alias("copies"))
    total = content.count()
    return tables.written(join_by_count(content, groups, "alike", "copies", total, "conv_id").select("conv_id", "rep", "ends", "copies"), "distinct")


def prefix_trie(conversations: tuple[DataFrame, DataFrame, _Tables]) -> DataFrame:
    """A row per node, that is per distinct sequence of the first ``depth`` turns: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree, each node's (n_convs - 1) * characters of its
    last text), ends_sha256 (of the comma-joined ids of members with just ``depth`` turns).

    No conversations make no nodes. Conversations that are alike throughout go through the rounds as one; so there are as
    many rounds as two different conversations have turns in common, and one more.
    """
    turns, sizes, tables = conversations
    everyone = distinct(turns, sizes, tables)
    spark = everyone.sparkSession
    reps = everyone.filter("conv_id = rep").select("conv_id", "ends", "copies")
    root = reps.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_reps"), F.sum("copies").alias("n_convs")).filter("n_reps > 0")
    root = root.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_reps", "n_convs", F.lit(0).cast("long").alias("chars"))
    levels = [tables.written(root, "classes")]
    head = levels[0].head()
    # members of active classes, those of two conversations or more
    active = reps.withColumn("class", F.lit(head["conv_id"] if head else None).cast("long")) if head and head["n_reps"] > 1 else None
    ended = [reps.limit(0).select("conv_id", F.lit(0).cast("long").alias("node"))]
    while active is not None:
        depth = len(levels)
        ended.append(active.filter(F.col("ends") == depth - 1).select("conv_id", F.col("class").alias("node")))
        said = active.filter(F.col("ends") >= depth).join(turns.filter(F.col("pos") == depth - 1).drop("pos"), "conv_id")
        said = tables.written(said.withColumn("next", F.concat(F.col("class").cast("string"), F.lit(" "), F.hex("said"))).select("conv_id", "ends", "copies", "class", "next", "chars"), "said")
        new = said.groupBy("next").agg(F.min("conv_id").alias("least"), F.first("class").alias("parent_conv_id"), F.count("*").alias("n_reps"), F.sum("copies").alias("n_convs"), F.first("chars").alias("node_chars"))
        new = tables.written(new, "splits")
        levels.append(new.select(F.col("least").alias("conv_id"), F.lit(depth).cast("long").alias("depth"), "parent_conv_id", "n_reps", "n_convs", F.col("node_chars").alias("chars")))
        left = new.agg(F.sum(F.when(F.col("n_reps") > 1, F.col("n_reps")))).head()[0]
        if not left:
            break
        more = join_by_count(said, new.filter("n_reps > 1").select("next", "least", "n_reps"), "next", "n_reps", left, "conv_id")
        active = tables.written(more.filter("least is not null").select("conv_id", "ends", "copies", F.col("least").alias("class")), "active")
    return _folded(levels, reps, turns, everyone, ended, tables)


def _folded(levels: list[DataFrame], reps: DataFrame, turns: DataFrame, everyone: DataFrame, ended: list[DataFrame], tables: _Tables) -> DataFrame:
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    # classes of one conversation: the rest of it is a chain
    alone = tables.written(nodes.filter("n_reps = 1").select("conv_id", F.col("depth").alias("from")).join(reps, "conv_id"), "alone")
    tail = turns.join(alone, "conv_id").filter(F.col("pos") >= F.col("from")).select("conv_id", (F.col("pos") + 1).alias("depth"), "ends", "copies", "chars")
    # only copies save anything on a chain
    saved = tail.filter("copies > 1").select("conv_id", "depth", ((F.col("copies") - 1) * F.col("chars")).alias("own"))
    saved = tables.written(_sums_from(saved, tables), "chains")
    chains = tail.join(saved, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.col("copies").alias("n_convs"), (F.col("ends") > F.col("depth")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved_tokens"))
    below = saved.join(alone.select("conv_id", (F.col("from") + 1).alias("depth")), ["conv_id", "depth"]).select("conv_id", F.col("saved").alias("tail"))
    below = alone.select("conv_id", F.col("from").alias("depth"), (F.col("ends") > F.col("from")).cast("long").alias("more")).join(below, "conv_id", "left")
    below = tables.written(below, "alone-below")
    folded, children = [], None
    for depth in range(len(levels) - 1, -1, -1):
        here = levels[depth].join(below.filter(F.col("depth") == depth).drop("depth"), "conv_id", "left")
        if children is not None:
            sums = children.groupBy(F.col("parent_conv_id").alias("conv_id")).agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
            here = here.join(sums, "conv_id", "left")
        else:
            here = here.withColumns({x: F.lit(None).cast("long") for x in "cls"})
        own = (F.col("n_convs") - 1) * F.col("chars")
        children = tables.written(here.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("c", "more", F.lit(0)).alias("n_children"), F.coalesce("l", F.lit(1)).alias("n_leaves"),
            (own + F.coalesce("s", "tail", F.lit(0))).alias("saved_tokens")), "folded")
        folded.append(children)
    for level in folded:
        chains = chains.unionByName(level)
    where = alone.select("conv_id", F.col("conv_id").alias("node"))
    for some in ended:
        where = where.unionByName(some)
    ends = _hashed(everyone.join(where.withColumnRenamed("conv_id", "rep"), "rep").select("node", "ends", "conv_id"))
    out = chains.join(ends, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))).select(COLUMNS)
    out = tables.written(out, "trie")
    tables.discard(1)
    return out


def _sums_from(rows: DataFrame, tables: _Tables) -> DataFrame:
    """conv_id, depth, saved: the sum of ``own`` from each depth of a conversation on, with long conversations spread over ranges."""
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(parts(spark), "conv_id", "depth").select("conv_id", "depth", "own", F.spark_partition_id().alias("range"))
    dealt = tables.written(dealt, "chain-turns")
    totals = dealt.groupBy("conv_id", "range").agg(F.sum("own").alias("n"))
    after = totals.withColumn("after", F.coalesce(F.sum("n").over(W.partitionBy("conv_id").orderBy(F.desc("range")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("conv_id", "range", "after")
    within = F.sum("own").over(W.partitionBy("conv_id", "range").orderBy(F.desc("depth")))
    return dealt.withColumn("within", within).join(after, ["conv_id", "range"]).select("conv_id", "depth", (F.col("within") + F.col("after")).alias("saved"))


def _hashed(ends: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of rows (node, ends, conv_id).

    Ids are joined into pieces where ranges of (node, id) put them; the pieces of a node then meet in order, as a hash of a
    sequence can only be taken along it, and are hashed one after the other without being kept.
    """
    spark = ends.sparkSession

    def pieces(batches):
        key, first, ids = None, 0, []
        for node, depth, i in _rows(batches):
            if (node, depth) != key or len(ids) == PIECE:
                if ids:
                    yield *key, first, ",".join(ids)
                key, first, ids = (node, depth), i, []
            ids.append(str(i))
        if ids:
            yield *key, first, ",".join(ids)

    def hashes(batches):
        key, running = None, None
        for node, depth, _, ids in _rows(batches):
            if (node, depth) == key:
                running.update(b"," + ids.encode())
                continue
            if key:
                yield *key, running.hexdigest()
            key, running = (node, depth), hashlib.sha256(ids.encode())
        if key:
            yield *key, running.hexdigest()

    rows = ends.select("node", F.col("ends").alias("depth"), "conv_id").repartitionByRange(parts(spark), "node", "depth", "conv_id").sortWithinPartitions("node", "depth", "conv_id")
    joined = rows.mapInArrow(tidy(_batched(pieces, ["node", "depth", "first", "ids"])), "node long, depth long, first long, ids string")
    hashed = joined.repartition(parts(spark), "node", "depth").sortWithinPartitions("node", "depth", "first")
    return hashed.mapInArrow(tidy(_batched(hashes, ["conv_id", "depth", "ends_sha256"])), "conv_id long, depth long, ends_sha256 string")


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batched(make, names: list[str], size: int = 256):
    """For mapInArrow: batches of the tuples that ``make`` yields."""

    def run(batches):
        for rows in batched(make(batches), size):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)

    return run
