"""Removal of long byte strings that occur more than once in a corpus, by interval expansion on Burrows-Wheeler transforms.

Strings of L bytes are dealt to groups by content. The anchor of a string is the smallest hash of its 16-byte windows, so
equal strings have equal anchors and meet. A document's starts fall into short runs of one anchor each, segments. Equal
segments are collapsed by their hash before anything is shuffled; different ones of an anchor need their bytes only if
three quarters of a string around the anchor can be equal. Those go in buckets to tasks that sort a bucket's suffixes,
transform it, and derive common prefixes by increasing value; what reaches L unset is repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from glycotide.llm.shared import fresh, join_by_count, parts, require, text_or_empty, tidy, written

WINDOW = 16
#: Starts in one segment at most; bytes hashed at a time; bytes in a bucket; different segments from which an anchor is hot;
#: starts in a cell of a hot anchor's segment, at first and each time that cells are cut further.
LONGEST_RUN, AT_ONCE, BUCKET, HOT, CELLS_OF = 512, 1 << 19, 1 << 19, 1_000, (32, 8, 2, 1)
_K = np.uint64(0x9E3779B97F4A7C15)
_K_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _K), ("down", _K_INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def window_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 bytes at each place of ``data`` but the last 15."""
    n = len(data) - WINDOW + 1
    padded = np.concatenate([data, np.zeros(24, np.uint8)])
    words = np.empty(-(-(n + 8) // 8) * 8, np.uint64)
    for k in range(8):
        column = words[k::8]
        column[:] = np.frombuffer(padded[k : k + 8 * len(column)].tobytes().ljust(8 * len(column), b"\0"), "<u8")
    h = words[:n] * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h += words[8 : n + 8]
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    h *= _K
    h ^= h >> np.uint64(29)
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    n, step, m = len(h) - width + 1, 1, h
    while 2 * step <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    return np.minimum(m[:n], m[width - step : width - step + n])


def segments_of(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """first start, number of starts, anchor, content hash of the segments of one text (all its starts, in order).

    Then, whether the anchor's value is in the text more than once: only such segments can repeat themselves. Then four
    prints: a string that begins k quarters before the anchor, or up to one more, has the k quarters before it and the
    3 - k behind it. Print k is a hash of those bytes; 0 if the segment has no such string.
    """
    h = window_hashes(data)
    anchors = sliding_min(h, length - WINDOW + 1)
    n = len(anchors)
    cuts = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
    first = np.concatenate([[0], cuts])
    sizes = np.diff(np.concatenate([first, [n]]))
    if sizes.max() > LONGEST_RUN:
        pieces = -(-sizes // LONGEST_RUN)
        at = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, ends = np.repeat(first, pieces) + at * LONGEST_RUN, np.repeat(first + sizes, pieces)
        sizes = np.minimum(ends - first, LONGEST_RUN)
    up, down = _powers(len(h))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up, dtype=np.uint64)])
    content = (sums[first + sizes + length - WINDOW] - sums[first]) * down[first]
    at = np.flatnonzero(h <= anchors.max())
    low, which, times = np.unique(h[at], return_inverse=True, return_counts=True)
    own = np.searchsorted(low, anchors[first])
    # the anchor's place: the first, from the segment's first start on, that has its value
    keys = np.sort(which * (len(h) + 1) + at)
    place = keys[np.searchsorted(keys, own * (len(h) + 1) + first)] % (len(h) + 1)
    quarter, last, prints = (length - WINDOW) // 4, first + sizes - 1, []
    for k in range(4):
        begin = place - k * quarter
        there = (first <= begin) & ((last > begin - quarter) | (k == 3))
        x = np.where(there, begin, 0)
        value = ((sums[x + 3 * quarter + 1] - sums[x]) * down[x]) >> np.uint64(32) | np.uint64(1)
        prints.append(np.where(there, value, 0).astype(np.uint32).view(np.int32))
    return first, sizes, anchors[first], content, times[own] > 1, *prints


def _binary(column) -> Iterator[np.ndarray]:
    """Each value's bytes, without a copy."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield data[a:b]


PRINTS = [f"print_{k}" for k in range(4)]
SEGMENT = "doc_id long, first long, size int, anchor long, content long, again boolean, " + ", ".join(f"{c} int" for c in PRINTS)


def _segments(length: int):
    def run(batches):
        for batch in batches:
            held: list[list] = [[] for _ in range(10)]
            for doc, data in zip(batch.column(0).to_pylist(), _binary(batch.column(1))):
                for lo in range(0, len(data) - length + 1, AT_ONCE):
                    first, sizes, anchors, content, *rest = segments_of(data[lo : lo + AT_ONCE + length - 1], length)
                    for to, x in zip(held, (np.full(len(first), doc), first + lo, sizes.astype(np.int32), anchors.view(np.int64), content.view(np.int64), *rest)):
                        to.append(x)
                if len(held[0]) >= 2_000:
                    yield _batch(held)
                    held = [[] for _ in range(10)]
            if held[0]:
                yield _batch(held)

    def _batch(held):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in held], names=["doc_id", "first", "size", "anchor", "content", "again", *PRINTS])

    return run


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The rotations of ``text``, in order of their first ``depth`` symbols at least, and each place's 5-symbol key."""
    n = len(text)
    key, around = np.zeros(n, np.uint64), np.concatenate([text, text[:5]])
    for k in range(5):
        key = (key << np.uint64(8)) | around[k : k + n]
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    places = np.arange(n, dtype=np.uint64)
    small = 40 + int(bits) <= 64 and 3 * int(bits) <= 64
    if small:
        packed = np.sort((key << bits) | places)
        order, sorted_key = packed & ((np.uint64(1) << bits) - np.uint64(1)), packed >> bits
    else:
        order = np.argsort(key, kind="stable").astype(np.uint64)
        sorted_key = key[order]
    rank, known = np.empty(n, np.uint64), 5
    while True:
        new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])]).astype(np.uint64)
        rank[order] = new
        if known >= depth or new[-1] == n - 1:
            return order.astype(np.int64), key
        second = np.concatenate([rank[known % n :], rank[: known % n]])
        if small:
            packed = np.sort((((rank << bits) | second) << bits) | places)
            order, sorted_key = packed & ((np.uint64(1) << bits) - np.uint64(1)), packed >> bits
        else:
            pair = (rank << np.uint64(32)) | second
            order = np.argsort(pair, kind="stable").astype(np.uint64)
            sorted_key = pair[order]
        known *= 2


def repeated_places(text: np.ndarray, length: int) -> np.ndarray:
    """Whether the string of ``length`` symbols at each place of the circular ``text`` is at another place, too.

    Breadth-first backward extension: the intervals of all strings w of a length are extended by each symbol c before
    them; the right border of cw, where it is not set yet, gets the value |w| as its common prefix, and cw goes on. Strings
    up to 5 symbols are read off the sort keys. Borders that have no value when |w| reaches ``length`` have at least that.
    """
    n = len(text)
    order, key = suffix_order(text, length)
    bwt = text[order - 1]
    lf = np.empty(n, np.int64)
    by_symbol = np.argsort(bwt, kind="stable")
    lf[by_symbol] = np.arange(n)
    # the places before and after, in the transform, of the same symbol
    before, after = np.full(n, -1, np.int64), np.full(n, n, np.int64)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    after[by_symbol[:-1][same]] = by_symbol[1:][same]

    sorted_key = key[order]
    differ = sorted_key[1:] ^ sorted_key[:-1]
    border = np.zeros(n + 1, bool)  # border[i]: the common prefix of rows i-1 and i is known and shorter than length
    border[0] = border[n] = True
    border[1:n] = differ != 0
    last_only = np.concatenate([(differ != 0) & (differ < 256), [False]])  # common prefix 4: goes on from there
    ends = np.flatnonzero(last_only)
    starts_all = np.flatnonzero(border[:n])
    left = starts_all[np.searchsorted(starts_all, ends, side="right") - 1]
    right = ends
    for _ in range(5, length):
        if not len(left):
            break
        sizes = right - left + 1
        total = int(sizes.sum())
        at = np.arange(total) + np.repeat(left - (np.cumsum(sizes) - sizes), sizes)
        to = lf[at]
        new_left = np.sort(to[before[at] < np.repeat(left, sizes)])
        new_right = np.sort(to[after[at] > np.repeat(right, sizes)])
        fresh = ~border[new_right + 1]
        left, right = new_left[fresh], new_right[fresh]
        border[right + 1] = True
    out = np.empty(n, bool)
    out[order] = ~border[:n] | ~border[1:]
    return out


RANGE = "doc_id long, first long, last long"


def _expand(length: int):
    """Repeated starts of the segments of one bucket, as ranges; segments that are repeated whole are partners only."""

    def run(table: pa.Table) -> pa.Table:
        docs, firsts, sizes = (table.column(k).to_numpy() for k in ("doc_id", "first", "size"))
        whole = table.column("copies").to_numpy() > 1
        pieces, at, n = [], [], 0
        for chunk in table.column("bytes").chunks:
            for data in _binary(chunk):
                pieces += [data.astype(np.uint16) + 1, np.zeros(1, np.uint16)]
                at.append(n)
                n += len(data) + 1
        text = np.concatenate(pieces)
        symbols, text = np.unique(text, return_inverse=True)
        if len(symbols) > 256:  # all 256 bytes and the end: no text in UTF-8 has them
            raise ValueError("too many symbols")
        twice = repeated_places(text.astype(np.uint8), length)
        out = [[], [], []]
        for k in np.flatnonzero(~whole):
            x = np.diff(np.concatenate([[False], twice[at[k] : at[k] + sizes[k]], [False]]).astype(np.int8))
            a, b = np.flatnonzero(x == 1), np.flatnonzero(x == -1)
            for to, y in zip(out, (np.full(len(a), docs[k]), firsts[k] + a, firsts[k] + b)):
                to.append(y)
        return pa.table([np.concatenate(x) if x else np.empty(0, np.int64) for x in out], names=["doc_id", "first", "last"])

    return run


def _with_bytes(wanted: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of segments (doc_id, first, size, anchor, copies)."""
    names = ("doc_id", "first", "size", "anchor", "copies", "bytes")

    def run(batches):
        for batch in batches:
            rows, held = {k: [] for k in names}, 0
            for doc, data, todo in zip(batch.column(0).to_pylist(), _binary(batch.column(1)), batch.column(2).to_pylist()):
                for x in todo:
                    rows["doc_id"].append(doc)
                    for k in ("first", "size", "anchor", "copies"):
                        rows[k].append(x[k])
                    rows["bytes"].append(data[x["first"] : x["first"] + x["size"] + length - 1].tobytes())
                    held += x["size"] + length
                if held > 4 << 20:
                    yield made(rows)
                    rows, held = {k: [] for k in names}, 0
            yield made(rows)

    def made(rows):
        return pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(rows.items(), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))})

    todo = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("first", "size", "anchor", "copies")).alias("todo"))
    return docs.join(todo.hint("shuffle_hash"), "doc_id").select("doc_id", "data", "todo").mapInArrow(tidy(run), "doc_id long, first long, size int, anchor long, copies long, bytes binary")


CELLS = "doc_id long, first long, size int, copies long, one long, two long, content long, bytes binary"


def _cells(length: int, width: int):
    """Segments cut into cells of ``width`` starts at most, by their distance from the anchor, so that equal strings are in like cells.

    (one, two) are hashes of the bytes that all strings of a cell have, whether the segment has all of them or not;
    ``content`` is one of the cell's bytes. With a width of 1, a cell is a string.
    """

    def run(batches):
        for batch in batches:
            docs, firsts, sizes, copies = (batch.column(k).to_numpy() for k in (0, 1, 2, 3))
            for k, data in enumerate(_binary(batch.column(4))):
                h, n = window_hashes(data), int(sizes[k])
                starts = np.arange(n)
                found = np.flatnonzero(h == h[: length - WINDOW + 1].min())
                place = found[np.searchsorted(found, starts)]
                cell = (place - starts) // width
                cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (place[1:] != place[:-1])) + 1
                first = np.concatenate([[0], cuts])
                count = np.diff(np.concatenate([first, [n]]))
                common = place[first] - cell[first] * width  # where the bytes that all its strings have begin
                up, down = _powers(len(h))
                columns = []
                for x in (h, (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up, dtype=np.uint64)])
                    columns.append(((sums[common + length - width - WINDOW + 2] - sums[common]) * down[common]).view(np.int64))
                whole = (sums[first + count + length - WINDOW] - sums[first]) * down[first]
                whole = whole * _K + ((place[first] - first) * (LONGEST_RUN + 1) + count).astype(np.uint64)
                raw = [data[a : a + c + length - 1].tobytes() if width > 1 else None for a, c in zip(first.tolist(), count.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), docs[k])), pa.array(firsts[k] + first), pa.array(count.astype(np.int32)), pa.array(np.full(len(first), copies[k])), *map(pa.array, columns), pa.array(whole.view(np.int64)), pa.array(raw, pa.binary())],
                    names=["doc_id", "first", "size", "copies", "one", "two", "content", "bytes"],
                )

    return run


def _repeated_cells(cells: DataFrame) -> DataFrame:
    """The cells whose common bytes are in another cell, too, with ``same``: whether all those cells are equal."""
    groups = cells.groupBy("one", "two").agg(F.count("*").alias("rows"), F.sum("copies").alias("sum"), (F.min("content") == F.max("content")).alias("same")).filter("sum > 1")
    groups = written(groups.select(F.struct("one", "two").alias("key"), "rows", "same"), "repeated-cells")
    return join_by_count(cells.withColumn("key", F.struct("one", "two")), groups, "key", "rows", cells.count(), "doc_id").filter("same is not null")


def _hot_ranges(segments: DataFrame, length: int) -> DataFrame:
    """Repeated starts of the segments of hot anchors: cells whose mates are equal are repeated whole, those without a mate not at all.

    Cells with mates that differ are cut further, down to single strings. The edge of a passage that many texts share
    lies in one cell of each text, so a level has a few rows per text and none has a row per start.
    """
    cells, out = segments.select("doc_id", "first", "size", "copies", "bytes"), None
    for width in (w for w in CELLS_OF if w <= length - WINDOW):
        cells = written(cells.mapInArrow(tidy(_cells(length, width)), CELLS), f"cells-{width}")
        found = written(_repeated_cells(cells), f"found-cells-{width}")
        span = found.filter("same and copies = 1").select("doc_id", "first", (F.col("first") + F.col("size")).alias("last"))
        out = span if out is None else out.unionByName(span)
        cells = found.filter("not same").select("doc_id", "first", "size", "copies", "bytes")
    return out


def _with_possible_mates(segments: DataFrame) -> DataFrame:
    """Segments (anchor, content, size, prints) that share a print with another of their anchor.

    Anchors of which a text has the value twice keep all segments: which place a string has isn't known there.
    """
    odd = segments.groupBy("anchor").agg(F.max("again").alias("odd"))
    marked = written(segments.join(odd, "anchor"), "marked-segments")
    prints = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("value")) for k, c in enumerate(PRINTS)]))
    each = marked.filter("not odd").select("anchor", "content", "size", prints.alias("print")).filter("print.value <> 0")
    shared = each.groupBy("anchor", "print").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", "print")
    good = each.join(shared.hint("merge"), ["anchor", "print"], "left_semi").select("anchor", "content", "size").distinct()
    return marked.filter("odd").unionByName(marked.join(good.hint("merge"), ["anchor", "content", "size"], "left_semi")).drop("odd", *PRINTS)


def repeated_ranges(docs: DataFrame, length: int) -> DataFrame:
    """Ranges [first, last) of the starts, per doc_id, whose ``length`` bytes start anywhere else too. docs: doc_id, data."""
    segments = written(docs.mapInArrow(tidy(_segments(length)), SEGMENT), "segments")
    same = ["anchor", "content", "size"]
    at = F.min(F.struct("doc_id", "first", *PRINTS)).alias("at")
    distinct = written(segments.groupBy(*same).agg(F.count("*").alias("copies"), at, F.max("again").alias("again")), "distinct-segments")
    whole = distinct.filter("copies > 1").select(F.struct(*same).alias("key"), "copies", F.lit(True).alias("twice"))
    whole = join_by_count(
        segments.select("doc_id", "first", F.col("size").alias("_size"), F.struct(*same).alias("key")), whole, "key", "copies", segments.count(), "doc_id"
    ).filter("twice").select("doc_id", "first", (F.col("first") + F.col("_size")).alias("last"))
    # anchors that have different segments, of which some may share strings, or one that may repeat itself
    alone = F.max(F.col("again") & (F.col("copies") == 1))
    anchors = distinct.groupBy("anchor").agg(F.count("*").alias("contents"), alone.alias("_alone")).filter("contents > 1 or _alone").drop("_alone")
    several = distinct.join(anchors.select("anchor"), "anchor").select("at.*", "size", "anchor", "content", "copies", "again")
    possible = written(_with_possible_mates(several), "possible-segments")
    apart = possible.join(possible.groupBy("anchor").agg(F.count("*").alias("contents")), "anchor")
    apart = written(apart.filter("contents > 1 or again and copies = 1").select("doc_id", "first", "size", "anchor", "copies", "contents"), "apart")
    rows = written(_with_bytes(apart, docs, length), "segment-bytes")
    hot = apart.filter(F.col("contents") > HOT).select("anchor").distinct()
    has_hot = bool(hot.head(1))
    cold = rows.join(hot.hint("shuffle_hash"), "anchor", "left_anti") if has_hot else rows
    total = rows.agg(F.sum(F.length("bytes"))).first()[0] or 0
    buckets = max(parts(docs.sparkSession), -(-total // BUCKET))
    found = cold.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).groupBy("bucket").applyInArrow(_expand(length), RANGE)
    out = whole.unionByName(found)
    if has_hot:
        out = out.unionByName(_hot_ranges(rows.join(hot.hint("shuffle_hash"), "anchor", "left_semi"), length))
    return out


def _gone(n: int, found: list | None, length: int) -> np.ndarray:
    """Which of n bytes are in a string that starts in one of the ranges."""
    change = np.zeros(n + 1, np.int32)
    for x in found or ():
        change[x["first"]] += 1
        change[x["last"] + length - 1] -= 1
    return np.cumsum(change[:-1]) > 0


def _text(data: np.ndarray, gone: np.ndarray) -> str:
    """What stays of a text; a letter of which a byte goes, goes whole."""
    raw, edges = data.tobytes(), np.diff(np.concatenate([[False], ~gone, [False]]).astype(np.int8))
    return "".join(raw[a:b].decode("utf-8", "ignore") for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)))


def _keyed(docs: DataFrame, key: str, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the column ``key``: a row's id; for rows without one, and for ids of several texts, a hash of both.

    So each key stands for one text, and rows without an id are partners, too, and lose what they share. Rows of one
    text and no id, and rows that repeat an id and a text, are copies of each other.
    """
    own, text = F.col(id_col).cast("long"), text_or_empty(text_col)
    texts = docs.groupBy(own.alias("_shared_id")).agg(F.min(F.xxhash64(text)).alias("low"), F.max(F.xxhash64(text)).alias("high"))
    several = written(texts.filter("_shared_id is not null and low <> high").select("_shared_id"), "ids-of-several-texts")
    both = F.xxhash64(own, text)
    if not several.head(1):
        return docs.withColumn(key, F.coalesce(own, both))
    joined = docs.join(several.hint("shuffle_hash"), own == F.col("_shared_id"), "left")
    return joined.withColumn(key, F.when(own.isNull() | F.col("_shared_id").isNotNull(), both).otherwise(own)).drop("_shared_id")


def without_repeated(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with the bytes that ``remove_repeated`` removes taken out of their texts.

    A letter of which a byte goes, goes whole, so texts stay texts. Texts that lose nothing stay as they are, null ones too.
    """
    require(docs, id_col, text_col)
    key, id_, found = fresh(docs, "_key", "_id", "_ranges")
    keyed = _keyed(docs, key, id_col, text_col)
    source = keyed.select(F.col(key).alias("doc_id"), text_or_empty(text_col).cast("binary").alias("data"))
    ranges = repeated_ranges(source, length).groupBy(F.col("doc_id").alias(id_)).agg(F.collect_list(F.struct("first", "last")).alias(found))
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).cast(pa.large_string())
            todo = batch.column(batch.num_columns - 1)
            if todo.null_count < len(todo):
                out = []
                for text, found in zip(texts.to_pylist(), todo.to_pylist()):
                    if found and text is not None:
                        data = np.frombuffer(text.encode(), np.uint8)
                        text = _text(data, _gone(len(data), found, length))
                    out.append(text)
                texts = pa.array(out, pa.large_string())
            columns = [c for c in batch.columns[:-1]]
            columns[place] = texts.cast(batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    joined = keyed.join(ranges.hint("shuffle_hash"), F.col(key) == F.col(id_), "left").select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)], found)
    numbered = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema)])  # names with dots don't get through
    return joined.mapInArrow(tidy(run), numbered).toDF(*docs.columns)


def remove_repeated(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row; with ``kept`` also what stays, as text (letters cut in two go whole).

    Each byte goes that is in a string of ``length`` bytes that starts at two places or more of the corpus, the same text
    included. Places count in the input as it is. A null text is empty; texts shorter than ``length`` lose nothing; rows
    that repeat an id and a text count as copies of each other, rows of one id and several texts as documents of their
    own. Rows without an id count, and lose what they share, like others. Other columns are ignored.
    """
    require(docs, id_col, text_col)
    if length < 2 * WINDOW:
        raise ValueError(f"length must be at least {2 * WINDOW}")
    (key,) = fresh(docs, "_key")
    rows = _keyed(docs.select(id_col, text_col), key, id_col, text_col).select(F.col(id_col).cast("long").alias("id"), F.col(key).alias("doc_id"), text_or_empty(text_col).cast("binary").alias("data"))
    ranges = repeated_ranges(rows.select("doc_id", "data"), length).groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1_000):
                some = batch.slice(lo, 1_000)
                out: list[tuple] = []
                for doc, data, found in zip(some.column(0).to_pylist(), _binary(some.column(1)), some.column(2).to_pylist()):
                    gone = _gone(len(data), found, length)
                    stay = data[~gone].tobytes() if found else data.tobytes()
                    spans = int(np.count_nonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1)) if found else 0
                    out.append((doc, len(data), len(data) - len(stay), spans, hashlib.sha256(stay).hexdigest(), *([_text(data, gone)] if kept else [])))
                columns = list(zip(*out)) or [[]] * (5 + kept)
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"][: 5 + kept])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * kept
    return rows.join(ranges.hint("shuffle_hash"), "doc_id", "left").select("id", "data", "ranges").mapInArrow(tidy(run), schema)
