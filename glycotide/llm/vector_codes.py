"""Product codes of vectors: Lloyd's rounds over integer parts, with Elkan's bounds instead of most distances.

Each vector is cut into equal parts and each part gets the number of its nearest codebook entry. Between rounds every part
keeps an upper bound of the distance to its entry and a lower bound of the distance to every entry, both moved by as much
as entries have moved; an entry is only looked at if no strict inequality rules it out, and then by exact integers.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glycotide.llm.shared import discard, join_by_count, require, tidy, written_at

#: Squares and their sums are exact for whole numbers below this; larger components are refused.
LARGEST = 1 << 24
#: Rows of a batch that are looked at together: some 256 distances a row.
ROWS = 2048
#: Relative room for the rounding of roots and sums of bounds, which are kept as 32-bit floats.
SLACK = 1e-14


@dataclass
class Codebooks:
    """Whole-number entries: parts x entries x components."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Of all components in decimal by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def whole_vectors(vectors: DataFrame, scale: int, *keep: Column, vector_col: str = "embedding") -> DataFrame:
    """``keep`` and ``x``, floor(scale * component) of each; rows whose vector is null, empty, or has a null or non-finite component go."""
    v = F.col(f"`{vector_col}`")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    rows = vectors.filter(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(fine(c.cast("double")), F.lit(False))))
    return rows.select(*keep, F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("x"))


def _up(values: np.ndarray) -> np.ndarray:
    wide = values * (1 + SLACK)
    out = wide.astype(np.float32)
    return np.where(out < wide, np.nextafter(out, np.float32(np.inf)), out)


def _down(values: np.ndarray) -> np.ndarray:
    narrow = np.maximum(values * (1 - SLACK), 0)
    out = narrow.astype(np.float32)
    return np.maximum(np.where(out > narrow, np.nextafter(out, np.float32(-np.inf)), out), np.float32(0))


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """All squared distances, exact."""
    a = x.astype(np.float64)
    if max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) ** 2 * max(1, x.shape[1]) < 1 << 53:
        cross = (a @ entries.T.astype(np.float64)).astype(np.int64)  # each product and sum is a whole number below 2^53
    else:
        cross = np.einsum("nd,kd->nk", x, entries)
    return (x * x).sum(1)[:, None] + (entries * entries).sum(1)[None, :] - 2 * cross


def first_codes(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes, upper bounds, lower bounds and distances computed, where there are no bounds yet. Ties go to the lower entry."""
    d = squared(x, entries)
    code = d.argmin(1)
    roots = np.sqrt(d.astype(np.float64))
    return code, _up(roots[np.arange(len(x)), code]), _down(roots), d.size


def next_codes(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same after ``entries`` have moved by ``moved`` each: only entries that the bounds leave open are computed."""
    upper = _up(upper.astype(np.float64) + moved[code])
    lower = _down(lower.astype(np.float64) - moved[None, :])
    half = _down(np.sqrt(squared(entries, entries).astype(np.float64)) / 2)
    open_to = lambda i: (lower[i] <= upper[i, None]) & (half[code[i]] <= upper[i, None])  # noqa: E731  what isn't is strictly farther than the part's own entry
    maybe = open_to(np.arange(len(x)))
    maybe[np.arange(len(x)), code] = False
    rows = np.flatnonzero(maybe.any(1))
    own = ((x[rows] - entries[code[rows]]) ** 2).sum(1)
    exact = np.sqrt(own.astype(np.float64))
    upper[rows], lower[rows, code[rows]] = _up(exact), _down(exact)
    maybe = open_to(rows)
    maybe[np.arange(len(rows)), code[rows]] = False
    at, entry = np.nonzero(maybe)
    d = ((x[rows[at]] - entries[entry]) ** 2).sum(1)
    lower[rows[at], entry] = _down(np.sqrt(d.astype(np.float64)))
    table = np.full((len(rows), len(entries)), np.iinfo(np.int64).max)
    table[at, entry] = d
    table[np.arange(len(rows)), code[rows]] = own
    best = table.argmin(1) if len(rows) else np.zeros(0, np.int64)  # of equal distances the lower entry
    code = code.copy()
    code[rows] = best
    upper[rows] = _up(np.sqrt(table[np.arange(len(rows)), best].astype(np.float64)))
    return code, upper, lower, len(rows) + len(d)


def _blob(values: np.ndarray) -> pa.Array:
    """One binary value a row."""
    width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(np.arange(0, (len(values) + 1) * width, max(width, 1), dtype=np.int32)[: len(values) + 1]), pa.py_buffer(np.ascontiguousarray(values))])


def _unblob(column: pa.Array, dtype, n: int) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(dtype).reshape(n, -1)


def _assigned(rows: DataFrame, books: Codebooks, moved: np.ndarray | None, final: bool) -> DataFrame:
    """``rows`` (key, label, x and, from the first round on, codes, upper, lower) with codes and bounds for ``books``.

    computed: the distances that it took; error: the squared distances to the entries, summed over parts, if ``final``.
    """
    parts, k, width = books.entries.shape
    shared = rows.sparkSession.sparkContext.broadcast((books.entries, moved))
    schema = StructType(rows.select("key", "label", "x").schema.fields + StructType.fromDDL("codes array<int>, upper binary, lower binary, computed long, error long").fields)

    def some(batch: pa.RecordBatch) -> pa.RecordBatch:
        entries, moved = shared.value
        n = batch.num_rows
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, parts, width)
        codes, uppers, lowers = np.empty((n, parts), np.int64), np.empty((n, parts), np.float32), np.empty((n, parts, k), np.float32)
        computed, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if moved is not None:
            had = (batch.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(n, parts), _unblob(batch.column("upper"), np.float32, n), _unblob(batch.column("lower"), np.float32, n).reshape(n, parts, k))
        for p in range(parts):
            here = np.ascontiguousarray(x[:, p])
            codes[:, p], uppers[:, p], lowers[:, p], count = first_codes(here, entries[p]) if moved is None else next_codes(here, entries[p], moved[p], *(h[:, p] for h in had))
            computed[0] += count
            if final:
                error += ((here - entries[p][codes[:, p]]) ** 2).sum(1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * parts + 1, parts, dtype=np.int32)), pa.array(codes.ravel().astype(np.int32)))
        return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), batch.column("x"), lists, _blob(uppers), _blob(lowers.reshape(n, -1)), pa.array(computed), pa.array(error)], names=["key", "label", "x", "codes", "upper", "lower", "computed", "error"])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                yield some(batch.slice(start, ROWS))

    return rows.mapInArrow(tidy(run), schema)


def _updated(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Entries as the componentwise floor of the mean of their parts; unused ones stay. One row per used entry reaches the driver."""
    parts, _, width = books.entries.shape
    each = rows.select(F.posexplode("codes").alias("part", "entry"), "x")
    sums = each.groupBy("part", "entry").agg(F.count("*").alias("n"), *[F.sum(F.get("x", F.col("part") * width + i)).alias(f"s{i}") for i in range(width)])
    entries = books.entries.copy()
    for part, entry, n, *total in sums.toArrow().to_pandas().itertuples(index=False):
        entries[part, entry] = [int(s) // int(n) for s in total]
    return Codebooks(entries)


def fit_codes(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks]:
    """(key, label, codes, error, computed) of each kept vector, and the codebooks. key and label are ``id_col`` and ``label_col``.

    Each part position's codebook starts as that part of the ``entries`` vectors of the smallest ids (rows without an id
    come last, equal ids by components; fewer vectors make fewer entries). Vectors that are null, empty or have null or
    non-finite components are left out, and so are those of another length than most have (of lengths as frequent, the
    shorter). A length that ``parts`` doesn't divide, and components of 2^24 and more after scaling, are errors. Repeated
    rows each count. The state of a round, with its 4 bytes for each entry and part, is a table in the shared folder;
    that of the round before goes when it is written.
    """
    require(vectors, id_col, vector_col)
    spark = vectors.sparkSession
    label = F.col(f"`{label_col}`") if label_col in vectors.columns else F.lit(None).cast("int")
    all_rows = whole_vectors(vectors, scale, F.col(f"`{id_col}`").alias("key"), label.alias("label"), vector_col=vector_col)
    lengths = all_rows.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("x", F.abs))).alias("largest")).orderBy(F.desc("n"), "length").head(1)
    length = lengths[0]["length"] if lengths else parts
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    if lengths and lengths[0]["largest"] >= LARGEST:
        raise ValueError(f"a component times {scale} is {LARGEST} or more")
    rows = all_rows.filter(F.size("x") == length)
    seeds = rows.select("key", "x").orderBy(F.col("key").asc_nulls_last(), "x").limit(entries).select("x").toArrow().column(0).to_pylist()
    books = Codebooks(np.array(seeds, np.int64).reshape(len(seeds), parts, length // parts).transpose(1, 0, 2).copy())
    if not seeds:
        return rows.select("key", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("computed")), books
    state, path = written_at(_assigned(rows, books, None, rounds == 0), "vector-bounds")
    for number in range(1, rounds + 1):
        before, books = books, _updated(state, books)
        moved = np.sqrt(((books.entries - before.entries) ** 2).sum(2).astype(np.float64)) * (1 + SLACK)
        last, (state, path) = path, written_at(_assigned(state, books, moved, number == rounds), "vector-bounds")
        discard(spark, last)
    return state.select("key", "label", "codes", "error", "computed"), books


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **sizes) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error, codebooks_sha256 of each vector that ``fit_codes`` keeps.

    label_error: error summed over the rows of a label; rows without a label count together. At most 256 entries a part.
    """
    if sizes.get("entries", 256) > 256:
        raise ValueError("two hex digits tell 256 entries apart")
    rows, books = fit_codes(vectors, id_col=id_col, vector_col=vector_col, label_col=label_col, **sizes)
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    known = F.when(F.col("label").isNull(), "").otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    rows = rows.select(F.col("key").alias("vec_id"), code.alias("code"), "error", known.alias("_label"))
    per_label = rows.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_rows"))
    total = per_label.agg(F.sum("_rows")).head()[0] or 0
    out = join_by_count(rows.withColumn("_spread", F.xxhash64("vec_id", "code")), per_label, "_label", "_rows", total, "_spread")
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
