"""Sum-of-squares packing of token pieces into sequences of a fixed capacity."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glycotide.llm.shared import fresh, require, text_or_empty, tidy, written
from glycotide.llm.tokens import tokenizer

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces per shard in the first round, per shard in the second, and the gap from which a sequence is opened again.
SHARD, SECOND_SHARD, LOOSE_GAP = 8_192, 65_536, 8
#: Bytes of text that a worker tokenizes at a time.
AT_ONCE = 4 << 20


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first, which has the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of each document's ids, which end with ``end_id``; a null text is empty and has that id alone."""
    require(docs, id_col, text_col)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = tokenizer(vocabulary, True).encode
        for batch in batches:
            rows, counts = [], []
            for ids in encode(batch.column(1), AT_ONCE):
                ids = memoryview(ids + end)
                cuts = cut(len(ids) // 4, capacity)
                counts.append(len(cuts))
                rows += [(k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cuts)]
            columns = list(zip(*rows)) or [[]] * 4
            docs = batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            yield pa.RecordBatch.from_arrays([docs, *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64())))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), text_or_empty(text_col)).mapInArrow(tidy(run, table=True), PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each length (in the order given), and the gap of each sequence.

    With N(g) open sequences of gap g, a piece of length s moves one of them from g to g-s; it goes where the sum of
    all N(g)^2 becomes smallest, a new sequence being one of the choices (it wins no tie against an open one).
    """
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, gaps = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, s in enumerate(lengths.tolist()):
        change = 2 * (count[: capacity - s] - count[s:capacity]) + 2
        if s < capacity:
            change[0] = 1 - 2 * count[s]  # a sequence that gets full leaves the sum
        k = -1
        if s < capacity:
            change[count[s:capacity] == 0] = np.iinfo(np.int64).max
            k = int(change.argmin())
            if change[k] > 2 * count[capacity - s] + 1:
                k = -1
        if k < 0:
            b, gap = len(gaps), capacity
            gaps.append(0)
        else:
            gap = s + k
            b = open_at[gap].pop()
            count[gap] -= 1
        sequence[i], offset[i], gaps[b] = b, capacity - gap, gap - s
        if gap > s:
            count[gap - s] += 1
            open_at[gap - s].append(b)
    return sequence, offset, np.array(gaps, np.int64)


def pack(items: DataFrame, capacity: int, keys: tuple[str, ...] = ("doc_id", "piece"), length_col: str = "length") -> DataFrame:
    """``items`` with sequence_id and offset (which replace columns of these names); lengths are 1 to ``capacity``, every row is placed once.

    Shards of about SHARD rows, dealt by a hash of ``keys``, are packed apart, longest pieces first; sequences that stay
    loose are opened and their pieces packed again in larger shards. A shard's rows are a bounded group at any input
    size, and the same rows get the same places in each run. Rows pass as Arrow columns, so ids and nulls stay as they are.
    Rows of one key go to one shard: keys are to tell the rows apart but for few.
    """
    require(items, *keys, length_col)
    rows = items.drop("sequence_id", "offset")
    (shard,) = fresh(rows, "shard")
    out_schema = rows.schema.add("sequence_id", "long").add("offset", "long")
    order = [(length_col, "descending"), *((k, "ascending") for k in keys)]

    def round_of(rows: DataFrame, per_shard: int, number: int, reopen: bool) -> DataFrame:
        shards = -(-max(rows.count(), 1) // per_shard)

        def place(table: pa.Table) -> pa.Table:
            table = table.take(pc.sort_indices(table, sort_keys=order))
            sequence, offset, gaps = sum_of_squares(table.column(length_col).to_numpy().astype(np.int64), capacity)
            ids = (np.int64(2 * table.column(shard)[0].as_py() + number) << 32) + sequence
            loose = gaps[sequence] >= LOOSE_GAP if reopen else np.zeros(len(ids), bool)
            table = table.drop_columns([shard])
            return table.append_column("sequence_id", pa.array(ids, mask=loose)).append_column("offset", pa.array(offset, mask=loose))

        return rows.withColumn(shard, F.pmod(F.xxhash64(F.lit(number), *keys), F.lit(shards))).groupBy(shard).applyInArrow(place, out_schema)

    first = written(round_of(rows, SHARD, 0, True), "packed")
    again = round_of(first.filter("sequence_id is null").drop("sequence_id", "offset"), SECOND_SHARD, 1, False)
    return first.filter("sequence_id is not null").unionByName(again)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenizes, cuts and packs whole documents; returns PIECES with sequence_id and offset.

    A repeated id is packed once per row. No document is dropped, and only those over ``capacity`` tokens are cut.
    """
    return pack(written(pieces(docs, vocabulary, end_id, capacity, id_col, text_col), "pieces"), capacity)
