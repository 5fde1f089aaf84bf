"""Token-id files: fixed-size blocks of ids, transposed into bit planes, each plane compressed, with a chunk index.

A file is: MAGIC; the chunks, one per block; the footer (JSON, zstandard); its length as 8 bytes, little-endian; MAGIC.
A chunk holds a block's ids as planes: plane k has bit k of each id, packed 8 to a byte (or byte k of each id, with
``plane="byte"``); planes above the block's largest id are left out. The footer's chunk index gives, per block, the
number of ids and each plane's compressed size; its document index gives ids and token counts in order.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glycotide.llm.shared import open_fs, parts, require, shared_dir, text_or_empty, tidy, written
from glycotide.llm.tokens import tokenizer

MAGIC = b"TOKPLN01"
BLOCK = 65_536
#: Ids, and documents, from which a file is full.
FILE_IDS, FILE_DOCS = 1 << 24, 1 << 18


def to_planes(ids: np.ndarray, plane: str = "bit") -> list[bytes]:
    top = int(ids.max(initial=0))
    octets = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    octets = octets[:, : max(1, -(-top.bit_length() // 8))]
    if plane == "byte":
        return [octets[:, k].tobytes() for k in range(octets.shape[1])]
    return [np.packbits((octets[:, k // 8] >> (k % 8)) & 1, bitorder="little").tobytes() for k in range(max(1, top.bit_length()))]


def from_planes(planes: list[bytes], n: int, plane: str = "bit") -> np.ndarray:
    octets = np.zeros((n, 4), np.uint8)
    for k, raw in enumerate(planes):
        column = np.frombuffer(raw, np.uint8)
        if plane == "byte":
            octets[:, k] = column
        else:
            octets[:, k // 8] |= np.unpackbits(column, count=n, bitorder="little") << (k % 8)
    return octets.view("<u4").reshape(-1)


class Writer:
    """One file; ``add`` a document's ids, then ``close``."""

    def __init__(self, out, plane: str, block: int):
        self.out, self.plane, self.block = out, plane, block
        self.zstd, self.waiting, self.n_waiting = zstandard.ZstdCompressor(level=1), [], 0
        self.chunks: list[list] = []
        self.docs: list[int | None] = []
        self.counts: list[int] = []
        self.total = 0
        out.write(MAGIC)

    def add(self, doc_id: int, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.total += len(ids) // 4
        self.waiting.append(ids)
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        end = len(ids) if last else len(ids) // self.block * self.block
        for lo in range(0, end, self.block):
            block = ids[lo : min(lo + self.block, end)]
            planes = [self.zstd.compress(p) for p in to_planes(block, self.plane)]
            self.out.write(b"".join(planes))
            self.chunks.append([len(block), list(map(len, planes))])
        self.waiting, self.n_waiting = [ids[end:].tobytes()], len(ids) - end

    def close(self) -> None:
        self._flush(True)
        footer = self.zstd.compress(json.dumps({"plane": self.plane, "block": self.block, "chunks": self.chunks, "docs": self.docs, "counts": self.counts}).encode())
        self.out.write(footer + struct.pack("<Q", len(footer)) + MAGIC)


def read_footer(f) -> dict:
    f.seek(f.size() - 16)
    n, magic = struct.unpack("<Q8s", f.read(16))
    if magic != MAGIC:
        raise ValueError("not a complete token file")
    f.seek(f.size() - 16 - n)
    return json.loads(zstandard.ZstdDecompressor().decompress(f.read(n)))


def read_documents(f) -> Iterator[tuple[int, np.ndarray]]:
    """(id, ids) of each document; at most one document and one block are in memory."""
    footer, unzip = read_footer(f), zstandard.ZstdDecompressor()
    chunks = iter(footer["chunks"])
    f.seek(len(MAGIC))
    left = np.empty(0, "<u4")
    for doc, n in zip(footer["docs"], footer["counts"]):
        have, held = len(left), [left]
        while have < n:
            size, planes = next(chunks)
            held.append(from_planes([unzip.decompress(f.read(p)) for p in planes], size, footer["plane"]))
            have += size
        left = np.concatenate(held) if len(held) > 1 else left
        yield doc, left[:n]
        left = left[n:]


MANIFEST = "shard int, file int, path string, n_docs long, n_tokens long"


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, *, keeps_space: bool = False, plane: str = "bit", block: int = BLOCK, shards: int | None = None, file_ids: int = FILE_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes ``docs`` in ascending id order into files in ``folder``; returns the manifest (MANIFEST).

    Documents are dealt by id ranges, a shard has one range in order, and a file of it that has ``file_ids`` ids or
    FILE_DOCS documents ends, so files and their indexes are bounded. Files get their names when they are whole, by a
    rename, and a repeated or lost task leaves only files that no manifest names. A null text is empty and has the end
    id alone; rows without an id come first; rows that repeat an id, and those without one, follow each other by hashes of
    their texts, so the order is the same in each run and they, too, are dealt over ranges. The manifest is written before it
    is returned, so that the files it names stay the ones that later readers see.
    """
    require(docs, id_col, text_col)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = tokenizer(vocabulary, keeps_space).encode
        shard, number, out = TaskContext.get().partitionId(), 0, None
        fs, root = open_fs(folder)

        def done():
            writer.close()
            out.close()
            fs.move(name + ".tmp", name + ".tokens")
            path = f"{folder}/{name.rpartition('/')[2]}.tokens"
            return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "file": pa.array([number], pa.int32()), "path": [path], "n_docs": pa.array([len(writer.docs)], pa.int64()), "n_tokens": pa.array([writer.total], pa.int64())})

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name = f"{root}/shard-{shard:06d}-{number:05d}-{uuid.uuid4().hex[:12]}"
                    out = fs.open_output_stream(name + ".tmp")
                    writer = Writer(out, plane, block)
                writer.add(doc, ids + end)
                if writer.total >= file_ids or len(writer.docs) >= FILE_DOCS:
                    yield done()
                    out, number = None, number + 1
        if out is not None:
            yield done()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text"), F.xxhash64(F.lit(1), "text")]
    ordered = rows.repartitionByRange(shards or max(parts(docs.sparkSession), 1), *order).sortWithinPartitions(*order).select("doc_id", "text")
    return written(ordered.mapInArrow(tidy(run, table=True), MANIFEST), "manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read from the files of a manifest.

    ``start`` counts all ids of documents before it: those of earlier shards and files, from the manifest, and of its own file.
    """
    total, bases = 0, []
    for r in sorted(manifest.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()):  # one row per shard
        bases.append((r.shard, total))
        total += r.n
    earlier = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("inside", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    todo = files.join(F.broadcast(spark.createDataFrame(bases, "shard int, base long")), "shard").select("path", (F.col("base") + F.col("inside")).alias("before"))

    def run(batches):
        for batch in batches:
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, place = open_fs(path)
                held: list[tuple] = []
                with fs.open_input_file(place) as f:
                    for doc, ids in read_documents(f):
                        held.append((doc, at, len(ids), zlib.crc32(np.ascontiguousarray(ids))))
                        at += len(ids)
                        if len(held) == 10_000:
                            yield batch_of(held)
                            held = []
                if held:
                    yield batch_of(held)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return todo.repartition(max(1, min(len(bases), 10_000))).mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files_round_trip(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Writes token files to the shared folder and returns what is read back from them."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, shared_dir(spark, "tokens"), vocabulary, end_id))
