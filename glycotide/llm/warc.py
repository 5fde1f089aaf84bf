"""WARC archives: a deterministic sharded writer with payload revisits, and a reader."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glycotide.llm.shared import join_by_count, open_fs, parts, require, shared_dir, text_or_empty, tidy, written

#: Payload bytes of a shard, about; compressed bytes from which a file is full; ids of one step of the sort ranges; steps,
#: or sums of steps, that are summed in one window.
SHARD_BYTES, ROLL_BYTES, STEP, FAN = 32 << 20, 4 << 20, 256, 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_COLLECTION = 0x676C79636F  # fixed: part of every record id
_NO_ID = 1 << 74


def record_id(page_id: int | None) -> str:
    """A UUID (version 8) that holds the page's id, or that it has none; ``page_of`` gets it back."""
    low = (page_id or 0) & ((1 << 64) - 1)
    return str(uuid.UUID(int=_COLLECTION << 80 | 8 << 76 | _NO_ID * (page_id is None) | (low >> 62) << 64 | 2 << 62 | low & ((1 << 62) - 1)))


def page_of(urn: str) -> int | None:
    x = uuid.UUID(urn.strip("<>").removeprefix("urn:uuid:")).int
    if x & _NO_ID:
        return None
    low = ((x >> 64) & 3) << 62 | x & ((1 << 62) - 1)
    return low - (1 << 64) if low >> 63 else low


def _base32(raw: bytes) -> str:
    return base64.b32encode(raw).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record: a response with the payload, or a revisit that has its headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{record_id(page_id)}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{_base32(hashlib.sha1(payload).digest())}", f"WARC-Block-Digest: sha1:{_base32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:uuid:{record_id(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(raw: bytes) -> bytes:
    z = zlib.compressobj(3, zlib.DEFLATED, 31)  # no name and no time: equal records give equal bytes
    return z.compress(raw) + z.flush()


def members(f, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    z, out = zlib.decompressobj(31), []
    data = f.read(size)
    while data:
        out.append(z.decompress(data))
        if z.eof:
            yield b"".join(out)
            data, z, out = z.unused_data, zlib.decompressobj(31), []
            if not data:
                data = f.read(size)
        else:
            data = f.read(size)
    if any(out):
        raise ValueError("the file ends inside a record")


def parse(raw: bytes) -> dict:
    """A record's headers and payload; its digests must hold."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != "sha1:" + _base32(hashlib.sha1(block).digest()):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    if fields["WARC-Type"] == "response" and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload": payload, "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "payload_digest": digest.hex(), "record_type": fields["WARC-Type"], "refers_to": page_of(refers) if refers else None,
    }


def with_digest(pages: DataFrame, least: int) -> DataFrame:
    """``pages`` with the digest of payloads of ``least`` bytes or more."""
    return pages.withColumn("digest", F.when(F.length("payload") >= least, F.unhex(F.sha2("payload", 256))))


def revisits(rows: DataFrame) -> DataFrame:
    """page_id, digest, refers_to of pages whose payload a page of a larger id has, too: they refer to the largest."""
    keyed = rows.filter("digest is not null").select("page_id", "digest")
    groups = keyed.groupBy("digest").agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).filter("n > 1")
    found = join_by_count(keyed, written(groups, "payload-groups"), "digest", "n", rows.count(), "page_id")
    return found.filter("keep is not null and not page_id <=> keep").select("page_id", "digest", F.col("keep").alias("refers_to")).dropDuplicates(["page_id", "digest"])


def shard_starts(pages: DataFrame, shard_bytes: int) -> tuple[list[int], int]:
    """The first step (STEP consecutive ids) of each shard, by the bytes before it, and how many shards pages without an id need.

    Bytes before a step are those before its FAN-fold range and those inside it, and so on up, so each window has FAN rows
    at most however sparse ids are. The driver gets one number per shard.
    """
    steps = written(pages.groupBy(F.floor(F.col("page_id") / STEP).alias("step")).agg(F.sum(F.length("payload") + 512).alias("bytes")), "steps")
    without_id = steps.filter("step is null").agg(F.sum("bytes")).first()[0] or 0
    levels = [steps.filter("step is not null")]
    while levels[-1].count() > FAN:
        levels.append(written(levels[-1].groupBy(F.floor(F.col("step") / FAN).alias("step")).agg(F.sum("bytes").alias("bytes")), "step-sums"))
    before = lambda w: F.coalesce(F.sum("bytes").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = levels.pop().select("step", before(Window.orderBy("step")).alias("base"))  # FAN rows at most
    while levels:
        inside = levels.pop().withColumn("above", F.floor(F.col("step") / FAN))
        inside = inside.select("step", "above", before(Window.partitionBy("above").orderBy("step")).alias("at"))
        placed = inside.join(placed.select(F.col("step").alias("above"), "base"), "above").select("step", (F.col("base") + F.col("at")).alias("base"))
    shards = placed.groupBy(F.floor(F.col("base") / shard_bytes).alias("shard")).agg(F.min("step").alias("step"))
    return sorted(r["step"] for r in shards.collect()), -(-without_id // shard_bytes)


def with_shard(rows: DataFrame, starts: list[int], without_id: int = 1) -> DataFrame:
    """``rows`` with the shard that their id lies in; rows without an id are dealt by their content to the ``without_id`` last ones."""
    splits = [float("-inf"), *sorted({float(x) for x in starts[1:]}), float("inf")]
    step = F.floor(F.col("page_id") / STEP).cast("double")
    last = F.lit(len(splits) - 1) + F.pmod(F.xxhash64(F.coalesce("digest", "payload")), F.lit(max(1, without_id)))
    if len(splits) == 2:
        return rows.withColumn("shard", F.when(step.isNull(), last).otherwise(0).cast("long"))
    dealer = Bucketizer(splits=splits, inputCol="_step", outputCol="_shard", handleInvalid="keep")
    found = dealer.transform(rows.withColumn("_step", step))
    return found.withColumn("shard", F.when(F.col("page_id").isNull(), last).otherwise(F.col("_shard")).cast("long")).drop("_step", "_shard")


MANIFEST = "shard long, file int, temporary string, path string, records long, bytes long, sha256 string"


def write_warc(pages: DataFrame, folder: str, *, revisit_bytes: int = 1000, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes one record per page into gzipped archives in ``folder``; returns the manifest (MANIFEST).

    Shards are id ranges of about ``shard_bytes`` (larger only for pages of one id), each sorted; a file that has ``roll_bytes`` compressed ends and the next
    begins. The same pages give the same files, whatever the partitions. Tasks write under temporary names; when all have
    ended, the manifest of those that count is kept and its files get their names, so a lost or repeated task leaves only
    temporary files. Null html is an empty payload, a null url the URN of the page; a page without an id has a record that
    says so; equal rows give equal records. Payloads are shuffled once: what a page refers to is not joined to it but
    sorted before it.
    """
    require(pages, id_col, html_col)
    url = F.col(url_col).cast("string") if url_col in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), text_or_empty(html_col).cast("binary").alias("payload"))
    starts, without_id = shard_starts(rows, shard_bytes)
    rows = with_digest(rows, revisit_bytes)
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    notes = revisits(rows).select("page_id", "digest", F.lit(0).alias("kind"), none("url", "string"), none("payload", "binary"), "refers_to")
    both = rows.select("page_id", "digest", F.lit(1).alias("kind"), "url", "payload", none("refers_to", "long")).unionByName(notes)
    tasks = max(parts(pages.sparkSession), len(starts) + without_id)
    dealt = with_shard(both, starts, without_id).select("shard", "page_id", "digest", "kind", "url", "payload", "refers_to").repartitionById(tasks, F.col("shard").cast("int"))  # a shard per task
    dealt = dealt.sortWithinPartitions("shard", "page_id", "digest", "kind", "payload", "url")

    def run(batches):
        out, shard, number, note = None, None, 0, (None, None, None)
        fs, root = open_fs(folder)

        def done():
            out.close()
            return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "file": pa.array([number], pa.int32()), "temporary": [temporary], "path": [f"{folder}/pages-{shard:08d}-{number:05d}.warc.gz"], "records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64()), "sha256": [digest.hexdigest()]})

        for batch in batches:
            for k in range(batch.num_rows):
                s, page, own, kind, url, payload, refers = (c[k].as_py() for c in batch.columns)
                if kind == 0:
                    note = page, own, refers
                    continue
                if own is not None and note[:2] == (page, own):
                    refers = note[2]
                if out is not None and (s != shard or size >= roll_bytes):
                    yield done()
                    out = None
                if out is None:
                    number = number + 1 if s == shard else 0
                    shard, n, size, digest = s, 0, 0, hashlib.sha256()
                    temporary = f"{folder}/{uuid.uuid4().hex}.tmp"
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(open_fs(temporary)[1], compression=None)
                packed = _gzip(record(page, url, payload, refers, date))
                out.write(packed)
                digest.update(packed)
                n, size = n + 1, size + len(packed)
        if out is not None:
            yield done()

    manifest = written(dealt.mapInArrow(tidy(run), MANIFEST), "warc-manifest")

    def commit(batches):
        for batch in batches:
            for a, b in zip(batch.column("temporary").to_pylist(), batch.column("path").to_pylist()):
                fs, a = open_fs(a)
                b = open_fs(b)[1]
                if fs.get_file_info(a).type != pa.fs.FileType.NotFound:  # else an earlier attempt has done it
                    fs.move(a, b)
                elif fs.get_file_info(b).type == pa.fs.FileType.NotFound:
                    raise FileNotFoundError(b)
            yield batch

    return written(manifest.repartition(parts(pages.sparkSession)).mapInArrow(tidy(commit), MANIFEST), "warc-committed")


def read_warc(spark: SparkSession, manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of each record, digests checked; with the payload too if asked."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, place = open_fs(path)
                with fs.open_input_stream(place, compression=None) as f:
                    held, size = [], 0
                    for raw in members(f):
                        held.append(parse(raw))
                        size += 200 + len(raw) * payloads
                        if size > 8 << 20:
                            yield rows(held)
                            held, size = [], 0
                    if held:
                        yield rows(held)

    def rows(held):
        return pa.RecordBatch.from_arrays([pa.array([x[n] for x in held], types.get(n, pa.string())) for n in names], names=names)

    return manifest.select("path").repartition(parts(spark), "path").mapInArrow(tidy(run), schema)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and returns what is read back."""
    spark = pages.sparkSession
    return read_warc(spark, write_warc(pages, shared_dir(spark, "warc"))).drop("url")
