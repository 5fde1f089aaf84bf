"""Sampled segmentations of texts into the pieces of a SentencePiece model, and their lossless decoding.

All ways to write a text in pieces are the paths of a lattice. Forward filtering sums the weights of the paths up to each
place; backward sampling then draws a path from the end, each with its share of the sum. Between two letters that no
piece has side by side every path has a cut, so a text's lattice falls into short independent ones, chunks. Equal chunks
of a batch share one forward table; each occurrence draws its own path, by numbers that depend only on the seed, the
row's key and the place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glycotide.llm.shared import require, text_or_empty, tidy, worker_table

SPACE = 0x2581
#: Stands for the letter U+2581 itself, which is no blank; no piece has it.
LITERAL_SPACE = 0x110000
#: Letters of a chunk up to which it is filtered along with others; entries of a table of weights; letters handled at a time.
LONG_CHUNK, TABLE, AT_ONCE = 48, 1 << 19, 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def uniforms(key: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each key and place; the same for the same three."""
    with np.errstate(over="ignore"):
        x = _mix(_mix(key ^ _mix(np.array([seed], np.uint64))) + place.astype(np.uint64) * _BASE)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


class Pieces:
    """A model's pieces as tables. The weight of the piece of rank r is (r + 2) ** -theta: ranks of merges follow Zipf's law."""

    def __init__(self, path: str, theta: float):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        letters = {i: np.array([ord(c) for c in model.id_to_piece(i)], np.int64) for i in plain}
        self.longest = max(map(len, letters.values()))
        self.bytes = [model.id_to_piece(i).replace("▁", " ").encode() if i in letters else b"" for i in range(n)]
        self.byte_id = np.zeros(256, np.int64)
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[1:-1], 16)
                self.byte_id[value], self.bytes[i] = i, bytes([value])
        rank = np.array([max(0.0, -model.get_score(i)) for i in plain])
        hashes = np.array([self.hash_of(letters[i]) for i in plain], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids, self.weights = hashes[order], np.array(plain, np.int64)[order], ((rank + 2) ** -theta)[order]
        if len(np.unique(self.hashes)) < len(plain):
            raise ValueError("pieces with equal hashes")
        #: Of a letter that no piece is: its bytes are written, at the weight of the rarest piece.
        self.byte_weight = float(self.weights.min())
        inside = np.unique(np.concatenate([np.unique(x) for x in letters.values() if len(x) > 1]))
        self.kind = np.zeros(LITERAL_SPACE + 1, np.int32)  # letters that longer pieces have are numbered from 1
        self.kind[inside] = np.arange(1, len(inside) + 1)
        self.beside = np.zeros((len(inside) + 1, len(inside) + 1), bool)
        for x in letters.values():
            if len(x) > 1:
                self.beside[self.kind[x[:-1]], self.kind[x[1:]]] = True
        #: A table of hashes by their upper bits, and those that found their place taken.
        self.slot = np.full(1 << 20, -1, np.int32)
        at = (self.hashes >> np.uint64(44)).astype(np.int64)
        self.slot[at[::-1]] = np.arange(len(at), dtype=np.int32)[::-1]
        self.shared = np.zeros(1 << 20, bool)
        self.shared[at[1:][at[1:] == at[:-1]]] = True

    @staticmethod
    def hash_of(x: np.ndarray) -> np.uint64:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in x:
                h = h * _BASE + np.uint64(c + 1)
            return _mix(np.array([h]) + np.uint64(len(x)))[0]

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash among the pieces; -1 for none."""
        at = (h >> np.uint64(44)).astype(np.int64)
        out = self.slot[at]
        out = np.where((out >= 0) & (self.hashes[np.maximum(out, 0)] == h), out, -1)
        if (more := self.shared[at] & (out < 0)).any():
            k = np.minimum(np.searchsorted(self.hashes, h[more]), len(self.hashes) - 1)
            out[more] = np.where(self.hashes[k] == h[more], k, -1)
        return out

    def tables(self, chunks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of chunks (a row each, filled up behind): per place and length of the last piece its share of the paths, summed up, and the piece.

        Chunk k's paths to place p end in a piece of l letters with probability share[k, p, l-1] - share[k, p, l-2].
        Pieces are places in ``ids``, or -1: the letter's bytes.
        """
        n, width = chunks.shape
        most = min(self.longest, width)
        prefix = np.zeros((n, width + 1), np.uint64)
        for j in range(width):
            prefix[:, j + 1] = prefix[:, j] * _BASE + (chunks[:, j] + 1).astype(np.uint64)
        share, piece = np.zeros((n, width + 1, most)), np.full((n, width + 1, most), -1, np.int32)
        power = np.ones(1, np.uint64)
        for size in range(1, most + 1):
            power = power * _BASE
            h = _mix(prefix[:, size:] - prefix[:, :-size] * power + np.uint64(size))
            inside = np.arange(size, width + 1)[None, :] <= sizes[:, None]
            found = np.where(inside, self.find(h.ravel()).reshape(h.shape), -1)
            piece[:, size:, size - 1] = found
            share[:, size:, size - 1] = np.where(found >= 0, self.weights[found], self.byte_weight if size == 1 else 0.0)
        paths = np.zeros((n, width + 1))
        paths[:, 0] = 1
        for j in range(1, width + 1):
            back = min(j, most)
            w = share[:, j, :back] * paths[:, j - back : j][:, ::-1]
            sums = np.cumsum(w, axis=1)
            paths[:, j] = sums[:, -1]
            share[:, j, :back] = sums / sums[:, -1:]
            share[:, j, back - 1 :] = 1.0
        return share, piece

    def sample(self, chunks: np.ndarray, sizes: np.ndarray, which: np.ndarray, keys: np.ndarray, places: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """For each occurrence (of chunk ``which``, of the row ``keys``, ending at ``places``): its number of pieces; all pieces in order.

        Pieces are ids, or -1 - letter where its bytes are to be written.
        """
        share, piece = self.tables(chunks, sizes)
        at, active = sizes[which].copy(), np.arange(len(which))
        counts, steps = np.zeros(len(which), np.int64), []
        while len(active):
            k, p = which[active], at[active]
            u = uniforms(keys[active], places[active] - (sizes[k] - p), seed)
            length = (share[k, p] <= u[:, None]).sum(axis=1) + 1
            found = piece[k, p, length - 1]
            steps.append((active, np.where(found >= 0, self.ids[found], -1 - chunks[k, p - length])))
            counts[active] += 1
            at[active] = p - length
            active = active[p > length]
        out = np.empty(int(counts.sum()), np.int64)
        ends = np.cumsum(counts) - 1
        for i, (who, ids) in enumerate(steps):  # step i is the i-th piece from the end
            out[ends[who] - i] = ids
        return counts, out

    def sample_long(self, letters: np.ndarray, key: int, end: int, seed: int) -> np.ndarray:
        """The same for one long chunk, place by place, with the sums scaled so that they stay in range."""
        n, text = len(letters), letters.tolist()
        prefix, powers = np.zeros(n + 1, np.uint64), [np.uint64(1)]
        with np.errstate(over="ignore"):
            for j, c in enumerate(text):
                prefix[j + 1] = prefix[j] * _BASE + np.uint64(c + 1)
            for _ in range(self.longest):
                powers.append(powers[-1] * _BASE)
            found = [self.find(_mix(prefix[s:] - prefix[:-s] * powers[s] + np.uint64(s))) for s in range(1, min(self.longest, n) + 1)]
        paths, edges = [1.0] + [0.0] * n, [None] * (n + 1)
        for j in range(1, n + 1):
            mine, total = [], 0.0
            for s in range(1, min(self.longest, j) + 1):
                k = int(found[s - 1][j - s])
                if k >= 0 or s == 1:
                    total += (float(self.weights[k]) if k >= 0 else self.byte_weight) * paths[j - s]
                    mine.append((total, s, k))
            paths[j], edges[j] = total, (total, mine)
            if total < 1e-200:  # all later sums come from the last ``longest`` ones
                for i in range(max(0, j - self.longest), j + 1):
                    paths[i] *= 1e200
        u = uniforms(np.full(n, key, np.uint64), end - n + np.arange(1, n + 1), seed)
        out, p = [], n
        while p:
            total, mine = edges[p]
            _, s, k = next((e for e in mine if e[0] / total > u[p - 1]), mine[-1])
            out.append(int(self.ids[k]) if k >= 0 else -1 - text[p - 1])
            p -= s
        return np.array(out[::-1], np.int64)

    def encode(self, texts: list[str], keys: np.ndarray, seed: int) -> list[np.ndarray]:
        """The ids of each text, a path drawn by its key."""
        letters, ends = [], []
        for text in texts:
            x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            x[x == SPACE] = LITERAL_SPACE
            x[x == 0x20] = SPACE
            letters += [np.array([SPACE]), x]
            ends.append(len(x) + 1)
        all_, ends = np.concatenate(letters), np.cumsum(ends)
        kind = self.kind[all_]
        cut = np.ones(len(all_), bool)
        cut[1:] = ~self.beside[kind[:-1], kind[1:]]
        cut[ends[:-1]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(np.append(starts, len(all_)))
        text_of = np.searchsorted(ends, starts, side="right")
        begin = np.concatenate([[0], ends[:-1]])
        places, row_key = starts + sizes - begin[text_of], keys[text_of]
        pieces, counts = [], np.zeros(len(starts), np.int64)
        long = np.flatnonzero(sizes > LONG_CHUNK)
        parts: dict[int, np.ndarray] = {}
        for i in long.tolist():
            parts[i] = self.sample_long(all_[starts[i] : starts[i] + sizes[i]], int(row_key[i]), int(places[i]), seed)
            counts[i] = len(parts[i])
        # equal chunks by hash, short ones first; a table has chunks of one size
        up, down = _powers(len(all_))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(all_.astype(np.uint64)) * up, dtype=np.uint64)])
        h = (sums[starts + sizes] - sums[starts]) * down[starts]
        short = np.flatnonzero(sizes <= LONG_CHUNK)
        key = (sizes[short].astype(np.uint64) << np.uint64(56)) | (_mix(h[short]) >> np.uint64(8))
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        order, lengths = np.argsort(which, kind="stable"), sizes[short[first]]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(first)))])
        at = 0
        while at < len(first):
            width = int(sizes[short[first[at]]])
            to = min(at + max(1, TABLE // ((width + 1) * min(self.longest, width))), int(np.searchsorted(lengths, width, side="right")))
            mine = short[first[at:to]]
            grid = all_[np.minimum(starts[mine][:, None] + np.arange(width)[None, :], len(all_) - 1)]
            who = order[bounds[at] : bounds[to]]
            n, ids = self.sample(grid, sizes[mine], which[who] - at, row_key[short[who]], places[short[who]], seed)
            counts[short[who]] = n
            pieces.append((short[who], n, ids))
            at = to
        offsets = np.concatenate([[0], np.cumsum(counts)])
        flat = np.empty(offsets[-1], np.int64)
        for who, n, ids in pieces:
            flat[np.repeat(offsets[who] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        for i, ids in parts.items():
            flat[offsets[i] : offsets[i + 1]] = ids
        if (flat < 0).any():
            raw = {int(c): self.byte_id[np.frombuffer((chr(c) if c != LITERAL_SPACE else chr(SPACE)).encode("utf-8", "surrogatepass"), np.uint8)] for c in np.unique(-1 - flat[flat < 0])}
            width = np.ones(len(flat), np.int64)
            lost = np.flatnonzero(flat < 0)
            width[lost] = [len(raw[int(-1 - flat[i])]) for i in lost]
            out = np.repeat(flat, width)
            places_ = np.cumsum(width) - width
            for i in lost.tolist():
                out[places_[i] : places_[i] + width[i]] = raw[int(-1 - flat[i])]
            flat, offsets = out, np.concatenate([[0], np.cumsum(width)])[offsets]
        of_text = offsets[np.append(np.searchsorted(starts, begin), len(starts))]
        return [flat[a:b] for a, b in zip(of_text[:-1], of_text[1:])]

    def decode(self, ids: list[int]) -> str:
        """The text; the blank that the encoder put before it goes."""
        return b"".join(map(self.bytes.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


_POWER: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWER.get("up", ())) < n:
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            x = np.full(max(n, AT_ONCE), base, np.uint64)
            x[0] = 1
            _POWER[name] = np.multiply.accumulate(x)
    return _POWER["up"][:n], _POWER["down"][:n]


def pieces(path: str, theta: float) -> Pieces:
    """This Python worker's tables."""
    return worker_table((path, theta), lambda: Pieces(path, theta))


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= AT_ONCE):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


def encode_sampled(docs: DataFrame, model: str, *, seed: int = 0, theta: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) of each row: a segmentation sampled by its key.

    Equal keys, texts and seeds give equal ids whatever the partitions; a null key is one of its own. A larger ``theta``
    draws the heavier paths more often. A null text is empty and has the one piece of the blank that is put first; other
    columns are ignored. Letters that no piece is, and U+2581, are written as bytes, so each text comes back.
    """
    require(docs, id_col, text_col)

    def run(batches):
        table = pieces(model, theta)
        for batch in batches:
            ids, keys, texts = batch.column(0), batch.column(1).to_numpy().astype(np.int64).view(np.uint64), batch.column(2).to_pylist()
            for lo, hi in _runs(texts):
                out = table.encode(texts[lo:hi], keys[lo:hi], seed)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array([x.astype("<u4").tobytes() for x in out], pa.binary())], names=["doc_id", "ids"])

    key = F.xxhash64(F.col(id_col).cast("long"))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"), text_or_empty(text_col).alias("text")).mapInArrow(tidy(run, table=True), "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the text of its ids; null ids have null text."""
    require(encoded, "doc_id", "ids")

    def run(batches):
        table = pieces(model, 1.0)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                texts = [None if x is None else table.decode(np.frombuffer(x, "<u4").tolist()) for x in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(tidy(run, table=True), "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, model: str, *, seed: int = 0, theta: float = 1.0) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, text_sha256 (of the decoded text) of each row."""
    out = decode(encode_sampled(docs, model, seed=seed, theta=theta), model)
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), F.sha2("text", 256).alias("text_sha256"))
