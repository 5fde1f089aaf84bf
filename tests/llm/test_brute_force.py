"""Operators that SQL can't express, against plain Python over whole tables and made-up texts."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from glycotide.llm import components, hamming_topk, line_dedup, packing, piece_sampling, quality, repeated_spans, setsketch, token_planes, warc

from .fixtures import EDGE, SMALL, near_components, repeated, shingles, table


def made(spark, texts, columns="doc_id long, text string"):
    return spark.createDataFrame(list(enumerate(texts, 1)), columns).repartition(7)


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def all_ids(path: str, texts: list, end: int) -> list[list[int]]:
    t = Tokenizer.from_file(public_tokenizers.path(path))
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for x in texts]


def corpus(spark) -> list[tuple]:
    odd = [(10**6 + k, t) for k, (_, t) in enumerate(EDGE)]
    more = ["don't  stop now", "x\r\ny\tz", "　wide", "a\x1cb", "<|endoftext|> here <|startoftext|>", "   ", "\n\n a \n b", "İstanbul ŞİŞ", "naïve line", "q" * 5_000]
    return [(r.doc_id, r.text) for r in table(spark).select("doc_id", "text").collect()] + odd + [(2 * 10**6 + k, t) for k, t in enumerate(more)]


def test_packing(spark):
    rows = corpus(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024).collect()
    pieces, bins = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for (doc, _), ids in zip(rows, all_ids("byte_bpe_50k.json", [t for _, t in rows], 2)):
        total += len(ids)
        mine = sorted(pieces.pop(doc))
        assert [p for p, *_ in mine] == list(range(len(mine)))
        at = 0
        for k, (_, start, length, check) in enumerate(mine):
            assert start == at and 1 <= length <= 1024 and check == crc(ids[start : start + length]) and (k == 0 or length == 1024)
            at += length
        assert at == len(ids)
    assert not pieces
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= 1.02 * total / 1024 + 1


def test_sum_of_squares_is_the_rule():
    rng = np.random.default_rng(5)
    lengths, capacity = rng.integers(1, 51, 300), 50
    sequence, offset, gaps = packing.sum_of_squares(lengths, capacity)
    filled: dict[int, int] = {}
    cost = lambda open_: sum(n * n for g, n in Counter(capacity - f for f in open_.values()).items() if 0 < g < capacity)
    for s, b, at in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        assert filled.get(b, 0) == at
        choices = [cost(filled | {x: f + s}) for x, f in filled.items() if f + s <= capacity] + [cost(filled | {-1: s})]
        filled[b] = at + s
        assert cost(filled) == min(choices)
    assert all(capacity - filled[b] == g for b, g in enumerate(gaps))


def test_token_files(spark, tmp_path):
    rows = corpus(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    at = 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_planes.token_files_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1).collect()}
    rows.sort()
    for (doc, _), ids in zip(rows, all_ids("word_bpe_49k.json", [t for _, t in rows], 1)):
        assert got.pop(doc) == (at, len(ids), crc(ids))
        at += len(ids)
    assert not got


def test_planes_round_trip():
    rng = np.random.default_rng(1)
    for plane, top, n in itertools.product(("bit", "byte"), (1, 2, 255, 256, 49_408, 1 << 32), (0, 1, 7, 8, 1000)):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
        assert np.array_equal(token_planes.from_planes(token_planes.to_planes(ids, plane), n, plane), ids)


def test_sampled_pieces_round_trip_and_repeat(spark):
    rows = [(k, t) for k, (_, t) in enumerate(corpus(spark))]
    docs, path = spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("piece_bpe_32k.model")
    one = {r.doc_id: r for r in piece_sampling.round_trip(docs.repartition(3), path, seed=1).collect()}
    two = {r.doc_id: r for r in piece_sampling.round_trip(docs.repartition(8), path, seed=1).collect()}
    other = {r.doc_id: r.ids_crc32 for r in piece_sampling.round_trip(docs, path, seed=2).collect()}
    assert one == two and sum(other[k] != r.ids_crc32 for k, r in one.items()) > len(rows) / 2
    assert all(one[k].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for k, t in rows)


def test_sampled_pieces_follow_the_lattice():
    table = piece_sampling.Pieces(public_tokenizers.path("piece_bpe_32k.model"), 1.0)
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text, n = "lattice", 20_000
    known = {model.id_to_piece(i): (max(0.0, -model.get_score(i)) + 2) ** -1.0 for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    whole = "▁" + text
    paths = {(): 1.0}
    ways: list[dict] = [{(): 1.0}] + [{} for _ in whole]
    for j in range(1, len(whole) + 1):
        for i in range(j):
            if whole[i:j] in known:
                for path, w in ways[i].items():
                    ways[j][path + (whole[i:j],)] = w * known[whole[i:j]]
    total = sum(ways[-1].values())
    drawn = Counter(tuple(model.id_to_piece(int(i)) for i in x) for x in table.encode([text] * n, piece_sampling._mix(np.arange(n, dtype=np.uint64)), 9))
    assert set(drawn) <= set(ways[-1]) and paths
    for path, w in ways[-1].items():
        p = w / total
        assert abs(drawn[path] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3, path


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"), quality.grade_column(), 3)
    assert model.thresholds == sorted(model.thresholds)
    held = quality.score(docs, model, least=2).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    toxic, good = [r for r in held if r.toxic == 1], [r for r in held if r.toxic == 0 and r.quality == 1]
    # half of the labels of sf0.1, some 220 toxic ones, to learn from
    assert sum(not r.kept for r in toxic) >= 0.8 * len(toxic) and sum(r.kept for r in good) >= 0.9 * len(good)
    assert all(r.p_at_least[0] >= r.p_at_least[1] and abs(sum(r.p_at_least) - r.expected_grade) < 1e-9 for r in held)


def test_ordinal_gradient_finds_the_maximum():
    rng = np.random.default_rng(2)
    rows, columns = np.nonzero(rng.random((400, 6)) < 0.5)
    x = np.zeros((400, 6))
    x[rows, columns] = 1
    grades = np.digitize(x @ [2, -2, 1, 0, 0, 0] + rng.logistic(size=400), [-0.5, 1.0])

    def loss(w, t):
        s = x @ w
        p = 1 / (1 + np.exp(-(s[:, None] - np.array([-np.inf, *t, np.inf])[None, :])))
        return -np.log(p[np.arange(400), grades] - p[np.arange(400), grades + 1]).sum() + 0.25 * (w**2).sum()

    w, t = quality.fit_ordinal(rows, columns, grades, 6, 3, rounds=2000, rate=0.05)
    best = loss(w, t)
    for _ in range(50):
        assert loss(w + rng.normal(0, 0.05, 6), t + rng.normal(0, 0.05, 2)) > best - 1e-3


def test_top_k_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 64))
    points = np.concatenate([base, base[:8], base[rng.integers(0, 40, 150)] * np.where(rng.random((150, 64)) < 0.1, -1, 1)])
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "vec_id long, embedding array<double>")
    bits = points > 0
    for k, queries in ((3, "vec_id % 5 = 0"), (60, "vec_id < 2")):
        got = {}
        for r in hamming_topk.top_k(vectors, vectors.filter(queries), k=k).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.neighbour_id, r.distance))
        for q, found in got.items():
            want = sorted((int((bits[q] ^ bits[j]).sum()), j) for j in range(len(points)) if j != q)[:k]
            assert [(n, d) for _, n, d in sorted(found)] == [(j, d) for d, j in want]
        assert len(got) == vectors.filter(queries).count()


def test_lines_equal_all_pairs(spark):
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    lines = [[rng.choice(words) for _ in range(rng.choice([1, 3, 12, 25]))] for _ in range(60)]
    lines += [[w for w in x if rng.random() > 0.06] + ["new"] * (rng.random() < 0.4) for x in rng.choices(lines, k=200)]
    rng.shuffle(lines)
    texts = ["\n".join(" ".join(x) for x in lines[i : i + 4]) for i in range(0, len(lines), 4)] + [None, "", "\n\n", " \t", "x\n x\t\nx x"]
    got = {r.doc_id: r.removed for r in line_dedup.line_counts(made(spark, texts)).collect()}
    seen, want = [], {}
    for i, t in enumerate(texts, 1):
        gone = []
        for j, line in enumerate((t or "").split("\n")):
            mine = set(re.findall(r"[^ \t\x0b\f\r]+", line))
            if mine and any(10 * len(mine & x) >= 9 * len(mine | x) for x in seen):
                gone.append(str(j))
            if mine:
                seen.append(mine)
        want[i] = ",".join(gone) or None
    assert got == want


def test_lines_with_a_hot_word(spark, monkeypatch):
    """Lines whose rarest words are the same: most differ from the earliest one, some are alike."""
    monkeypatch.setattr(line_dedup, "LEAST_HOT", 20)
    monkeypatch.setattr(line_dedup, "MOST_HOT", 10)
    rng = random.Random(17)
    common = [f"c{k}" for k in range(60)]
    lines = [["rare0", "rare1", *rng.sample(common, rng.choice([6, 9, 14, 20]))] for _ in range(150)]
    lines += [x[:-1] + [rng.choice(common)] for x in rng.choices(lines, k=100)] + [x[:-1] for x in rng.choices(lines, k=30)]
    rng.shuffle(lines)
    texts = ["\n".join(" ".join(x) for x in lines[i : i + 5]) for i in range(0, len(lines), 5)]
    for num, den in ((9, 10), (4, 5)):
        got = {(r.doc_id, r.line_no) for r in line_dedup.repeated_lines(made(spark, texts), num, den).collect()}
        seen, want = [], set()
        for i, t in enumerate(texts, 1):
            for j, line in enumerate(t.split("\n")):
                mine = set(line.split())
                if any(den * len(mine & x) >= num * len(mine | x) for x in seen):
                    want.add((i, j))
                seen.append(mine)
        assert got == want and len(want) > 50


def test_near_duplicates_equal_all_pairs(spark):
    rng = random.Random(6)
    texts = [r.text for r in table(spark).select("text").collect()]
    word = lambda: f"t{rng.randrange(3000)}"
    for n in (3, 5, 8, 40, 150):
        base = [word() for _ in range(n)]
        for _ in range(25):
            texts.append(" ".join(w if rng.random() > 0.03 else word() for w in base))
    chain = [word() for _ in range(300)]
    for k in range(30):  # neighbours are similar, ends are not
        texts.append(" ".join(chain[4 * k : 4 * k + 60]).upper())
    texts += [None, "", " \t\n", "a b", "A  B", "a b c d e", "A b\tc d e ", "a b c d"]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in setsketch.near_duplicates(made(spark, texts)).collect()}
    want = near_components(list(enumerate(texts, 1)))
    assert got == {i: (len(shingles(t)), want[i], want[i] == i) for i, t in enumerate(texts, 1)}


def test_many_near_copies_in_one_group(spark):
    rng = random.Random(11)
    base = [f"g{k}" for k in range(40)]
    texts = []
    for _ in range(500):  # about four in ten pairs are similar
        x = list(base)
        for at in rng.sample(range(40), rng.choice([0, 1, 1, 2, 3])):
            x[at] = f"z{rng.randrange(10**6)}"
        texts.append(" ".join(x))
    got = {r.doc_id: r.component_id for r in setsketch.near_duplicates(made(spark, texts)).collect()}
    assert got == near_components(list(enumerate(texts, 1)))


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {x: x for e in edges for x in e}
    for _ in low:
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert got == {x: low[x] for e in edges if e[0] != e[1] for x in e}


def check_repeats(spark, texts, length):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_spans.remove_repeated(made(spark, texts), length).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, (t, gone) in enumerate(zip(raw, repeated(raw, length)), 1):
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want = len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()
        assert got[i] == want, i


def test_repeats_equal_all_places(spark):
    rng = random.Random(10)
    noise = lambda n, letters="abcdefgh é": "".join(rng.choice(letters) for _ in range(n))
    shared = [noise(n) for n in (39, 40, 41, 80, 300)]
    texts = [noise(rng.randrange(5, 60)) + rng.choice(shared)[rng.randrange(3) :] + noise(rng.randrange(5, 90)) for _ in range(60)]
    texts += ["a" * 200, "ab" * 90, "a" * 39, noise(100, "ab"), shared[4] * 3, shared[4], None, "", shared[3][:40], texts[0], texts[0]]
    check_repeats(spark, texts, 40)


def test_repeats_with_a_hot_passage(spark, monkeypatch):
    monkeypatch.setattr(repeated_spans, "HOT", 5)
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    hot = noise(60)
    texts = [noise(rng.randrange(30)) + hot[rng.randrange(6) : 60 - rng.randrange(6)] + noise(rng.randrange(80)) for _ in range(80)] + ["x" * 300]
    check_repeats(spark, texts, 40)


def test_repeats_with_over_a_thousand_contents_of_an_anchor(spark):
    rng = random.Random(13)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    hot = noise(90)
    texts = [noise(rng.randrange(30, 60)) + hot[rng.randrange(20) : 90 - rng.randrange(20)] + noise(rng.randrange(30, 60)) for _ in range(repeated_spans.HOT + 300)]
    check_repeats(spark, texts, 40)


def test_repeats_in_documents(spark):
    check_repeats(spark, [r.text for r in table(spark).orderBy("doc_id").select("text").limit(120).collect()], 400)


def test_archives_are_the_same_for_other_partitions(spark, tmp_path):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    names = ["a", "b"]
    for name, n in zip(names, (2, 7)):
        got = warc.write_warc(pages.repartition(n), f"file://{tmp_path}/{name}", shard_bytes=1 << 16, roll_bytes=1 << 14)
        assert got.count() > 3 and warc.read_warc(spark, got).count() == pages.count()
    a, b = ({p.name: p.read_bytes() for p in (tmp_path / n).glob("*.warc.gz")} for n in names)
    assert a == b and not list(tmp_path.glob("*/*.tmp"))
