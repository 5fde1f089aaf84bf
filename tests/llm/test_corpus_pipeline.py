"""The chain of the pipeline's stages on a small folder of tables, each stage against plain Python."""

import math
import zlib
from collections import defaultdict

import corpus_pipeline
from pyspark.sql import functions as F

from glycotide.llm import quality

from .fixtures import PASSAGE, near_components, repeated, table
from .test_brute_force import all_ids, crc

LONG_WORDS = " ".join(f"river{k}" for k in range(80))


def test_stages_of_the_chain(spark, tmp_path, monkeypatch):
    some = table(spark).filter("length(text) < 4000 or text is null").select("doc_id", "text", "lang", "source", "n_chars")
    good = some.join(table(spark, "labels").filter("toxic = 0 and quality = 1"), "doc_id").orderBy("doc_id").limit(3)
    texts = [r.text for r in good.collect()]
    more = [(1_000, texts[0]), (1_001, texts[1] + " end"), (1_002, None), (1_003, ""), (None, texts[2]), (None, None), (1_004, LONG_WORDS), (1_005, LONG_WORDS + " more")]
    more += [(1_006 + k, f"{t} {PASSAGE} é {k}") for k, t in enumerate(texts)]
    extra = spark.createDataFrame([(i, t, "en", "made", len(t or "")) for i, t in more], some.schema)
    some.unionByName(extra).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, "labels").write.parquet(f"{tmp_path}/labels.parquet")

    after, models = {}, []
    write, fit = corpus_pipeline.written, quality.fit
    monkeypatch.setattr(corpus_pipeline, "written", lambda df, name: after.setdefault(name, write(df, name)))
    monkeypatch.setattr(quality, "fit", lambda *a, **b: models.append(fit(*a, **b)) or models[-1])
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    rows = lambda name: {r.doc_id: r.text for r in after[name].collect()}
    assert list(after) == [name for name, _ in corpus_pipeline.STAGES] and all(after[n].filter(F.col("doc_id").isNull()).count() == 0 for n in after)

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect() if r.doc_id is not None}
    (model,) = models
    weigh = lambda t: math.fsum(model.weights[b] for b in {zlib.crc32(f.encode()) % (1 << 18) for f in quality.features(t or "")})
    docs = {i: t for i, t in docs.items() if 1 / (1 + math.exp(model.thresholds[1] - weigh(t))) >= 0.5}
    assert rows("quality_classifier") == docs and 0 < len(docs) < some.count()
    toxic = {r.doc_id for r in some.join(table(spark, "labels").filter("toxic = 1"), "doc_id").collect()}
    assert toxic and len(toxic & set(docs)) < len(toxic)

    last = defaultdict(list)
    for i, t in docs.items():
        last[t or ""].append(i)
    assert any(len(x) > 1 for x in last.values())
    docs = {max(x): docs[max(x)] for x in last.values()}
    assert rows("exact_dedup") == docs

    low = near_components(list(docs.items()))
    assert any(low[i] != i for i in docs)
    docs = {i: t for i, t in docs.items() if low[i] == i}
    assert rows("minhash_near_dedup") == docs

    raw, gone_from = [(t or "").encode() for t in docs.values()], 0
    for (i, t), data, gone in zip(list(docs.items()), raw, repeated(raw, 400)):
        if any(gone):
            runs = bytes(b if not g else 0xFF for b, g in zip(data, gone)).split(b"\xff")  # no text has that byte
            docs[i], gone_from = "".join(x.decode("utf-8", "ignore") for x in runs), gone_from + 1
    assert gone_from
    assert rows("suffix_array_dedup") == docs
    assert {r.doc_id: r.n_chars for r in after["suffix_array_dedup"].collect()} == {i: t if t is None else len(t) for i, t in docs.items()}

    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for doc, ids in zip(docs, all_ids("byte_bpe_50k.json", list(docs.values()), 2)):
        at = 0
        for k, (piece, start, length, check) in enumerate(sorted(pieces[doc])):
            assert (piece, start) == (k, at) and check == crc(ids[start : start + length]) and (k == 0 or length == 1024)
            at += length
        assert at == len(ids)
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
