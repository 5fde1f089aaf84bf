"""op9 gives rows that repeat an id, and rows without one, the same places in every run, and deals them over files."""

import public_tokenizers

from glycotide.llm import token_planes


def test_repeated_and_missing_ids_have_one_order(spark, tmp_path):
    rows = [(None, f"without an id {i} " * (i % 7)) for i in range(120)] + [(5, f"one id {i} " * (i % 5 + 1)) for i in range(90)] + [(i, f"own id {i}") for i in range(-20, 20)] + [(5, "copy"), (5, "copy"), (None, None)]
    path = public_tokenizers.path("word_bpe_49k.json")

    def run(n, seed):
        docs = spark.createDataFrame(rows, "doc_id long, text string").orderBy(spark_hash(seed)).repartition(n)
        manifest = token_planes.write_token_files(docs, f"file://{tmp_path}/{n}", path, 1, shards=6)
        return manifest, sorted(map(tuple, token_planes.read_token_files(spark, manifest).collect()), key=lambda r: r[1])

    from pyspark.sql import functions as F

    spark_hash = lambda seed: F.xxhash64(F.lit(seed), "text")
    (manifest, a), (_, b) = run(3, 1), run(7, 2)
    assert a == b and len(a) == len(rows)
    assert [r[0] is None for r in a] == sorted((r[0] is None for r in a), reverse=True) and [r[0] for r in a if r[0] is not None] == sorted(i for i, _ in rows if i is not None)
    at = 0
    for _, start, n, _ in a:
        assert start == at
        at += n
    assert max(r.n for r in manifest.groupBy("shard").agg(F.sum("n_docs").alias("n")).collect()) < 90  # neither the null ids nor id 5 are in one shard
