"""Each operator over the rows of ``fixtures.EDGE`` and over an empty table."""

import uuid
from collections import Counter

import public_tokenizers
import pytest

from glycotide.llm import exact_dedup, hamming_topk, line_dedup, packing, piece_sampling, quality, repeated_spans, setsketch, token_planes, warc

from .fixtures import EDGE, edge


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "packing": lambda d: packing.pack_documents(d, public_tokenizers.path("byte_bpe_50k.json")),
    "pieces": lambda d: piece_sampling.round_trip(d, public_tokenizers.path("piece_bpe_32k.model"), seed=3),
    "quality": lambda d: quality.graded(d, labels(d.sparkSession, [(1, 0, 0), (4, 1, 0), (5, 0, 1), (None, 1, 0), (7, None, None)])),
    "lines": line_dedup.line_counts,
    "exact": lambda d: exact_dedup.exact_dedup(d, f"t_{uuid.uuid4().hex}"),
    "near": setsketch.near_duplicates,
    "tokens": lambda d: token_planes.token_files_round_trip(d, public_tokenizers.path("word_bpe_49k.json")),
    "repeated": repeated_spans.remove_repeated,
    "warc": lambda d: warc.warc_round_trip(d.withColumnsRenamed({"doc_id": "page_id", "text": "html"})).withColumnRenamed("page_id", "doc_id"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows(spark, name):
    rows = OPERATORS[name](edge(spark)).collect()
    ids = Counter(r["doc_id"] for r in rows if name != "packing" or r["piece"] == 0)
    if name == "lines":  # a repeated row stands for one document, so it gets one line of counts per row
        assert set(ids) == {i for i, _ in EDGE}
    else:
        assert ids == Counter(i for i, _ in EDGE)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](edge(spark, [])).count() == 0


def test_filters_keep_all_columns(spark):
    docs = edge(spark)
    for kept in (
        exact_dedup.without_copies(docs, f"t_{uuid.uuid4().hex}"), setsketch.without_near_duplicates(docs), repeated_spans.without_repeated(docs), line_dedup.without_repeated_lines(docs),
        quality.keep_good(docs, None, 2),
    ):
        assert kept.columns == docs.columns
        assert all(r["a.b"] == r["_id"] == "x" for r in kept.collect())
        assert {r["doc_id"] for r in kept.collect()} <= {i for i, _ in EDGE}


def test_top_k_edges(spark):
    rows = [(1, [1.0] * 64, 7), (2, [1.0] * 64, 7), (3, None, 7), (4, [None] * 64, 7), (5, [1.0] * 3, 7), (None, [1.0] * 64, 7)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, code int")
    got = {(r.query_id, r.rank): (r.neighbour_id, r.distance) for r in hamming_topk.top_k(vectors, vectors.filter("vec_id in (1, 4)"), k=2).collect()}
    assert got == {(1, 1): (2, 0), (1, 2): (4, 64), (4, 1): (1, 64), (4, 2): (2, 64)}
    assert hamming_topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0
