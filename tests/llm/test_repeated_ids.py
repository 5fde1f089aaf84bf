"""Rows of one id and several texts are documents of their own; an id of 64 bits stays as it is."""

from collections import Counter

from glycotide.llm import packing, repeated_spans, setsketch

A, B = "red green blue gold black white " * 3, "one two three four five six seven " * 3


def test_near_duplicates_do_not_link_the_texts_of_an_id(spark):
    docs = spark.createDataFrame([(5, A), (5, B), (2, A + "pink"), (3, B + "eight"), (None, B), (9, "")], "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in setsketch.near_duplicates(docs, 60, 100).collect())
    assert got == Counter({(5, 2, False): 1, (5, 3, False): 1, (2, 2, True): 1, (3, 3, True): 1, (None, 3, False): 1, (9, 9, True): 1})


def test_repeats_of_the_texts_of_an_id(spark):
    noise = "".join(chr(97 + k * k % 23) for k in range(150))
    docs = spark.createDataFrame([(7, noise[:60]), (7, noise[60:]), (8, "x" + noise[60:120])], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_removed > 0) for r in repeated_spans.remove_repeated(docs.limit(2), 40).collect())
    texts = [noise[:60].encode(), noise[60:].encode()]
    own = [any(t[i : i + 40] in t[i + 1 :] or t[i : i + 40] in o for i in range(len(t) - 39)) for t, o in (texts, texts[::-1])]
    assert got == Counter((7, x) for x in own)
    assert repeated_spans.remove_repeated(docs, 40).filter("doc_id = 8 and n_removed = 60").count() == 1


def test_packing_keeps_large_ids_beside_null(spark):
    big = 9007199254740993
    items = spark.createDataFrame([(big, 0, 5, "x"), (big + 2, 0, 6, "y"), (None, 0, 7, "z")], "doc_id long, piece int, length long, shard string")
    got = packing.pack(items, 10)
    assert got.columns == ["doc_id", "piece", "length", "shard", "sequence_id", "offset"]
    assert {(r.doc_id, r.shard) for r in got.collect()} == {(big, "x"), (big + 2, "y"), (None, "z")}
