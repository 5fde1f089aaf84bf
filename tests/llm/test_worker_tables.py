"""What a worker keeps between tasks: one operator's table, and nothing of it beside another operator's work."""

import public_tokenizers
import pyarrow as pa

from glycotide.llm import shared, tokens


def test_a_table_goes_when_another_operator_has_the_worker():
    shared.worker_table(("a",), lambda: "large")
    list(shared.tidy(lambda batches: batches, table=True)(iter([])))
    assert shared._TABLES == {("a",): "large"}
    list(shared.tidy(lambda batches: batches)(iter([])))
    assert shared._TABLES == {}


def test_ids_are_the_same_whatever_is_tokenized_at_once():
    texts = pa.array(["one, two\nthree  four", None, "", "<|endoftext|> x", "a b c " * 50, "über   x"])
    for name, keeps in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        made = tokens.WordTokenizer(public_tokenizers.path(name), keeps)
        assert list(made.encode(texts, 1)) == list(made.encode(texts, 40)) == list(made.encode(texts))
