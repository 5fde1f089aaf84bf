"""Words of letters alone go to the library's model without the rules before it, and have the ids that the rules give."""

import itertools

import numpy as np
import public_tokenizers
import pytest

from glycotide.llm import tokens

LETTERS = "abzAZßàéÿÀÖØŸĀªµ×÷"


class Counted:
    def __init__(self, library):
        self.library, self.words = library, []

    def encode_batch_fast(self, words, **flags):
        self.words += words
        return self.library.encode_batch_fast(words, **flags)


@pytest.mark.parametrize("name, keeps, plain", [("byte_bpe_50k.json", True, ["word", " Überall", "Éa", " a"]), ("word_bpe_49k.json", False, ["word", "überall", "ÿß"])])
def test_plain_words(name, keeps, plain):
    made = tokens.WordTokenizer(public_tokenizers.path(name), keeps)
    words = plain + ["it's", "'s", "ét", "12ab", "ab12", "a-b", "***", "don't,", "日本", "İ"] + list(map("".join, itertools.product(LETTERS, repeat=2)))
    if keeps:
        words += [f"{space}{w}" for w in words for space in (" ", "  ", "\n", "\t ")]
    expected = [np.array(made.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    made.tokenizer = Counted(made.tokenizer)
    assert made._library(words) == expected
    assert made.tokenizer.words and not set(plain) & set(made.tokenizer.words)
