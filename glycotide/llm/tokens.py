"""Whole texts to token ids by the tokenizers library, each distinct word encoded once.

Both vocabularies split a text at white space before they merge, so a text's ids are those of its chunks in order.
Where blanks are part of the ids, a chunk is a word and the white space before it; where they are dropped, it is the word.
Arrow splits many texts at a time into chunks and numbers the distinct ones, so Python handles distinct chunks only.
Texts with white space other than blank, tab and line ends, and texts with a literal of a special token (as <|endoftext|>,
which the library by default takes for that token), are rare and go to the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from glycotide.llm.shared import worker_table

#: White space that arrow and the vocabularies might split at differently, and the mark that chunks are split at.
RARE = r"[\x00\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
#: White space that single blanks and line ends are not.
RUNS = r"[ \n]{2}|[\t\r]"
#: Marks behind a letter or digit, which both vocabularies split there: ids of a word with marks are those of the word, then of the marks.
MARKS, LETTER_LAST = ".,;:!?", "[A-Za-z0-9À-ÖØ-öø-ÿ]$"
#: Words that the vocabularies' rules leave whole and as they are but for bytes written as characters, where blanks are kept and where not.
LETTERS = {True: "[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+", False: "[a-zß-öø-ÿ]+"}
#: Distinct stems of each of a worker's two generations, some 200 bytes each; longer ones are not kept. Bytes split at a time.
MOST_WORDS, LONG_WORD, AT_ONCE = 150_000, 40, 8 << 20


def chunks_of(texts: pa.Array) -> pa.Array:
    """Each text's chunks, white space in front: a list of strings. No text has the byte 0."""
    if pc.any(pc.match_substring_regex(texts, RUNS)).as_py():
        marked = pc.replace_substring_regex(texts, r"([ \t\n\r]+[^ \t\n\r])", "\x00\\1")
    else:
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n")
    return pc.split_pattern(marked, "\x00")


def strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


class WordTokenizer:
    """``keeps_space``: blanks are part of the ids (byte-level vocabularies) and not dropped."""

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker per core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges, self.letters = self.tokenizer.model, re.compile(LETTERS[keeps_space])
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.characters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in (32, *range(0xC0, 0x100))}
        self.split = chunks_of if keeps_space else pc.ascii_split_whitespace
        special = [re.escape(t.content).replace("<", r"\x{3c}") for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([RARE, *special])
        #: Lower case first, as these vocabularies do, where blanks are dropped: a stem has one entry then.
        self.fold = not keeps_space
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, words: list[str]) -> list[bytes]:
        """The ids of words: of those of letters alone by the library's model, without the rules before it, which cost more than it does."""
        out = []
        is_plain, model, characters = self.letters.fullmatch, self.merges.tokenize, self.characters
        for lo in range(0, len(words), 20_000):
            some = words[lo : lo + 20_000]
            plain = list(map(is_plain, some))
            rest = iter(self.tokenizer.encode_batch_fast([w for w, x in zip(some, plain) if x is None], add_special_tokens=False))
            ids: list[int] = []
            ends = [0]
            for w, x in zip(some, plain):
                if x is None:
                    ids += next(rest).ids
                else:
                    ids += [t.id for t in model(w if w.isascii() and w[0] != " " else w.translate(characters))]
                ends.append(4 * len(ids))
            raw = np.array(ids, "<u4").tobytes()
            out += [raw[a:b] for a, b in zip(ends, ends[1:])]
        return out

    def _known(self, stems: list[str]) -> list[bytes]:
        """The ids of distinct stems: from the recent ones, the older ones, or the library."""
        recent, older = self.recent, self.older
        out = [recent.get(w) for w in stems]
        missing = [k for k, x in enumerate(out) if x is None]
        for k in missing:
            out[k] = older.get(stems[k])
        new = [k for k in missing if out[k] is None]
        for k, x in zip(new, self._library([stems[k] for k in new])):
            out[k] = x
        if len(recent) + len(missing) > MOST_WORDS:  # what was not asked for since the last turn goes
            self.older, self.recent = recent, {}
        self.recent.update((stems[k], out[k]) for k in missing[:MOST_WORDS] if len(stems[k]) <= LONG_WORD)
        return out

    def _ids(self, chunks: pa.Array) -> list[bytes]:
        """The ids of distinct chunks: those of their stems, and of the marks behind them."""
        stems = pc.utf8_rtrim(chunks, MARKS)
        stems = pc.if_else(pc.match_substring_regex(stems, LETTER_LAST), stems, chunks)
        distinct = (pc.ascii_lower(stems) if self.fold else stems).dictionary_encode()
        out = list(map(self._known(strings(distinct.dictionary)).__getitem__, distinct.indices.to_numpy().tolist()))
        marked = np.flatnonzero(pc.binary_length(chunks).to_numpy() > pc.binary_length(stems).to_numpy())
        sizes = pc.utf8_length(stems.take(pa.array(marked))).to_numpy().tolist()
        tails = [c[n:] for c, n in zip(strings(chunks.take(pa.array(marked))), sizes)]
        each = list(set(tails))
        ids = dict(zip(each, self._library(each)))
        for k, tail in zip(marked.tolist(), tails):
            out[k] += ids[tail]
        return out

    def encode(self, texts: pa.Array, at_once: int = AT_ONCE) -> Iterator[bytes]:
        """Each text's ids, in order, as little-endian unsigned 32-bit integers. Null texts are empty.

        Some 30 bytes of memory a byte of text are in use for ``at_once`` bytes (or one longer text) at a time.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + at_once, side="right")))
            yield from self._encode(texts.slice(at, end - at))
            at = end

    def _encode(self, texts: pa.Array) -> Iterator[bytes]:
        whole = pc.match_substring_regex(texts, self.whole, ignore_case=True)
        apart = [texts[k].as_py() for k in np.flatnonzero(whole.to_numpy(zero_copy_only=False))]
        chunks = self.split(pc.if_else(whole, "", texts))
        places = np.asarray(chunks.offsets) - chunks.offsets[0].as_py()
        words = chunks.flatten().dictionary_encode()
        del chunks
        ids = self._ids(words.dictionary)
        sizes = np.array([len(x) for x in ids], np.int64) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        which = words.indices.to_numpy()
        del words, ids
        n = sizes[which]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(starts[which] - ends[:-1], n)
        at += np.arange(ends[-1])
        out = flat[at]
        cuts, rest = ends[places].tolist(), iter(apart)
        for k, alone in enumerate(whole.to_pylist()):
            if alone:
                yield np.array(self.tokenizer.encode(next(rest), add_special_tokens=False).ids, "<u4").tobytes()
            else:
                yield out[cuts[k] : cuts[k + 1]].tobytes()


def tokenizer(path: str, keeps_space: bool) -> WordTokenizer:
    """This Python worker's tokenizer; it stays between tasks until another operator's table takes its place."""
    return worker_table((path, keeps_space), lambda: WordTokenizer(path, keeps_space))
