"""Runs that differ in the marks at their end are encoded once."""

from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandgrid.llm.tokenfiles import Levels, WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "zorblat zorblat&&& zorblat*** zorblat|,$ (zorblat) [zorblat]. \"zorblat\"# zorblat<> zorblat",
    "it's&& it'&s a1&& é&& é&& a≮ a&́ &&& ' '' x'&' x&' <|endoftext|> y<|endoftext|> <|endoftext|>& {}",
]


@pytest.mark.parametrize("as_text", [True, False])
def test_equal_to_the_library(as_text):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = as_text
    own = WordTokenizer(Path(PATH).read_text(encoding="utf-8"), as_text)
    ids, ends = own.encode(TEXTS, 2)
    for text, a, b in zip(TEXTS, ends, ends[1:], strict=False):
        assert ids[a : b - 1].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_marks_share_the_word():
    own = WordTokenizer(Path(PATH).read_text(encoding="utf-8"))
    own.encode(TEXTS[:1], 2)
    assert sum(b"zorblat" in part for part in own.known) == 4  # with no mark before, (, [ and "


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_levels_of_any_length(n):
    ids = np.random.default_rng(n).choice([3, 255, 256, 70_000, 2**31 + 5], n).astype(np.uint32)
    levels = Levels.of(ids)
    assert (levels.all() == ids).all() and levels.all().dtype == np.uint32
    places = np.random.default_rng(1).permutation(n)
    assert (levels.at(places) == ids[places]).all()
    assert all(len(ranks) == -(-len(chunk) // 512) + 1 for chunk, _, ranks in levels.parts)
