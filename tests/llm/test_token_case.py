"""Letters whose capital has no composite, against the library."""

import public_tokenizers
from tokenizers import Tokenizer

from demandgrid.llm.tokenfiles import WordTokenizer


def test_capitals_with_marks_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    texts = [c + "x Plain WORD É" for c in ("J̌", "H̱", "T̈", "W̊", "Y̊")]
    texts += ["ALL Plain, Ascii.", "ÄÖİ Mixed", None]
    with open(path, encoding="utf-8") as file:
        ids, cuts = WordTokenizer(file.read()).encode(texts, 2)
    for t, a, b in zip(texts, cuts, cuts[1:], strict=False):
        assert ids[a:b].tolist() == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], t


def test_a_small_cache_and_cases_of_one_word():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from demandgrid.llm import tokenfiles

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        ours = tokenfiles.WordTokenizer(file.read())
    rng = random.Random(2)
    words = ["The", "THE", "the", "Über", "über", "J̌x", "ǰx", "end.", "End.", "x" * 300, "naïve!", "a-b", ""]
    old, tokenfiles.CACHE = tokenfiles.CACHE, 6
    try:
        for _ in range(60):
            texts = [" ".join(rng.choices(words, k=rng.randint(0, 6))) for _ in range(3)]
            ids, ends = ours.encode(texts, 2)
            want = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
            assert [ids[a:b].tolist() for a, b in zip(ends, [*ends[1:], len(ids)], strict=True)][:3] == want
    finally:
        tokenfiles.CACHE = old
