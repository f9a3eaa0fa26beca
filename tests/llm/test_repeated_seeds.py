"""Decontamination where seeds repeat: within an item, within a text, among many items."""

import random
import time

import numpy as np

from demandgrid.llm import decontaminate as D


def verified(items, docs):
    block = D.Block(items)
    raw = [d.encode() for d in docs]
    hashes, first = D.tokens(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    begun = time.process_time()
    found = block.verified(hashes, first, D.OVERLAP, D.SIMILARITY)
    return found, time.process_time() - begun


def plain(items, docs):
    """Every item at every place of every document."""
    out = {}
    for d, doc in enumerate(docs):
        tokens = doc.lower().split()
        for i, (_, text) in enumerate(items):
            item, best = text.lower().split(), None
            width = min(D.OVERLAP, len(item))
            for begin in range(-len(item) + 1, len(tokens)):
                equal = [0 <= begin + k < len(tokens) and tokens[begin + k] == w for k, w in enumerate(item)]
                good = [
                    k
                    for k in range(len(item) - width + 1)
                    if 0 <= begin + k and begin + k + width <= len(tokens)
                    and sum(equal[k : k + width]) >= D.SIMILARITY * width - 1e-9
                ]
                if good:
                    s, e = good[0], good[-1] + width
                    n = sum(equal[s:e])
                    if best is None or n > best[0]:
                        best = (n, begin + s, e - s)
            if best:
                out[d, i] = best
    return out


def test_repeats_equal_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        letters = rng.choice(["ab", "abc", "abcdefgh"])
        made = lambda low, high: " ".join(rng.choice(letters) for _ in range(rng.randint(low, high)))  # noqa: E731, B023
        items = list(enumerate(dict.fromkeys(made(5, 30) for _ in range(6))))
        items += [(99, "a " * 20), (98, "a b " * 9)]
        docs = [made(0, 60) for _ in range(4)] + ["a " * 40, "b a " * 25, items[0][1]]
        assert verified(items, docs)[0] == plain(items, docs)


def test_time_does_not_grow_with_all_pairs():
    found, seconds = verified([(1, "0 " * 200)], ["0 " * 100_000])
    assert found == {(0, 0): (200, 0, 200)} and seconds < 20
    rng = random.Random(1)
    words = [f"w{k}" for k in range(3000)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    lead = "which of the following is the best known "
    items = [(k, lead + some(14)) for k in range(5000)]
    docs = [f"{some(100)} {lead}{some(100)}" for _ in range(30)]
    docs[7] += " " + items[55][1]
    found, seconds = verified(items, docs)
    assert set(found) == {(7, 55)} and seconds < 20
