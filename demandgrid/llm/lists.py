"""Numbered keys and lists of ids that the tokenizers of a task keep."""

from __future__ import annotations

import numpy as np


def counted(uses: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Uses of ``n`` places, with those of ``at`` added."""
    more = np.bincount(at, minlength=n)
    more[: len(uses)] += uses
    return more


def often(uses: np.ndarray, most: int) -> tuple[np.ndarray, list[int]]:
    """The places used more than once, the ``most`` used ones of them, in order; and for every
    place its number among these, or -1."""
    keep = np.flatnonzero(uses > 1)
    if len(keep) > most:
        keep = keep[np.argpartition(-uses[keep], most)[:most]]
        keep.sort()
    at = np.full(len(uses), -1)
    at[keep] = np.arange(len(keep))
    return keep, at.tolist()


class Places(dict):
    """Numbers new keys in the order they come, and puts them into ``fresh`` after ``lead``."""

    def __init__(self, fresh: list, numbers: list[int], lead: str | bytes) -> None:
        self.fresh, self.numbers, self.lead = fresh, numbers, lead

    def __missing__(self, key: str | bytes) -> int:
        self[key] = at = self.numbers[0]
        self.numbers[0] = at + 1
        self.fresh.append(self.lead + key)
        return at

    def renumber(self, places: list[int], longest: int) -> None:
        """New numbers by old ones; keys with a negative one, and long keys, are dropped."""
        kept = [(k, places[n]) for k, n in self.items() if places[n] >= 0 and len(k) <= longest]
        self.clear()
        self.update(kept)


class Lists:
    """Lists of ids one after the other, numbered from 0, that grow at the end."""

    def __init__(self, kind: type = np.int32) -> None:
        self.n = 0
        self.starts, self.flat = np.zeros(1 << 16, np.int64), np.empty(1 << 18, kind)

    def append(self, sizes: np.ndarray, ids: np.ndarray) -> None:
        held = int(self.starts[self.n])
        while len(self.flat) < held + len(ids):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while len(self.starts) < self.n + len(sizes) + 1:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[held : held + len(ids)] = ids
        self.starts[self.n + 1 : self.n + len(sizes) + 1] = held + np.cumsum(sizes)
        self.n += len(sizes)

    def only(self, places: np.ndarray) -> Lists:
        """A copy with the lists at some places, numbered anew."""
        out = Lists(self.flat.dtype.type)
        ids, lengths = self.take(places)
        out.append(lengths, ids)
        return out

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at some places, strung together, and their lengths."""
        lengths = self.starts[places + 1] - self.starts[places]
        shift = self.starts[places] - (np.cumsum(lengths) - lengths)
        return self.flat[np.repeat(shift, lengths) + np.arange(lengths.sum())], lengths
