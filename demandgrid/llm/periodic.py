"""Periodic runs: stretches of words that repeat with a period, four times or more.

A run is a stretch of words of a text with smallest period q and at least ``max(LEAST, 4 q)``
words that no neighbouring word extends with the same period. Found by internal pattern
matching, for many texts at a time:

* Prefix doubling names equal blocks of 1, 2, 4, ... words, and gives the suffix array. A
  block that occurs once in its text is left out from then on.
* Blocks of ``2**k`` words at multiples of ``2**k`` are patterns. A block's occurrences are an
  interval of the suffix array; a wavelet tree over that array answers which of them are the
  next one before and the next one after the block (range predecessor and successor). An
  occurrence in the neighbouring window of ``2**k`` words touches the block, so these
  occurrences are an arithmetic progression, whose step is a candidate period. A run of
  period q, ``2**(k-1) < q <= 2**k``, holds a whole aligned block with its next occurrence on
  one side at least, and no nearer one: four periods are room enough.
* Progressions of one period that overlap by a period are one stretch. It misses less than a
  block on either side, which is compared word by word.

Windows of one or two words are compared directly. The wavelet tree is made level by level for
all questions at once and not kept, so memory is linear: about 150 bytes a word of a batch of
texts (``BATCH`` characters, or one longer text, which is always worked as a whole).

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts and texts of white space have no runs
and an empty rest. Repeated rows give a row each, an empty table none. Further columns pass
through; one with the name of an added column is replaced, as withColumn would.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.llm.common import evened, words_of

LEAST = 6
REPEATS = 4
#: Characters of text that a task works on at a time.
BATCH = 600_000

RUN = T.StructType(
    [T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")]
)


class _Numbers(dict):
    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def _level(values: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One level of the tree: zeros before each place, the values of the next level, all zeros."""
    ones = (values >> bit) & 1 == 1
    zeros = np.zeros(len(values) + 1, np.int32)
    np.cumsum(~ones, out=zeros[1:])
    return zeros, np.concatenate([values[~ones], values[ones]]), int(zeros[-1])


def _below(values: np.ndarray, left: np.ndarray, right: np.ndarray, than: np.ndarray) -> np.ndarray:
    """How many values of ``values[left:right]`` are less than ``than``."""
    found = np.zeros(len(left), np.int32)
    for bit in range(int(len(values)).bit_length() - 1, -1, -1):
        zeros, values, first = _level(values, bit)
        l0, r0 = zeros[left], zeros[right]
        one = (than >> bit) & 1 == 1
        found += np.where(one, r0 - l0, 0)
        left = np.where(one, first + left - l0, l0)
        right = np.where(one, first + right - r0, r0)
    return found


def _in_order(values: np.ndarray, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The value that comes ``at``-th (from 0) in ``values[left:right]`` by size."""
    found = np.zeros(len(left), np.int32)
    for bit in range(int(len(values)).bit_length() - 1, -1, -1):
        zeros, values, first = _level(values, bit)
        l0, r0 = zeros[left], zeros[right]
        low = r0 - l0
        one = at >= low
        found += np.where(one, 1 << bit, 0).astype(np.int32)
        at = np.where(one, at - low, at)
        left = np.where(one, first + left - l0, l0)
        right = np.where(one, first + right - r0, r0)
    return found


def _neighbours(
    suffixes: np.ndarray, block: np.ndarray, left: np.ndarray, right: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The occurrences next before and next after each block, -1 where there is none."""
    at = _below(suffixes, left, right, block)
    has_before, has_after = at > 0, at + 1 < right - left
    found = _in_order(
        suffixes,
        np.concatenate([left[has_before], left[has_after]]),
        np.concatenate([right[has_before], right[has_after]]),
        np.concatenate([at[has_before] - 1, at[has_after] + 1]),
    )
    before, after = np.full(len(block), -1, np.int32), np.full(len(block), -1, np.int32)
    cut = int(has_before.sum())
    before[has_before], after[has_after] = found[:cut], found[cut:]
    return before, after


def _touching(names: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and distances of equal neighbouring blocks of one or two words."""
    block = np.arange(0, len(names) - width, width)
    same = names[block] == names[block + width]
    if width == 2:
        same &= names[block] != names[block + 1]
    forward = block[same]
    back = np.arange(0, len(names), width)
    back = back[back >= width]
    same = names[back] == names[back - width]
    if width == 2:
        same &= names[back] != names[back - 1]
    starts = np.concatenate([forward, back[same] - width])
    return starts, np.full(len(starts), width)


def _stretches(codes: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Block width, starts and periods of stretches of one period: width + period words each.

    Equal words of different texts have different codes.
    """
    n = len(codes)
    suffixes = np.argsort(codes, kind="stable").astype(np.int32)
    ordered = codes[suffixes]
    head = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    size = np.diff(np.r_[head, n])
    each = np.repeat(size, size)
    name, count = np.empty(n, np.int64), np.empty(n, np.int32)
    name[suffixes], count[suffixes] = np.repeat(head, size), each
    live = suffixes[each > 1]
    asked: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    width = 1
    # A run of period q has 4 q words, and its blocks less than 2 q.
    while len(live) and 2 * width <= max(longest, 2):
        if width <= 2:
            yield (width, *_touching(name, width))
        else:
            block = live[live & (width - 1) == 0]
            left = name[block].astype(np.int32)
            asked.append((width, block, left, left + count[block]))
        after = live + np.int64(width)
        inside = after < n
        key = name[live] * (n + 1)
        key[inside] += name[after[inside]] + 1
        order = np.argsort(key, kind="stable")
        live, key = live[order], key[order]
        old = name[live]
        place = np.arange(len(live))
        first = np.r_[True, key[1:] != key[:-1]]
        of_old = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], place, 0))
        of_new = np.maximum.accumulate(np.where(first, place, 0))
        suffixes[old + place - of_old] = live
        name[live] = old + of_new - of_old
        starts = np.flatnonzero(first)
        size = np.diff(np.r_[starts, len(live)])
        each = np.repeat(size, size)
        count[live] = each
        live = live[each > 1]
        width *= 2
    if not asked or not sum(len(a[1]) for a in asked):
        return
    widths = np.repeat([a[0] for a in asked], [len(a[1]) for a in asked])
    block, left, right = (np.concatenate([a[c] for a in asked]) for c in (1, 2, 3))
    before, after = _neighbours(suffixes, block, left, right)
    down, up = block - before, after - block
    down[before < 0], up[after < 0] = 0, 0
    for width in np.unique(widths).tolist():
        own = widths == width
        a = own & (2 * up > width) & (up <= width)
        b = own & (2 * down > width) & (down <= width)
        starts = np.concatenate([block[a], before[b]]).astype(np.int64)
        yield width, starts, np.concatenate([up[a], down[b]]).astype(np.int64)


def _grown(codes: np.ndarray, at: np.ndarray, step: np.ndarray, way: int, width: int) -> np.ndarray:
    """How many of the ``width`` words from ``at`` on, in one direction, keep the period."""
    place = at[:, None] + way * np.arange(width)
    other = place - way * step[:, None]
    inside = (place >= 0) & (place < len(codes))
    same = codes[np.where(inside, place, 0)] == codes[np.where(inside, other, 0)]
    same &= inside
    return np.where(same.all(axis=1), width, same.argmin(axis=1))


def find_runs(codes: np.ndarray, longest: int) -> np.ndarray:
    """Rows of start, end and period, in this order, for all texts strung together.

    ``codes`` are numbers of words that differ between texts; ``longest`` is the number of
    words of the longest text.
    """
    found = [np.empty((0, 3), np.int64)]
    for width, start, period in _stretches(codes, longest):
        if not len(start):
            continue
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        # All stretches of a period are equally long here.
        length = period + width
        joined = np.r_[
            False, (period[1:] == period[:-1]) & (start[1:] <= start[:-1] + length[:-1] - period[1:])
        ]
        first = np.flatnonzero(~joined)
        last = np.r_[first[1:], len(start)] - 1
        start, end, period = start[first], start[last] + length[last], period[first]
        least = np.maximum(LEAST, REPEATS * period)
        hopeful = end - start + 2 * width >= least
        start, end, period, least = (x[hopeful] for x in (start, end, period, least))
        start = start - _grown(codes, start - 1, period, -1, width)
        end = end + _grown(codes, end, period, 1, width)
        long = end - start >= least
        found.append(np.stack([start[long], end[long], period[long]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def _worked(texts: list[str | None]) -> tuple[list[list[dict[str, int]]], list[str]]:
    """The runs of some texts, and what is left of each without the repeats."""
    numbers = _Numbers()
    # bytes.split cuts at blanks and the controls 9 to 13 alone.
    words = [(t or "").encode().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    total = int(sizes.sum())
    codes = np.fromiter((numbers[w] for ws in words for w in ws), np.int64, total)
    codes += np.repeat(np.arange(len(words)), sizes) * len(numbers)
    runs = find_runs(codes, int(sizes.max(initial=0))) if total else np.empty((0, 3), np.int64)
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    out: list[list[dict[str, int]]] = [[] for _ in words]
    for o, (a, b, q) in zip(owner.tolist(), runs.tolist(), strict=True):
        shift = int(ends[o] - sizes[o])
        out[o].append({"start": a - shift, "length": b - a, "period": q})
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    gone = np.cumsum(change)[:total] > 0
    rest = []
    for ws, found, end in zip(words, out, ends.tolist(), strict=True):
        if found:
            keep = np.flatnonzero(~gone[end - len(ws) : end]).tolist()
            ws = [ws[k] for k in keep]
        rest.append(b" ".join(ws).decode())
    return out, rest


def _slices(texts: list[str | None]) -> Iterator[slice]:
    start = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= BATCH:
            yield slice(start, k + 1)
            start, size = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def with_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``runs`` (start, length and period in words, by start and period) and
    ``collapsed``: the text's words without those that a run holds after its first period,
    joined by blanks."""
    added = [T.StructField("runs", T.ArrayType(RUN, False), False), T.StructField("collapsed", T.StringType())]
    text = F.col(text_col)
    docs = docs.withColumn("__text", text).drop("runs", "collapsed")
    kept = docs.drop("__text").schema.fields
    schema = T.StructType([*kept, *added])
    kinds = pa.list_(pa.struct([(name, pa.int64()) for name in RUN.names]))
    at = docs.columns.index("__text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            rest = [c for k, c in enumerate(batch.columns) if k != at]
            for s in _slices(texts):
                runs, left = _worked(texts[s])
                own = [c.slice(s.start, s.stop - s.start) for c in rest]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(runs, kinds), pa.array(left, pa.string())], names=schema.names
                )

    return docs.mapInArrow(work, schema)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Makes a tenth of the texts periodic, chosen by the id's checksum h: with g = h / 10,
    from word a = g mod n on the first p = 1 + (n - a) / (3 + g mod 8) words are repeated up
    to the text's length. Null ids, texts without words and all others stay as they are."""
    h = F.crc32(F.col(id_col).cast("string"))
    chosen = docs.withColumns({"__h": h, "__even": evened(F.col(text_col))})
    chosen = chosen.withColumn(
        "__words", F.when(F.expr("__h % 10 = 0"), words_of(F.col("__even"))).otherwise(F.array())
    )

    def at(column: str, text: str) -> None:
        nonlocal chosen
        chosen = chosen.withColumn(column, F.expr(text))

    at("__n", "size(__words)")
    at("__a", "cast(if(__n > 0, (__h div 10) % __n, 0) as int)")
    at("__p", "cast(1 + (__n - __a) div (3 + (__h div 10) % 8) as int)")
    at("__block", "slice(__words, __a + 1, __p)")
    again: Column = F.expr("flatten(array_repeat(__block, cast(ceil((__n - __a) / __p) as int)))")
    whole = F.slice(F.concat(F.expr("slice(__words, 1, __a)"), again), F.lit(1), F.col("__n"))
    text = F.when(F.col("__n") > 0, F.array_join(whole, " ")).otherwise(F.col(text_col))
    return chosen.withColumn(text_col, text).drop(
        "__h", "__even", "__words", "__n", "__a", "__p", "__block"
    )
