"""Benchmark passages in training documents, found by spaced seeds.

A token is a run of letters, digits and bytes above 127, with A-Z lower-cased; all else
separates. A mask such as 1110111 hashes the tokens at its ones and ignores the others, so
a changed token spoils only the windows that look at it. Items shorter than ``overlap`` get
further masks of their own length, one for every choice of changed tokens that the verifier
accepts and that spoils all other windows, so that none of their passages is missed. Hashes of all masks over all
benchmark items are joined with those of every document window. Around each hit the item is
laid over the document, token by token, and verified: some stretch of ``overlap`` tokens
(the whole item, if that is shorter) must agree in a share ``similarity`` of its places.

The benchmark side is taken in blocks of a bounded number of tokens, each sent to the tasks
once and tested against all documents; the documents are never shuffled.

Null and empty texts, and items of fewer than ``MIN_ITEM`` tokens, match nothing. Items with
equal tokens are searched once and each reported. A null id is reported as such. Repeated
document rows each give their rows. Empty tables give no rows. Further columns are not read
by ``contaminated``; ``clean`` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T

#: Looked-at places of a window; 0 marks an ignored one.
MASKS = ("111111", "1110111", "11011011", "1100101011")
MIN_ITEM = 5
OVERLAP = 13
SIMILARITY = 0.8
#: Benchmark tokens in one block: about 200 MB with the hashes of all masks.
BLOCK_TOKENS = 4_000_000
_BYTES_AT_ONCE = 1 << 20
_TOKENS_AT_ONCE = 1 << 20
#: Pairs of item and place, and tokens to compare, that are held at a time.
_PAIRS_AT_ONCE = 1 << 18
_CELLS_AT_ONCE = 1 << 20
_FILTER_BITS = 22
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_WORDLIKE = np.zeros(256, bool)
_WORDLIKE[128:] = True
_WORDLIKE[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_VALUE *= np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    filled, step = 1, base
    while filled < n:  # doubling: the second half is the first times base ** filled
        take = min(filled, n - filled)
        out[filled : filled + take] = out[:take] * np.uint64(step)
        filled += take
        step = step * step % (1 << 64)
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


_up, _down = _powers(_ODD, 1 << 16), _powers(_INVERSE, 1 << 16)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of texts that stand one after the other in ``data`` (bytes), and how many
    tokens start before each text."""
    global _up, _down
    inside = _WORDLIKE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    at, end = np.flatnonzero(starts), np.flatnonzero(last) + 1
    out = np.empty(len(at), np.uint64)
    k = 0
    while k < len(at):
        stop = max(k + 1, int(np.searchsorted(end, at[k] + _BYTES_AT_ONCE, "right")))
        low, high = int(at[k]), int(end[stop - 1])
        if len(_up) < high - low:
            _up, _down = _powers(_ODD, high - low), _powers(_INVERSE, high - low)
        terms = _VALUE[data[low:high]] * _up[: high - low]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        s, e = at[k:stop] - low, end[k:stop] - low
        out[k:stop] = _mixed((sums[e] - sums[s]) * _down[s])
        k = stop
    return out, np.searchsorted(at, offsets)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings, nulls as empty ones, and where each begins."""
    column = column.cast(pa.large_string()).fill_null("")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _mask_offsets(mask: str) -> np.ndarray:
    return np.array([i for i, c in enumerate(mask) if c == "1"])


def _short_masks(n: int, masks: tuple[str, ...], similarity: float) -> list[str]:
    """Masks of length n for the choices of changed tokens that no window of ``masks`` avoids."""
    changed = max(0, min(n, int(np.floor(n - similarity * n + 1e-9))))
    places = [
        {at + int(k) for k in _mask_offsets(m)} for m in masks for at in range(n - len(m) + 1)
    ]
    return [
        "".join("0" if k in lost else "1" for k in range(n))
        for lost in combinations(range(n), changed)
        if all(p.intersection(lost) for p in places)
    ]


def _seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window of a mask."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, at in enumerate(_mask_offsets(mask)):
        total += hashes[at : at + n] * np.uint64(pow(_ODD, 2 * k + 1, 1 << 64))
    return _mixed(total)


class Block:
    """Seed hashes of some benchmark items, sorted for lookup."""

    def __init__(
        self,
        items: list[tuple[object, str]],
        masks: tuple[str, ...] = MASKS,
        overlap: int = OVERLAP,
        similarity: float = SIMILARITY,
    ) -> None:
        raw = [t.encode() for _, t in items]
        offsets = np.cumsum([0, *map(len, raw)])
        hashes, first = tokens(np.frombuffer(b"".join(raw), np.uint8), offsets)
        same: dict[bytes, list[object]] = {}
        for (item, _), a, b in zip(items, first, first[1:], strict=False):
            if b - a >= MIN_ITEM:
                same.setdefault(hashes[a:b].tobytes(), []).append(item)
        self.ids = list(same.values())
        self.items = [np.frombuffer(k, np.uint64) for k in same]
        self.sizes = np.array([len(i) for i in self.items], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate([np.empty(0, np.uint64), *self.items])
        sizes = sorted({len(i) for i in self.items if len(i) < overlap})
        short = [m for n in sizes for m in _short_masks(n, masks, similarity)]
        self.masks = (*masks, *short)
        self.seeds, self.where, self.filters = [], [], []
        for k, m in enumerate(self.masks):
            own = [i if k < len(masks) or len(i) == len(m) else i[:0] for i in self.items]
            found = [_seeds(i, m) for i in own]
            seeds = np.concatenate([np.empty(0, np.uint64), *found])
            item = np.repeat(np.arange(len(found)), [len(f) for f in found])
            place = np.concatenate([np.empty(0, np.int64), *(np.arange(len(f)) for f in found)])
            order = np.argsort(seeds, kind="stable")
            self.seeds.append(seeds[order])
            self.where.append((item[order], place[order].astype(np.int64)))
            bitmap = np.zeros(1 << _FILTER_BITS, bool)
            bitmap[(seeds >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.filters.append(bitmap)

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of item and place in ``hashes`` where the item would begin, for seeds in
        common; some come twice.

        Where an item repeats itself, as a table of zeros does, and so does the text, each
        seed of one meets each of the other. Such an item is laid at every place of the
        documents it was hit in instead: far fewer than the hits.
        """
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # mask, window, matches' bounds
        expected = np.zeros(len(self.items), np.int64)
        for m, (seeds, bitmap) in enumerate(zip(self.seeds, self.filters, strict=True)):
            mask = self.masks[m]
            for low in range(0, len(hashes), _TOKENS_AT_ONCE):
                own = _seeds(hashes[low : low + _TOKENS_AT_ONCE + len(mask) - 1], mask)
                maybe = np.flatnonzero(bitmap[(own >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
                a = np.searchsorted(seeds, own[maybe], "left")
                n = np.searchsorted(seeds, own[maybe], "right") - a
                real = n > 0
                found.append((np.full(int(real.sum()), m), maybe[real] + low, np.stack([a[real], n[real]])))
        for m in range(len(self.masks)):
            # Hits by item, from the windows that meet each seed.
            own = [(w, x) for k, w, x in found if len(k) and k[0] == m]
            if own:
                bounds = np.concatenate([x for _, x in own], axis=1)
                change = np.zeros(len(self.seeds[m]) + 1, np.int64)
                np.add.at(change, bounds[0], 1)
                np.add.at(change, bounds[0] + bounds[1], -1)
                expected += np.bincount(
                    self.where[m][0], np.cumsum(change)[:-1], minlength=len(self.items)
                ).astype(np.int64)
        lengths = np.array([len(i) for i in self.items], np.int64)
        repeated = expected > 2 * len(hashes) + 2 * lengths if len(found) else expected > 0
        docs_of: dict[int, set[int]] = {int(i): set() for i in np.flatnonzero(repeated)}
        for masks, windows, (a, n) in found:
            if not len(masks):
                continue
            item, place = self.where[masks[0]]
            if docs_of:
                # Each seed once for each document it is in, however often.
                docs = np.searchsorted(first, windows, "right") - 1
                _, once = np.unique(a * len(first) + docs, return_index=True)
                for k in once.tolist():
                    own = item[a[k] : a[k] + n[k]]
                    for i in np.unique(own[repeated[own]]).tolist():
                        docs_of[i].add(int(docs[k]))
                keep = ~repeated[item]
                before = np.concatenate([[0], np.cumsum(keep)])
                item, place = item[keep], place[keep]
                a, n = before[a], before[a + n] - before[a]
            step = max(1, _PAIRS_AT_ONCE // max(1, int(n.max(initial=0))))
            for k in range(0, len(n), step):
                cut = slice(k, k + step)
                many = n[cut]
                hit = np.repeat(a[cut], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                begin = np.repeat(windows[cut], many) - place[hit]
                # Windows next to each other lie on one diagonal: it is looked at once.
                key = np.unique((item[hit] << 40) + (begin + (1 << 39)))
                if len(key):
                    yield key >> 40, (key & ((1 << 40) - 1)) - (1 << 39)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for i, docs in docs_of.items():
            for d in sorted(docs):
                low, high = int(first[d]) - len(self.items[i]) + 1, int(first[d + 1])
                for k in range(low, high, _PAIRS_AT_ONCE):
                    begin = np.arange(k, min(high, k + _PAIRS_AT_ONCE))
                    held.append((np.full(len(begin), i), begin))
                    size += len(begin)
                    if size >= _PAIRS_AT_ONCE:
                        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                        held, size = [], 0
        if held:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))

    def _laid(self, items, begin, hashes, owner, overlap, similarity):  # noqa: ANN001, ANN202
        """What agrees where items of one length are laid over the documents: rows of
        document, item, place of the item, equal tokens, begin and length of the stretch."""
        length = len(self.items[items[0]])
        width = min(overlap, length)
        at = begin[:, None] + np.arange(length)
        inside = (at >= 0) & (at < len(hashes))
        at = np.where(inside, at, 0)
        equal = hashes[at] == self.flat[self.starts[items][:, None] + np.arange(length)]
        equal &= inside
        run = np.zeros((len(items), length + 1), np.int32)
        np.cumsum(equal, axis=1, out=run[:, 1:])
        good = run[:, width:] - run[:, :-width] >= similarity * width - 1e-9
        # A stretch lies in one document.
        doc = owner[at]
        good &= inside[:, : length - width + 1] & inside[:, width - 1 :]
        good &= doc[:, : length - width + 1] == doc[:, width - 1 :]
        row, place = np.nonzero(good)
        if not len(row):
            return np.empty((0, 6), np.int64)
        of = doc[row, place]
        lead = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (of[1:] != of[:-1])])
        last = np.r_[lead[1:], len(row)] - 1
        r, s, e = row[lead], place[lead], place[last] + width
        return np.stack([of[lead], items[r], begin[r], run[r, e] - run[r, s], begin[r] + s, e - s], axis=1)

    def verified(
        self, hashes: np.ndarray, first: np.ndarray, overlap: int, similarity: float
    ) -> dict[tuple[int, int], tuple[int, int, int]]:
        """The best stretch for each (document, item): (equal tokens, begin, length). Of equal
        ones that where the item would begin first."""
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        best = np.empty((0, 6), np.int64)
        for items, begin in self.hits(hashes, first):
            found = [best]
            sizes = self.sizes[items]
            order = np.argsort(sizes, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1) if len(order) else []:
                step = max(1, _CELLS_AT_ONCE // int(sizes[own[0]]))
                for k in range(0, len(own), step):
                    part = own[k : k + step]
                    found.append(self._laid(items[part], begin[part], hashes, owner, overlap, similarity))
            rows = np.concatenate(found)
            rows = rows[np.lexsort((rows[:, 2], -rows[:, 3], rows[:, 1], rows[:, 0]))]
            lead = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)][: len(rows)]
            best = rows[lead]
        return {
            (d, i): (n, s - int(first[d]), w) for d, i, _, n, s, w in best.tolist()
        }


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> Iterator[list]:
    """The items in blocks; a block is cut before it holds more than ``size`` tokens."""
    held: list[tuple[object, str]] = []
    n = 0
    for row in benchmark.select(id_col, text_col).toLocalIterator():
        row: Row
        if row[1]:
            more = len(row[1]) // 2 + 1  # a token and what separates it take two bytes
            if held and n + more > size:
                yield held
                held, n = [], 0
            held.append((row[0], row[1]))
            n += more
    if held:
        yield held


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    overlap: int = OVERLAP,
    similarity: float = SIMILARITY,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row for each document and item in it: the best stretch, in tokens of the document."""
    chosen = docs.select(id_col, text_col)
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField(item_col, benchmark.schema[item_col].dataType),
            *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "n_equal")),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    out = docs.sparkSession.createDataFrame([], schema)
    context = docs.sparkSession.sparkContext
    for items in _blocks(benchmark, item_col, item_text_col, block_tokens):
        shared = context.broadcast(Block(items, MASKS, overlap, similarity))
        out = out.unionByName(
            chosen.mapInArrow(_reported(shared, overlap, similarity, schema.names), schema)
        )
    return out


def _reported(shared, overlap: int, similarity: float, names: list[str]):  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        for batch in batches:
            hashes, first = tokens(*_bytes_of(batch.column(1)))
            best = block.verified(hashes, first, overlap, similarity)
            rows = [
                (doc, item, start, n, equal)
                for (doc, place), (equal, start, n) in best.items()
                for item in block.ids[place]
            ]
            docs, items, starts, lengths, equals = zip(*rows, strict=True) if rows else [()] * 5
            share = [e / n for e, n in zip(equals, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(docs, pa.int64())),
                    pa.array(items, *([] if rows else [pa.int64()])),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(equals, pa.int64()),
                    pa.array(share, pa.float64()),
                ],
                names=names,
            )

    return run


def _spared(shared, overlap: int, similarity: float, place: int):  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        for batch in batches:
            hashes, first = tokens(*_bytes_of(batch.column(place)))
            keep = np.ones(batch.num_rows, bool)
            for doc, _ in block.verified(hashes, first, overlap, similarity):
                keep[doc] = False
            yield batch.filter(pa.array(keep))

    return run


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    overlap: int = OVERLAP,
    similarity: float = SIMILARITY,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The documents that hold no benchmark passage, with all their columns."""
    context, place = docs.sparkSession.sparkContext, docs.columns.index(text_col)
    for items in _blocks(benchmark, item_col, item_text_col, block_tokens):
        shared = context.broadcast(Block(items, MASKS, overlap, similarity))
        docs = docs.mapInArrow(_spared(shared, overlap, similarity, place), docs.schema)
    return docs
